"""Projections driven by names and types; all of it is metadata work plus one ``select``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def flatten(df: DataFrame, sep: str = "_", presence_flags: bool = False) -> DataFrame:
    """Nested structs to ``parent{sep}child`` columns at any depth. Arrays stay; a null struct
    gives null leaves, and optionally a ``{parent}{sep}present`` flag."""
    out = []

    def walk(fields, path: list[str]) -> None:
        for field in fields:
            here = path + [field.name]
            column = F.col(".".join(f"`{p}`" for p in here))
            if isinstance(field.dataType, T.StructType):
                if presence_flags:
                    out.append(column.isNotNull().alias(sep.join(here + ["present"])))
                walk(field.dataType.fields, here)
            else:
                out.append(column.alias(sep.join(here)))

    walk(df.schema.fields, [])
    return df.select(*out)


def keep_existing(df: DataFrame, names: list[str]) -> DataFrame:
    """The listed columns that exist, in the listed order."""
    return df.select(*[n for n in names if n in df.columns])


def names_containing(df: DataFrame, *parts: str) -> list[str]:
    return [n for n in df.columns if any(p.lower() in n.lower() for p in parts)]


def drop_containing(df: DataFrame, *parts: str) -> DataFrame:
    """Drop columns whose name contains one of ``parts``, ignoring case."""
    return df.drop(*names_containing(df, *parts))


def drop_listed(df: DataFrame, *lists: list[str]) -> DataFrame:
    """Drop the union of several name lists; names that do not exist are ignored."""
    return df.drop(*sorted(set().union(*lists)))


def columns_of(df: DataFrame, kind: type[T.DataType]) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kind)]


def split_target(df: DataFrame, target: str) -> tuple[DataFrame, DataFrame]:
    """Features and target as two projections of one plan. Rows of the two carry no common
    position; keep them in one frame wherever they have to meet again."""
    return df.drop(target), df.select(target)


def map_rows(df: DataFrame, column: str, key: str, value: str) -> DataFrame:
    """A map column as (key, value) rows."""
    return df.select(F.explode(column).alias(key, value))


def empty_delay_map(df: DataFrame, key: str = "flight_iata") -> DataFrame:
    """Each distinct code once, with no delay information yet."""
    return df.select(key).distinct().select(key, F.lit(None).cast("string").alias("delay_info"))
