"""Five comparable fields from a weather document in any of its stored forms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tarmac.functions.text import contains_any
from tarmac.schemas import WEATHER_FIELDS

# A condition is "bad" when its text contains one of these words.
BAD_WEATHER_WORDS = ["rain", "snow", "thunderstorm", "fog"]


def bad_weather(condition: Column) -> Column:
    """1 / 0 flag of a condition text; null text gives null."""
    return contains_any(condition, BAD_WEATHER_WORDS).cast("int")


def first_condition(doc: Column, field: str = "main") -> Column:
    """``field`` of the first element of the conditions array; null when the array is empty."""
    return F.get(doc.getField("weather"), 0).getField(field)


def precipitation(doc: Column) -> Column:
    """Rain of the last hour, zero when the document reports none. Snow is not counted."""
    return F.coalesce(doc.getField("rain").getField("1h"), F.lit(0.0))


def _pack(temperature, wind_speed, visibility, rain, bad) -> Column:
    values = [temperature, wind_speed, visibility, rain, bad]
    types = ["double", "double", "double", "double", "int"]
    return F.struct(*[v.cast(t).alias(n) for v, t, n in zip(values, types, WEATHER_FIELDS)])


def _from_document(doc: Column) -> Column:
    return _pack(
        doc.getField("main").getField("temp"),
        doc.getField("wind").getField("speed"),
        doc.getField("visibility"),
        precipitation(doc),
        F.coalesce(bad_weather(first_condition(doc)), F.lit(0)),
    )


def weather_struct(
    standard: Column | None = None,
    raw_data: Column | None = None,
    legacy_text: Column | None = None,
) -> Column:
    """One struct of the five fields; null when none of the forms is present.

    A plain text knows only its flag. Text is looked at first, then the wrapped document, then
    the standard one.
    """
    branches = []
    if legacy_text is not None:
        unknown = F.lit(None)
        branches.append((legacy_text, _pack(unknown, unknown, unknown, unknown, bad_weather(legacy_text))))
    if raw_data is not None:
        branches.append((raw_data, _from_document(raw_data)))
    if standard is not None:
        branches.append((standard, _from_document(standard)))
    if not branches:
        raise ValueError("give at least one weather form")
    (first, fields), *rest = branches
    picked = F.when(first.isNotNull(), fields)
    for doc, fields in rest:
        picked = picked.when(doc.isNotNull(), fields)
    return picked


#: The fields of a document that the five values come from.
_DOCUMENT = "STRUCT<weather: ARRAY<STRUCT<main: STRING>>, main: STRUCT<temp: DOUBLE>, wind: STRUCT<speed: DOUBLE>, visibility: DOUBLE, rain: STRUCT<`1h`: DOUBLE>>"


def weather_of_variant(doc: Column) -> Column:
    """The five fields of a VARIANT document, whatever its form: a standard document, one wrapped in ``raw_data``, or one whose
    ``weather`` is a plain text. A field of another type counts as missing; null without a document."""
    named = F.struct(
        *[
            F.try_variant_get(doc, f"$.{name}", kind).alias(name)
            for name, kind in (("weather", "ARRAY<STRUCT<main: STRING>>"), ("main", "STRUCT<temp: DOUBLE>"), ("wind", "STRUCT<speed: DOUBLE>"), ("visibility", "DOUBLE"), ("rain", "STRUCT<`1h`: DOUBLE>"))
        ]
    )
    is_text = F.schema_of_variant(F.try_variant_get(doc, "$.weather", "VARIANT")) == "STRING"
    text = F.when(is_text, F.try_variant_get(doc, "$.weather", "STRING"))
    packed = weather_struct(standard=named, raw_data=F.try_variant_get(doc, "$.raw_data", _DOCUMENT), legacy_text=text)
    return F.when(doc.isNotNull() & ~F.is_variant_null(doc), packed)


def weather_columns(packed: Column, prefix: str) -> dict[str, Column]:
    """The packed struct as ``{prefix}temperature`` ... columns."""
    return {f"{prefix}{name}": packed.getField(name) for name in WEATHER_FIELDS}
