"""Mixing sources to target weights by hash thresholds.

Every document has a hash of its id and text. A source that is to give more than its own size gives
whole rounds, then once more the documents whose hash lies below a threshold; one that is to give
less gives only those. A threshold is found from histograms: words are summed by source and hash bucket, the
bucket in which the budget runs out is found, and only that bucket is cut again into finer ones, until
it holds a single hash. Documents are never sorted, a larger budget takes a superset of what a smaller
one takes, and a rerun takes the same documents.

Defined results: a null text has size 0; null is a source of its own, the last one; a null id counts as
an empty id in the hash; identical rows share a hash and are taken or left together (the cut falls on
the side of them that is closer to the target); an empty table gives an empty mix. Input columns of the
names this module adds (``size``, ``source_size``, ``target``, ``copies``, ``taken``) are replaced.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tarmac.llm.common import WORD, numbered, shielded, text_of
from tarmac.session import cut_lineage

HASH_BITS = 60
LEVEL_BITS = 10


def size_of(text: str = "text") -> Column:
    """Words of a text."""
    return F.size(F.regexp_extract_all(text_of(text), F.lit(WORD), F.lit(0))).cast("long")


def hash_of(key: str = "doc_id", text: str = "text", seed: str = "") -> Column:
    """60 bits of the MD5 of id and text, as a number."""
    id_text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    digest = F.md5(F.concat(F.lit(seed), id_text, F.lit(":"), text_of(text)))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long")


def measure(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", seed: str = "") -> DataFrame:
    """One narrow row per document (``key``, ``source``, ``size``, ``hash``), stored so that texts are read once."""
    return cut_lineage(
        df.select(F.col(key), F.col(source).alias("source"), size_of(text).alias("size"), hash_of(key, text, seed).alias("hash"))
    )


def weigh(measured: DataFrame, weights: tuple[int, ...]) -> DataFrame:
    """Sizes of sources, with ``weights`` given in turn to the sources by code point, null last."""
    sizes = measured.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = numbered(sizes, [F.col("source").isNull(), F.col("source")], "rank")
    turn = F.array(*[F.lit(int(w)) for w in weights])
    weight = turn[(F.col("rank") % len(weights)).cast("int")].cast("long")
    return cut_lineage(ranked.select("source", "source_size", weight.alias("weight")))


def targets(sources: DataFrame, share: Fraction, most: int) -> DataFrame:
    """Add ``target``: ``share`` of all sizes by weight, at most ``most`` times a source's size.

    What a stopped source cannot take is shared among the others by weight, again until none is above.
    Each pass is one aggregate of the sources to three numbers; a pass that stops no more sources is the last.
    """
    cap = F.col("source_size") * most
    total = sources.agg(F.sum("source_size").alias("t")).first()["t"] or 0
    level, stopped = Fraction(0), None
    while True:
        # Exact: cap < level * weight, without leaving integers.
        above = cap.cast("decimal(38,0)") * F.lit(level.denominator) < F.col("weight").cast("decimal(20,0)") * F.lit(
            level.numerator
        )
        row = sources.agg(
            F.count_if(above).alias("n"),
            F.coalesce(F.sum(F.when(above, cap)), F.lit(0)).alias("caps"),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0)).alias("weight"),
        ).first()
        if row["n"] == stopped or not row["weight"]:
            break
        stopped = row["n"]
        budget = share * total - row["caps"]
        units, parts = budget.numerator, row["weight"] * budget.denominator
        level = Fraction(units, parts)
    shared = (
        (F.col("weight") * F.lit(units)).cast("double") / F.lit(float(parts)) if stopped is not None else F.lit(0.0)
    )
    return sources.withColumn("target", F.when(above, cap.cast("double")).otherwise(shared))


def thresholds(measured: DataFrame, sources: DataFrame) -> DataFrame:
    """Per source ``rounds`` (whole passes) and ``cut``: documents with a smaller hash are taken once more."""
    size = F.col("source_size")
    rounds = F.when(size > 0, F.floor(F.col("target") / size)).otherwise(0).cast("long")
    state = sources.withColumn("rounds", rounds).withColumn("left", F.col("target") - F.col("rounds") * size)
    state = cut_lineage(state)
    rows = measured
    open_, done = state.where("left > 0").select("source", "left"), []
    for level in range(1, HASH_BITS // LEVEL_BITS + 1):
        bucket = F.shiftright("hash", HASH_BITS - LEVEL_BITS * level)
        histogram = rows.groupBy("source", bucket.alias("bucket")).agg(
            F.sum("size").alias("words"), F.min("hash").alias("low"), F.max("hash").alias("high")
        )
        so_far = F.sum("words").over(
            W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, W.currentRow)
        )
        summed = histogram.withColumn("upto", so_far).withColumnRenamed("source", "_source")
        boundary = summed.join(open_, F.col("_source").eqNullSafe(F.col("source"))).where(
            "upto > left and upto - words <= left"
        )
        boundary = cut_lineage(
            boundary.select("source", "bucket", "words", "low", "high", (F.col("left") - F.col("upto") + F.col("words")).alias("left"))
        )
        ended = F.col("low") == F.col("high")
        take = F.col("left") * 2 >= F.col("words")
        done.append(boundary.where(ended).select("source", (F.col("low") + take.cast("long")).alias("cut")))
        if boundary.where(~ended).isEmpty():
            break
        open_ = boundary.where(~ended).select("source", "left")
        within = boundary.where(~ended).select(F.col("source").alias("_source"), F.col("bucket").alias("_bucket"))
        inside = rows.join(
            within, F.col("source").eqNullSafe(F.col("_source")) & (bucket == F.col("_bucket")), "left_semi"
        )
        # The first refinement keeps a thousandth of the rows, so later levels read next to nothing.
        rows = cut_lineage(inside) if level == 1 else inside
    cuts = done[0]
    for more in done[1:]:
        cuts = cuts.unionByName(more)
    cuts = cuts.withColumnRenamed("source", "_source")
    joined = state.join(cuts, F.col("_source").eqNullSafe(F.col("source")), "left")
    return cut_lineage(joined.select("source", "source_size", "target", "rounds", F.coalesce("cut", F.lit(0)).alias("cut")))


def plan(
    measured: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: Fraction = Fraction(3, 2), most: int = 2
) -> DataFrame:
    """The stored table of sources with sizes, targets, rounds and cuts for measured documents."""
    return thresholds(measured, targets(weigh(measured, weights), Fraction(share), most))


def assign(rows: DataFrame, planned: DataFrame, source: str = "source", hashed: str = "hash") -> DataFrame:
    """Add ``source_size``, ``target`` and ``copies`` to rows with a source and a hash."""
    rows = rows.drop("source_size", "target", "copies")
    cuts = planned.withColumnRenamed("source", "_source")
    copies = F.col("rounds") + (F.col(hashed) < F.col("cut")).cast("long")
    joined = rows.join(cuts, F.col("_source").eqNullSafe(F.col(source)), "left")
    return joined.withColumn("copies", copies).drop("_source", "rounds", "cut")


@shielded
def mix(
    df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
    weights: tuple[int, ...] = (3, 1, 2), share: Fraction = Fraction(3, 2), most: int = 2, seed: str = "",
) -> DataFrame:
    """The rows of ``df``, each as often as the mix takes it: repeated, once or not at all."""
    planned = plan(measure(df, key, text, source, seed), weights, share, most)
    names = df.columns
    marked = df.select(*[F.col(f"`{c}`") for c in names], hash_of(key, text, seed).alias("_hash"))
    sources = planned.select(F.col("source").alias("_mix"), F.col("rounds").alias("_rounds"), F.col("cut").alias("_cut"))
    joined = marked.join(sources, F.col("_mix").eqNullSafe(F.col(source)), "left")
    copies = (F.col("_rounds") + (F.col("_hash") < F.col("_cut")).cast("long")).cast("int")
    taken = joined.withColumn("_copies", copies).where("_copies > 0")
    return taken.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select(*[f"`{c}`" for c in names])
