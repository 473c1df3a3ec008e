"""Shards by fixed virtual slots and a stored map from slots to shards.

A record's key is hashed into one of some thousand slots, for good. Which shard a slot belongs to is told by a map of one row
per slot, kept as numbered versions in a folder. To rebalance, bytes are summed per slot and the map is edited: every shard keeps
slots, in an order of their own, up to an equal share of all bytes; the rest is dealt, the largest first, to the shard that has least. More shards take
slots only into themselves, fewer give theirs away, and a record moves only if its slot does.

A slot that holds more than a 64th of all bytes or rows (one key repeated very often) is listed in the map with one shard per part
of it; its rows are dealt to the parts by their places in the input. So no slot, shard or task is tied to one key.

Rows are numbered within each shard: within each slot by a window, after the rows of the slots before it. What meets in one task is
the map and its sizes, bounded by the number of slots and parts, never by the number of rows.

Defined results: a null text has no bytes and the CRC of nothing; every record counts one byte more than its text; a null key is a key
like others; repeated rows are placed each; rows of a split slot may change places between runs if the input is split otherwise; an empty
table has a map, but no rows. Input columns of the names this module adds (``size``, ``text_crc32``, ``law``, ``shard``, ``slot``,
``virtual_slot``, ``map_version``) are replaced, all others are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from tarmac.llm.common import computed, let, text_of
from tarmac.session import cut_lineage

SLOTS = 4096
PARTS = 64
LAW = "bytes"
ADDED = ("size", "text_crc32", "law", "shard", "slot", "virtual_slot", "map_version")


def slot_of(key: str, slots: int = SLOTS) -> Column:
    return F.pmod(F.xxhash64(F.col(f"`{key}`")), F.lit(slots)).cast("int")


def _part() -> Column:
    return F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(PARTS)).cast("int")


def measure(df: DataFrame, key: str = "doc_id", text: str = "text", slots: int = SLOTS) -> DataFrame:
    """One narrow row per record (``key``, ``size``, ``text_crc32``, ``virtual_slot``, ``part``), stored so that texts are read once."""
    body = text_of(text)
    return cut_lineage(
        df.select(
            F.col(f"`{key}`").alias("key"),
            (F.octet_length(body) + 1).cast("long").alias("size"),
            F.crc32(body.cast("binary")).alias("text_crc32"),
            slot_of(key, slots).alias("virtual_slot"),
            _part().alias("part"),
        )
    )


def sizes(measured: DataFrame) -> DataFrame:
    """Stored ``virtual_slot``, ``part``, ``parts``, ``bytes`` and ``rows``: one row per slot, or per part of a large slot."""
    cells = measured.groupBy("virtual_slot", "part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    cells = cut_lineage(cells)
    total = cells.agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows")).first()
    large = F.greatest(*[F.sum(c) * PARTS > F.lit(total[c] or 0) for c in ("bytes", "rows")])
    slots = cells.groupBy("virtual_slot").agg(F.when(large & (F.sum("rows") > 1), PARTS).otherwise(1).alias("parts"))
    parts = cells.join(F.broadcast(slots), "virtual_slot").withColumn("part", F.col("part") % F.col("parts"))
    return cut_lineage(parts.groupBy("virtual_slot", "part", "parts").agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows")))


def first_map(spark: SparkSession, shards: int, slots: int = SLOTS) -> DataFrame:
    """A map for slots of which nothing is known: they are dealt in turn."""
    return spark.range(slots).select(
        F.col("id").cast("int").alias("virtual_slot"), F.array((F.col("id") % shards).cast("int")).alias("shards")
    )


def _dealt(units: DataFrame, loads: Column) -> DataFrame:
    """Add ``shard`` to units in one row each: the largest first, each to the shard with the least load so far.

    ``loads`` is an array of (shard, load). All units, as many as the map lists, are one array of one row.
    """
    told = F.array_sort(F.collect_list(F.struct((-F.col("bytes")).alias("order"), "virtual_slot", "part", "parts")))
    start = F.struct(loads.alias("loads"), F.array().cast("array<int>").alias("taken"))

    def give(state: Column, unit: Column) -> Column:
        # An empty slot counts as one byte, so that empty slots spread.
        def to(least: Column) -> Column:
            shard = least["shard"]
            more = F.transform(
                state["loads"],
                lambda l: F.struct(
                    (l["load"] + F.when(l["shard"] == shard, F.greatest(-unit["order"], F.lit(1))).otherwise(0)).alias("load"),
                    l["shard"].alias("shard"),
                ),
            )
            return F.struct(more.alias("loads"), F.concat(state["taken"], F.array(shard)).alias("taken"))

        return let(F.array_min(state["loads"]), to)

    folded = units.agg(told.alias("units")).select("units", F.aggregate("units", start, give)["taken"].alias("taken"))
    one = F.explode(F.arrays_zip("units", "taken")).alias("one")
    return folded.select(one).select("one.units.virtual_slot", "one.units.part", "one.units.parts", F.col("one.taken").alias("shard"))


def rebalance(mapping: DataFrame, measured: DataFrame, shards: int) -> DataFrame:
    """``mapping`` edited for the bytes that ``sizes`` has told and for ``shards`` shards."""
    per_slot = measured.select("virtual_slot", F.col("parts").alias("now")).distinct()
    listed = mapping.join(F.broadcast(per_slot), "virtual_slot", "left")
    parts = F.coalesce(F.col("now"), F.lit(1))
    listed = listed.select(
        "virtual_slot", "shards", parts.alias("parts"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("part")
    )
    sized = listed.join(F.broadcast(measured.drop("parts", "rows")), ["virtual_slot", "part"], "left")
    old = F.col("shards")[F.col("part") % F.size("shards")]
    units = cut_lineage(sized.select("virtual_slot", "part", "parts", old.alias("old"), F.coalesce("bytes", F.lit(0)).alias("bytes")))
    known = units.agg(F.sum("bytes").alias("bytes"), F.max("old").alias("last")).first()
    equal = -(-(known["bytes"] or 0) // shards)
    upto = F.sum("bytes").over(
        W.partitionBy("old").orderBy(F.xxhash64("virtual_slot", "part")).rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    stays = (F.col("old") < shards) & (F.col("upto") <= equal)
    judged = cut_lineage(units.withColumn("upto", upto).withColumn("stays", stays).drop("upto"))
    kept, free = judged.where("stays"), judged.where("not stays")
    # With more shards than before, the new ones alone take slots.
    open_from = known["last"] + 1 if known["last"] is not None and known["last"] + 1 < shards else 0
    held = {r["old"]: r["bytes"] for r in kept.groupBy("old").agg(F.sum("bytes").alias("bytes")).collect()}
    loads = F.array(
        *[F.struct(F.lit(held.get(s, 0)).cast("long").alias("load"), F.lit(s).alias("shard")) for s in range(open_from, shards)]
    )
    dealt = _dealt(free, loads).select("virtual_slot", "part", "shard")
    whole = kept.select("virtual_slot", "part", F.col("old").alias("shard")).unionByName(dealt)
    ordered = F.array_sort(F.collect_list(F.struct("part", "shard")))
    return cut_lineage(whole.groupBy("virtual_slot").agg(F.transform(ordered, lambda p: p["shard"]).alias("shards")))


def save(mapping: DataFrame, folder: str, version: int) -> None:
    """Store a map as a version of its own; a version is never overwritten."""
    mapping.write.mode("error").parquet(f"{folder}/version={version}")


def load(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame:
    """A stored map with its ``map_version``; the newest one, if none is named."""
    stored = spark.read.parquet(folder).withColumn("map_version", F.col("version").cast("int")).drop("version")
    if version is None:
        version = stored.agg(F.max("map_version")).first()[0]
    return stored.where(F.col("map_version") == version)


def place(measured: DataFrame, mapping: DataFrame) -> DataFrame:
    """Add ``shard``, ``slot`` (the row's number in its shard, from 0) and ``map_version`` to measured rows."""
    told = measured.join(F.broadcast(mapping), "virtual_slot").withColumn("part", F.col("part") % F.size("shards"))
    told = told.withColumn("shard", F.col("shards")[F.col("part")]).drop("shards")
    counts = told.groupBy("shard", "virtual_slot", "part").agg(F.count("*").alias("rows"))
    before = W.partitionBy("shard").orderBy("virtual_slot", "part").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select("virtual_slot", "part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    within = F.row_number().over(W.partitionBy("virtual_slot", "part").orderBy("key", "text_crc32", "size")) - 1
    joined = told.withColumn("within", within).join(F.broadcast(starts), ["virtual_slot", "part"])
    return joined.withColumn("slot", F.col("start") + F.col("within")).drop("start", "within", "part")


def assign(df: DataFrame, folder: str, shards: int, key: str = "doc_id", text: str = "text", slots: int = SLOTS) -> DataFrame:
    """Measure the records, bring the map in ``folder`` up to date with a new version, and place the records by it.

    Without a map in the folder, the first version deals the slots in turn. A map of another number of slots is refused.
    """
    spark = df.sparkSession
    measured = measure(df, key, text, slots)
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    if not target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target):
        save(first_map(spark, shards, slots), folder, 0)
    newest = load(spark, folder)
    about = newest.agg(F.max("map_version").alias("version"), F.count("*").alias("slots")).first()
    if about["slots"] != slots:
        raise ValueError(f"the map in {folder} has {about['slots']} slots, not {slots}")
    save(rebalance(newest.drop("map_version"), sizes(measured), shards), folder, about["version"] + 1)
    return place(measured, load(spark, folder)).withColumn("law", F.lit(LAW))


def write(df: DataFrame, mapping: DataFrame, path: str, key: str = "doc_id", text: str = "text", slots: int = SLOTS) -> None:
    """Write whole records to one folder per shard (``shard=N``), large shards as several files."""
    others = [f"`{c}`" for c in df.columns if c not in ADDED]
    row = df.select(F.struct(*others).alias("row"), slot_of(key, slots).alias("virtual_slot"), _part().alias("part"))
    told = row.join(F.broadcast(mapping.select("virtual_slot", "shards")), "virtual_slot")
    shard = F.col("shards")[F.col("part") % F.size("shards")]
    computed(told, shard=shard).select("row.*", "shard").hint("rebalance", "shard").write.partitionBy("shard").parquet(path)
