"""A prefix trie of conversations by collapse of whole sequences.

Conversations are rebuilt first: the opening turns of one in a hundred are shared by the others. Identical rebuilt conversations
become one weighted sequence with the list of the conversations that end there. A sequence that is a proper prefix of another is dropped
by an anti-join, which leaves the leaves. Every node is the aggregate of the weighted sequences it is a prefix of.

A prefix is told by its depth and 120 bits: the exclusive or of SHA-256 digests of (place, role, text) of its turns. So the prefixes of
one conversation are running values that need no state but the last one, and a conversation is not tied to a task: turns are dealt out by range of
(conversation, turn), each partition carries its values from row to row, and only one row per partition meets in one task
to carry them on. What a subtree saves comes from sums per sequence, without pairs of nodes and ancestors: each node belongs to the
sequence of its least conversation, so that the nodes of a sequence are the last ones of its path.

Lists of ends are cut into pieces of ``PIECE`` numbers; the pieces of one node are hashed in order by one task that holds
one batch of them at a time.

Defined results: rows without a conversation id take no part; turns of equal number stand by role, then by digest; repeated rows are
turns each; null role and text are empty; the conversation that gives the opening is ``c - c % stride`` with the sign of ``c`` kept in the
remainder; an empty table has no nodes, not even a root. Other columns of the input, of whatever name, are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window as W, functions as F
from pyspark.sql.types import IntegerType, LongType, StructType

from tarmac.llm.common import computed, text_of, worker_path
from tarmac.session import cut_lineage

STRIDE = 100
HEADS = 6
PIECE = 4096
_NODE = ("depth", "a", "b")


def _within(key: str, xors: dict[str, str], sums: dict[str, str]):
    """Number the sorted rows of a partition within each key, with running exclusive ors and sums."""

    def run(batches):
        part, last, at_last = TaskContext.get().partitionId(), None, {"place": 0, **dict.fromkeys([*xors, *sums], 0)}
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            keys = batch.column(key).to_numpy(zero_copy_only=False)
            begins = np.r_[last is None or keys[0] != last, keys[1:] != keys[:-1]]
            at = np.arange(n)
            # -1: the key has begun in the batch before.
            start = np.maximum.accumulate(np.where(begins, at, -1))
            goes_on = start < 0
            made = {"place": at - start + 1 + np.where(goes_on, at_last["place"] - 1, 0)}
            for names, running, back in ((xors, np.bitwise_xor, np.bitwise_xor), (sums, np.add, np.subtract)):
                for new, old in names.items():
                    whole = running.accumulate(batch.column(old).to_numpy(zero_copy_only=False).astype(np.int64))
                    before = np.where(start > 0, whole[np.maximum(start, 1) - 1], 0)
                    made[new] = running(back(whole, before), np.where(goes_on, at_last[new], 0))
            last, at_last = keys[-1], {k: int(v[-1]) for k, v in made.items()}
            columns = [pa.array(v, pa.int64()) for v in made.values()] + [pa.array(np.full(n, part, np.int32))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, *made, "part"])

    return run


def carried(df: DataFrame, key: str, order: list[Column], xors: dict[str, str], sums: dict[str, str]) -> DataFrame:
    """Add ``place`` (from 1, within the long ``key``, in the given order) and running exclusive ors and sums; stored.

    ``xors`` and ``sums`` map new columns to old ones.
    """
    names = [f"_order{i}" for i in range(len(order))]
    # The last part of the order lets equal rows be dealt to several partitions.
    keyed = df.select("*", *[c.alias(n) for c, n in zip(order, names)], F.monotonically_increasing_id().alias("_row"))
    names = [key, *[F.asc_nulls_first(n) for n in names], "_row"]
    dealt = keyed.repartitionByRange(*names).sortWithinPartitions(*names).select(*df.columns)
    made = ["place", *xors, *sums]
    schema = StructType(list(df.schema.fields))
    for name in made:
        schema.add(name, LongType())
    stored = cut_lineage(dealt.mapInArrow(_within(key, xors, sums), schema.add("part", IntegerType())))
    edges = stored.groupBy("part").agg(F.min(key).alias("first"), F.max(F.struct(key, *made)).alias("tail"))
    run = W.partitionBy(F.col("tail")[key]).orderBy("part")
    handed = [F.sum(f"tail.{c}").over(run).alias(c) for c in ("place", *sums)] + [F.bit_xor(f"tail.{c}").over(run).alias(c) for c in xors]
    upto = edges.select("part", "first", F.col("tail")[key].alias("last"), *handed)
    before = F.lag(F.struct("last", *made)).over(W.orderBy("part"))
    carry = upto.select(F.col("part").alias("_part"), "first", before.alias("carry")).where("carry.last = first")
    # One row per partition.
    joined = stored.join(F.broadcast(carry), (F.col("part") == F.col("_part")) & (F.col(key) == F.col("first")), "left")

    def plus(name: str) -> Column:
        more = F.coalesce(F.col("carry")[name], F.lit(0))
        return (F.col(name).bitwiseXOR(more) if name in xors else F.col(name) + more).alias(name)

    return joined.select(*df.columns, *[plus(c) for c in made])


def _bits(digest: Column, first: int) -> Column:
    return F.conv(F.substring(digest, first, 15), 16, 10).cast("long")


def placed(
    df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", texts: bool = False
) -> DataFrame:
    """``conv``, ``place``, ``told`` (digest of role and text) and ``chars`` of all turns; with ``texts`` also ``role`` and ``text``."""
    worker_path(df.sparkSession)
    said_by, body = text_of(role), text_of(text)
    told = F.sha2(F.concat(F.length(said_by).cast("string"), F.lit(":"), said_by, body), 256)
    rows = df.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"), F.col(turn).alias("turn"), said_by.alias("role"), told.alias("told"),
        F.length(body).cast("long").alias("chars"), *([body.alias("text")] if texts else []),
    )
    out = carried(rows, "conv", [F.col("turn"), F.col("role"), F.col("told")], {}, {})
    return out.select("conv", "place", "told", "chars", *(["role", "text"] if texts else []))


def rebuilt(turns: DataFrame, stride: int = STRIDE, heads: int = HEADS) -> tuple[DataFrame, DataFrame]:
    """Placed turns rebuilt: ``conv``, ``place``, ``told``, ``chars`` and where each comes from; and all ``conv`` with ``n_turns``.

    A conversation takes the first ``crc32(conv) % heads`` turns of the one at the multiple of ``stride`` before it, then
    its own after as many.
    """
    base = (F.col("conv") - F.col("conv") % stride).alias("base")
    head = (F.crc32(F.col("conv").cast("string").cast("binary")) % heads).cast("int").alias("head")
    opening = turns.where((F.col("conv") % stride == 0) & (F.col("place") < heads)).groupBy(F.col("conv").alias("base"))
    given = F.array_sort(F.collect_list(F.struct("place", "told", "chars"))).alias("given")
    bases = cut_lineage(opening.agg(given))
    lent = F.least("head", F.coalesce(F.size("given"), F.lit(0)))
    members = turns.groupBy("conv").agg(F.count("*").alias("own")).select("conv", "own", base, head).join(bases, "base", "left")
    members = members.withColumn("lent", lent)
    taken = F.explode(F.slice("given", F.lit(1), F.col("lent"))).alias("one")
    shared = members.where("lent > 0").select("conv", F.col("base").alias("from_conv"), taken)
    shared = shared.select("conv", "one.*", "from_conv", F.col("one.place").alias("from_place"))
    own = turns.select("*", base, head).where("place > head")
    own = own.join(bases.select("base", F.size("given").alias("there")), "base", "left")
    place = F.col("place") - F.col("head") + F.least("head", F.coalesce("there", F.lit(0)))
    own = own.select("conv", place.alias("place"), "told", "chars", F.col("conv").alias("from_conv"), F.col("place").alias("from_place"))
    whole = members.select("conv", (F.col("lent") + F.greatest(F.col("own") - F.col("head"), F.lit(0))).alias("n_turns"))
    return shared.unionByName(own), whole


def prefixes(turns: DataFrame) -> DataFrame:
    """Every prefix of every conversation but the empty one: ``conv``, ``depth``, ``a``, ``b``, those of the parent, ``chars`` and ``upto``."""
    digest = F.sha2(F.concat(F.col("place").cast("string"), F.lit(":"), F.col("told")), 256)
    coded = turns.select("conv", F.col("place").alias("at"), "chars", "from_conv", "from_place", digest.alias("digest"))
    halves = {"ha": _bits(F.col("digest"), 1), "hb": _bits(F.col("digest"), 16)}
    coded = computed(coded, **halves).drop("digest")
    run = carried(coded, "conv", [F.col("at")], {"a": "ha", "b": "hb"}, {"upto": "chars"})
    return run.select(
        "conv", F.col("place").alias("depth"), "a", "b", F.col("a").bitwiseXOR(F.col("ha")).alias("pa"),
        F.col("b").bitwiseXOR(F.col("hb")).alias("pb"), "chars", "upto", "from_conv", "from_place",
    )


def _hashed(batches):
    """SHA-256 of the joined pieces of each sequence; pieces come in order."""
    name, state = None, None
    schema = pa.schema([("conv", pa.int64()), ("ends_sha256", pa.string())])

    def told(found):
        return pa.RecordBatch.from_pydict({"conv": [f[0] for f in found], "ends_sha256": [f[1] for f in found]}, schema)

    for batch in batches:
        found = []
        for conv, piece in zip(batch.column("seq").to_pylist(), batch.column("piece").to_pylist(), strict=True):
            if conv != name:
                if state is not None:
                    found.append((name, state.hexdigest()))
                name, state = conv, hashlib.sha256(piece.encode())
            else:
                state.update(b"," + piece.encode())
        yield told(found)
    if state is not None:
        yield told([(name, state.hexdigest())])


def end_hashes(ends: DataFrame) -> DataFrame:
    """``conv`` (the least of a sequence) and ``ends_sha256`` of the ascending numbers ``end`` of the conversations of each ``seq``."""
    numbered = carried(ends, "seq", [F.col("end")], {}, {})
    piece = F.floor((F.col("place") - 1) / PIECE).alias("at")
    listed = F.transform(F.array_sort(F.collect_list("end")), lambda e: e.cast("string"))
    pieces = numbered.groupBy("seq", piece).agg(F.array_join(listed, ",").alias("piece"))
    return pieces.repartition("seq").sortWithinPartitions("seq", "at").mapInArrow(_hashed, "conv long, ends_sha256 string")


def trie(turns: DataFrame, whole: DataFrame) -> DataFrame:
    """The nodes of rebuilt turns: what the contract's columns tell, and where each node's last turn stands.

    ``turns`` and ``whole`` are what ``rebuilt`` gives.
    """
    run = cut_lineage(prefixes(turns))
    last = run.groupBy("conv").agg(F.max(F.struct("depth", "a", "b", "upto")).alias("last"))
    zero = F.lit(0).cast("long")
    ends = whole.select("conv").join(last, "conv", "left")
    ends = cut_lineage(ends.select("conv", *[F.coalesce(f"last.{c}", zero).alias(c) for c in ("depth", "a", "b", "upto")]))
    sequences = cut_lineage(
        ends.groupBy(*_NODE).agg(F.min("conv").alias("conv"), F.count("*").alias("weight"), F.min("upto").alias("total"))
    )
    # The paths of the sequences, one for all copies, and the root of each.
    root = {"depth": zero, "a": zero, "b": zero, "chars": zero, "upto": zero}
    none = F.lit(None).cast("long")
    roots = sequences.select("conv", *[root.get(c, none).alias(c) for c in run.columns if c != "conv"])
    paths = cut_lineage(run.join(sequences.select("conv"), "conv", "left_semi").unionByName(roots))
    nodes = cut_lineage(
        paths.groupBy(*_NODE).agg(F.min("conv").alias("owner"), F.min("chars").alias("chars"), F.min("pa").alias("pa"), F.min("pb").alias("pb"))
    )
    above = (F.col("depth") - 1).alias("depth")
    children = nodes.where("depth > 0").groupBy(above, F.col("pa").alias("a"), F.col("pb").alias("b"))
    children = cut_lineage(children.agg(F.count("*").alias("n_children")))
    leaves = sequences.join(children, list(_NODE), "left_anti").select("conv", F.lit(1).cast("long").alias("leaf"))
    owned = nodes.groupBy(F.col("owner").alias("conv")).agg(F.sum("chars").alias("owned"))
    known = sequences.select("conv", "weight", "total").join(owned, "conv", "left").join(leaves, "conv", "left")
    known = known.select("conv", "weight", "total", *[F.coalesce(c, zero).alias(c) for c in ("owned", "leaf")])
    first = F.min(F.struct("conv", "owned", "total", "chars", "upto", "pa", "pb", "from_conv", "from_place")).alias("o")
    sums = paths.join(known, "conv").groupBy(*_NODE).agg(
        first, F.sum("weight").alias("n_convs"), F.sum("leaf").alias("n_leaves"), F.sum("owned").alias("owned"),
        F.sum(F.col("weight") * F.col("total")).alias("total"),
    )
    # Below a node: turns of all members less those of the distinct nodes, both from the node on.
    of_members = F.col("total") - F.col("n_convs") * (F.col("o.upto") - F.col("o.chars"))
    of_nodes = F.col("owned") - F.col("o.owned") + F.col("o.total") - F.col("o.upto") + F.col("o.chars")
    seq = sequences.select(*_NODE, F.col("conv").alias("seq"))
    hashes = end_hashes(ends.select(F.col("conv").alias("end"), *_NODE).join(seq, list(_NODE)).select("seq", "end"))
    at_node = seq.join(hashes.withColumnRenamed("conv", "seq"), "seq").select(*_NODE, "ends_sha256")
    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("owner").alias("parent_conv_id")
    )
    flat = sums.select(
        *_NODE, F.col("o.conv").alias("conv_id"), "o.pa", "o.pb", "n_convs", "n_leaves", (of_members - of_nodes).alias("saved_tokens"),
        "o.from_conv", "o.from_place",
    )
    joined = flat.join(children, list(_NODE), "left").join(at_node, list(_NODE), "left").join(parents, ["depth", "pa", "pb"], "left")
    return joined.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", zero).alias("n_children"), "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"), "from_conv", "from_place",
    )


def build(
    df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", stride: int = STRIDE, heads: int = HEADS
) -> DataFrame:
    """The nodes of the trie of the rebuilt conversations of ``df``."""
    return trie(*rebuilt(placed(df, conv, turn, role, text), stride, heads))


def with_texts(nodes: DataFrame, df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Nodes with ``role`` and ``text`` of their last turn; the root has none."""
    said = placed(df, conv, turn, role, text, texts=True).select(
        F.col("conv").alias("from_conv"), F.col("place").alias("from_place"), "role", "text"
    )
    return nodes.join(said, ["from_conv", "from_place"], "left").drop("from_conv", "from_place")
