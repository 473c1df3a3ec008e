"""Near duplicates by Order MinHash.

Texts become words (runs of letters and digits, lower case) and runs of five words, each labelled with its occurrence
number. For every hash function the runs with the least hashes are kept in the order of the text, and a
sketch is the hash of that sequence: texts share it if they share the runs and their order. Two lengths of
sequence are used, a short one that finds every similar pair and a long one that only very similar texts share.

Texts with the same words are one text from the start. All members of a short or long bucket meet the bucket's least
member; those of a bucket with more than ``MEET`` open members also meet its pivot, one with much company in such buckets. Then members
of a bucket that are still in different components meet each other, each pair once: in smaller buckets if the counts of their
labelled runs, by parts of the hashes, leave the similarity possible, in larger ones if what they have beyond the pivot does (see
``_unlike_pivot``). A pair is verified by aligning the
sequences of five-word runs, within the band that a similarity at the threshold can leave at most: runs
matched in order over all runs must be ``least`` or more. Components of the verified pairs are the classes. No pair is made
that the components already answer, and no group is gathered in one task.

Defined results: a null or wordless text is in a class of its own; a text shorter than five words is one run;
the class is the smallest id in it (null if no row of it has one); repeated rows share a class; an empty
table gives an empty result. Other input columns are ignored by ``classes`` and kept by ``keep_one``.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import reduce
from operator import and_

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from tarmac.llm.common import shielded, text_of, worker_path
from tarmac.llm.components import components
from tarmac.session import cut_lineage

RUN = 5
LEAST = 0.8
FUNCTIONS = 16
SHORT, LONG = 4, 10
#: Node names that may be sent to all tasks, about 64 MB.
MAX_SENT = 1_000_000
MAX_WORDS_KEPT = 400_000
#: Hashes made at once for one text, so that a very long one needs no more memory.
MAX_HASHES = 2_000_000
_WORDS = re.compile(r"\w+")
#: Labelled runs are counted by so many leading bits of their hashes.
COUNT_BITS = 7
#: Open members of a bucket that meet pair by pair; those of larger ones are told apart by what they have beyond a pivot.
MEET = 32
#: One in so many members of a large bucket tells which runs are frequent, up to so many runs, about 16 MB.
COUNTED = 4
MAX_COUNTED = 1_000_000
_MEASURED = "doc_id long, raw binary, node binary, sketches array<long>, counts binary, body binary"


def words_of(text: str) -> list[str]:
    return _WORDS.findall(text.lower())


class Hashes(dict):
    """64-bit hashes of the words seen lately."""

    def __missing__(self, word: str) -> int:
        if len(self) >= MAX_WORDS_KEPT:
            self.clear()
        self[word] = value = int.from_bytes(hashlib.blake2b(word.encode(), digest_size=8).digest(), "little")
        return value


_HASHES = Hashes()
_SEEDS = np.random.default_rng(9)
_FACTORS = _SEEDS.integers(1, 2**63, RUN, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_XORS = _SEEDS.integers(0, 2**63, FUNCTIONS, dtype=np.uint64)
_TIMES = _SEEDS.integers(1, 2**63, FUNCTIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def runs_of(words: list[str]) -> np.ndarray:
    """Hashes of all runs of words, in order."""
    ids = np.fromiter(map(_HASHES.__getitem__, words), dtype=np.uint64, count=len(words))
    size = min(RUN, len(ids))
    out = np.zeros(len(ids) - size + 1, dtype=np.uint64)
    for j in range(size):
        out = _mix(out + ids[j : j + len(out)] * _FACTORS[j])
    return out


def labelled(runs: np.ndarray) -> np.ndarray:
    """Hashes of (run, how often it came before)."""
    order = np.argsort(runs, kind="stable")
    ordered = runs[order]
    begins = np.r_[True, ordered[1:] != ordered[:-1]]
    place = np.arange(len(runs))
    before = np.empty(len(runs), dtype=np.uint64)
    before[order] = place - np.maximum.accumulate(np.where(begins, place, 0))
    return _mix(runs + before * np.uint64(0xD1B54A32D192ED03))


def counts_of(named: np.ndarray) -> bytes:
    """How many labelled runs there are by the leading bits of their hashes."""
    return np.bincount((named >> np.uint64(64 - COUNT_BITS)).astype(np.int64), minlength=1 << COUNT_BITS).astype("<u4").tobytes()


def may_match(a: np.ndarray, b: np.ndarray, least: float = LEAST) -> np.ndarray:
    """Whether rows of counts leave the similarity possible: equal labelled runs are in the same part, so no more can match."""
    a, b = a.astype(np.int64), b.astype(np.int64)
    total = a.sum(axis=1) + b.sum(axis=1)
    return np.minimum(a, b).sum(axis=1) >= np.ceil(least * total / (1 + least) - 1e-9)


def sketches(runs: np.ndarray, lengths: tuple[int, ...] = (SHORT, LONG), named: np.ndarray | None = None) -> list[int]:
    """For each hash function and length: a hash of the runs with the least hashes, in the order of the text."""
    named = labelled(runs) if named is None else named
    most = min(max(lengths), len(runs))
    at_once = max(1, MAX_HASHES // len(runs))
    out = []
    for f in range(0, FUNCTIONS, at_once):
        xors, times = _XORS[f : f + at_once, None], _TIMES[f : f + at_once, None]
        hashed = _mix((named[None, :] ^ xors) * times)
        least = np.argpartition(hashed, most - 1, axis=1)[:, :most]
        least = np.take_along_axis(least, np.argsort(np.take_along_axis(hashed, least, 1), axis=1), 1)
        keys = []
        for n in lengths:
            kept = runs[np.sort(least[:, :n], axis=1)]
            key = _mix(xors[:, 0] + np.uint64(n))
            for column in kept.T:
                key = _mix(key * _TIMES[0] + column)
            keys.append(key)
        out += np.stack(keys, axis=1).ravel().view(np.int64).tolist()
    return out


def aligned(a: list, b: list, least: int) -> int:
    """Length of the longest common subsequence of ``a`` and ``b`` if it is ``least`` or more, else 0.

    Only places within the band are matched: with ``least`` matches at most len - least items of either are skipped.
    A row of the alignment is one integer, a bit per place of ``a``; additions carry along it.
    """
    if sum((Counter(a) & Counter(b)).values()) < least:
        return 0
    begin, end = 0, 0
    while begin < min(len(a), len(b)) and a[begin] == b[begin]:
        begin += 1
    while end < min(len(a), len(b)) - begin and a[-1 - end] == b[-1 - end]:
        end += 1
    inner_a, inner_b = a[begin : len(a) - end], b[begin : len(b) - end]
    left, right = len(a) - least, len(b) - least
    places = defaultdict(list)
    for i, x in enumerate(inner_a):
        places[x].append(i)
    full = (1 << len(inner_a)) - 1
    row = full
    for j, x in enumerate(inner_b):
        here = 0
        for i in places.get(x, ()):
            if -right <= i - j <= left:
                here |= 1 << i
        if here:
            met = row & here
            row = ((row + met) | (row - met)) & full
    matched = begin + end + len(inner_a) - row.bit_count()
    return matched if matched >= least else 0


def similarity(a: list[str], b: list[str], least: float = LEAST) -> float:
    """Runs matched in order over all runs of both texts; 0 if below ``least``."""
    names: dict[tuple, int] = {}

    def runs(words):
        size = min(RUN, len(words))
        return [names.setdefault(tuple(words[i : i + size]), len(names)) for i in range(len(words) - size + 1)]

    x, y = runs(a), runs(b)
    total = len(x) + len(y)
    # matched / (total - matched) >= least
    needed = int(np.ceil(least * total / (1 + least) - 1e-9))
    if min(len(x), len(y)) < needed:
        return 0.0
    matched = aligned(x, y, needed)
    return matched / (total - matched) if matched else 0.0


def measure(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One stored row per document: id, digest of the text, digest of its words, sketches, packed words."""
    worker_path(df.sparkSession)
    names = [c.split()[0] for c in _MEASURED.split(", ")]

    def sketch(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        packer = zstandard.ZstdCompressor(level=1)
        for part in parts:
            rows = []
            for doc_id, no_id, raw, body in zip(part["doc_id"], part["no_id"], part["raw"], part["text"], strict=True):
                words = words_of(body)
                joined = " ".join(words).encode()
                node = hashlib.blake2b(joined, digest_size=16).digest() if words else None
                doc_id = None if no_id else doc_id
                keys, counts = [], b""
                if words:
                    runs = runs_of(words)
                    named = labelled(runs)
                    keys, counts = sketches(runs, named=named), counts_of(named)
                rows.append((doc_id, raw, node, keys, counts, packer.compress(joined)))
            out = pd.DataFrame(rows, columns=names, dtype=object)
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    body = F.make_valid_utf8(text_of(text))
    # A null among the ids would make pandas read them all as floats.
    doc_id, raw = F.col(key).cast("long"), F.unhex(F.md5(text_of(text)))
    rows = df.select(
        F.coalesce(doc_id, F.lit(0)).alias("doc_id"), doc_id.isNull().alias("no_id"), raw.alias("raw"), body.alias("text")
    )
    return cut_lineage(rows.mapInPandas(sketch, _MEASURED))


def verified(pairs: DataFrame, bodies: DataFrame, least: float = LEAST) -> DataFrame:
    """The stored pairs (``u``, ``v``) of nodes whose texts are similar enough."""

    def align(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        packer = zstandard.ZstdDecompressor()
        for part in parts:
            similar = [
                similarity(packer.decompress(a).decode().split(" "), packer.decompress(b).decode().split(" "), least) >= least
                for a, b in zip(part["a"], part["b"], strict=True)
            ]
            yield part.loc[similar, ["u", "v"]]

    first = bodies.select(F.col("node").alias("u"), F.col("body").alias("a"))
    second = bodies.select(F.col("node").alias("v"), F.col("body").alias("b"))
    return cut_lineage(pairs.join(first, "u").join(second, "v").mapInPandas(align, "u binary, v binary"))


def _still_open(members: DataFrame, groups: DataFrame) -> DataFrame:
    """Stored members, with ``label``, of buckets that hold several components, without the least members, which met all others."""
    label = F.coalesce("least", "node").alias("label")
    named = cut_lineage(members.join(groups, "node", "left").select("key", "node", "leader", label))
    mixed = named.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high")
    return cut_lineage(named.join(cut_lineage(mixed.select("key")), "key", "left_semi").where("node <> leader"))


def _pivots(open_: DataFrame, large: DataFrame) -> DataFrame:
    """Stored pairs of a pivot ``u`` and each open member ``v`` of the large buckets it is the pivot of.

    Every member knows the one with the most company in the buckets it is in, and the one that most members of a bucket know is
    its pivot, so that buckets of one template share theirs.
    """
    inside = cut_lineage(open_.join(large, "key").select("key", "node", "n"))
    company = cut_lineage(inside.groupBy("node").agg(F.sum("n").alias("company")))
    most = inside.join(company, "node").groupBy("key").agg(F.max(F.struct("company", "node")).alias("most"))
    known = inside.join(cut_lineage(most), "key").groupBy("node").agg(F.max("most").alias("most"))
    votes = inside.join(cut_lineage(known.select("node", F.col("most.node").alias("u"))), "node").groupBy("key", "u").agg(F.count("*").alias("n"))
    chosen = votes.groupBy("key").agg(F.max(F.struct("n", "u")).alias("most")).select("key", "most.u")
    return cut_lineage(inside.join(cut_lineage(chosen), "key").select("u", F.col("node").alias("v")).distinct())


def compared(pairs: DataFrame, bodies: DataFrame, least: float = LEAST) -> DataFrame:
    """The stored pairs with ``alike``, ``size`` (labelled runs of ``v``) and ``own``, those of them that ``u`` lacks."""
    fields = "u binary, v binary, alike boolean, size long, own array<long>"

    def differ(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        packer = zstandard.ZstdDecompressor()
        for part in parts:
            rows = []
            for u, v, *packed in zip(part["u"], part["v"], part["a"], part["b"], strict=True):
                a, b = (packer.decompress(x).decode().split(" ") for x in packed)
                one, two = labelled(runs_of(a)), labelled(runs_of(b))
                rows.append((u, v, u != v and similarity(a, b, least) >= least, len(two), np.setdiff1d(two, one).view(np.int64)))
            yield pd.DataFrame(rows, columns=[f.split()[0] for f in fields.split(", ")])

    first = bodies.select(F.col("node").alias("u"), F.col("body").alias("a"))
    second = bodies.select(F.col("node").alias("v"), F.col("body").alias("b"))
    return cut_lineage(pairs.join(first, "u").join(second, "v").mapInPandas(differ, fields))


def _common(size_u: Column, size_v: Column, least: float) -> Column:
    """How many labelled runs two similar texts have in common at least."""
    return F.ceil((size_u + size_v) * F.lit(least / (1 + least)) - F.lit(1e-9))


def _rarest_first(each: DataFrame) -> DataFrame:
    """Stored rows of ``each`` with ``at`` and ``run``, for as many of their runs as the other text may lack, and one more: the rarest first.

    Any order will do that all members of a pivot share, so it need not be exact: runs are counted over one in ``COUNTED`` members, and the
    counts of the ``MAX_COUNTED`` most frequent ones are sent to the tasks. All others are of equal rank and stand by their hashes.
    """

    def named(pivot: bytes, own: np.ndarray) -> np.ndarray:
        return _mix(own.astype(np.int64).view(np.uint64) ^ np.frombuffer(pivot[:8], dtype=np.uint64)).view(np.int64)

    def listed(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            runs = [named(p, own) for p, own in zip(part["pivot"], part["own"], strict=True)]
            yield pd.DataFrame({"run": np.concatenate(runs) if runs else np.empty(0, dtype=np.int64)})

    some = each.where(F.pmod(F.xxhash64("v"), F.lit(COUNTED)) == 0).select("pivot", "own").mapInPandas(listed, "run long")
    often = some.groupBy("run").agg(F.count("*").alias("n")).where("n > 1")
    often = often.orderBy(F.desc("n"), "run").limit(MAX_COUNTED).toPandas().sort_values("run")
    told = each.sparkSession.sparkContext.broadcast((often["run"].to_numpy(dtype=np.int64), often["n"].to_numpy(dtype=np.int64)))
    kept = ["pivot", "v", "size", "label", "stray"]

    def place(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counted, counts = told.value
        for part in parts:
            places = []
            for pivot, own, most in zip(part["pivot"], part["own"], part["most"], strict=True):
                runs = named(pivot, own)
                if len(counted) and len(runs):
                    near = np.minimum(np.searchsorted(counted, runs), len(counted) - 1)
                    often = np.where(counted[near] == runs, counts[near], 0)
                    runs = runs[np.lexsort((runs, often))]
                else:
                    runs = np.sort(runs)
                places.append(runs[: most + 1])
            lengths = [len(x) for x in places]
            out = part.loc[np.repeat(part.index, lengths), kept].reset_index(drop=True)
            out["at"] = np.concatenate([np.arange(n) for n in lengths]) if lengths else np.empty(0, dtype=np.int64)
            out["run"] = np.concatenate(places) if lengths else np.empty(0, dtype=np.int64)
            yield out

    fields = "pivot binary, v binary, size long, label binary, stray boolean, at long, run long"
    return cut_lineage(each.select(*kept, "own", "most").mapInPandas(place, fields))


def _unlike_pivot(against: DataFrame, groups: DataFrame, least: float) -> DataFrame:
    """Pairs ``u`` < ``v`` in different components that have much the same runs beyond a pivot; no similar pair with that pivot is missing.

    Of two similar texts neither has more runs that the other lacks than ``_common`` leaves it, and so it is with what each has
    beyond a third text. A pair with so few runs beyond the pivot is possible by their numbers alone. Any other has one of these runs in
    common, and in an order they share the first one in common is not behind more runs than the other text may lack. Runs that the
    pivot alone has are not needed, nor those behind too many for every size there is. Members of the pivot's own component do not meet
    each other.
    """
    of_v = groups.select(F.col("node").alias("v"), F.col("least").alias("label"))
    of_u = groups.select(F.col("node").alias("u"), F.col("least").alias("home"))
    label, home = F.coalesce("label", "v"), F.coalesce("home", "u")
    shortest = cut_lineage(against.groupBy("u").agg(F.min("size").alias("shortest")))
    named = against.join(of_v, "v", "left").join(of_u, "u", "left").join(shortest, "u")
    # A similar text has no fewer runs than this share of the own ones.
    other = F.greatest("shortest", F.ceil(F.col("size") * F.lit(least) - F.lit(1e-9)))
    each = cut_lineage(
        named.select(
            F.col("u").alias("pivot"), "v", "size", F.size("own").alias("width"), label.alias("label"), (label != home).alias("stray"),
            (F.col("size") - _common(F.col("size"), other, least)).alias("most"), "own",
        )
    )

    def paired(rows: DataFrame, on: list[str], lacks: str) -> DataFrame:
        """Pairs of which neither lacks more runs of the other than it may."""
        one = rows.where("stray").select(*[F.col(c).alias(f"{c}_1") for c in rows.columns])
        two = rows.select(*[F.col(c).alias(f"{c}_2") for c in rows.columns])
        same = [F.col(f"{c}_1") == F.col(f"{c}_2") for c in on]
        common = _common(F.col("size_1"), F.col("size_2"), least)
        possible = [F.col(f"size_{i}") - F.col(f"{lacks}_{i}") >= common for i in (1, 2)]
        met = one.join(two, (F.col("label_1") != F.col("label_2")) & reduce(and_, same + possible))
        return met.select(F.least("v_1", "v_2").alias("u"), F.greatest("v_1", "v_2").alias("v"))

    few = each.where("width <= most").drop("own", "most")
    return cut_lineage(paired(_rarest_first(each), ["pivot", "run"], "at").union(paired(few, ["pivot"], "width")).distinct())


def links(measured: DataFrame, least: float = LEAST) -> DataFrame:
    """Components (``node``, ``least``) of the verified pairs of distinct texts; texts without a pair are left out."""
    texts = measured.where("node is not null").groupBy("node").agg(F.first("sketches").alias("sketches"))
    texts = cut_lineage(texts)
    keyed = texts.select("node", F.posexplode("sketches").alias("at", "key"))
    buckets = keyed.groupBy("key").agg(F.min("node").alias("leader"), F.max("node").alias("last")).where("leader <> last")
    shared = cut_lineage(buckets.select("key", "leader"))
    members = cut_lineage(keyed.join(shared, "key").select("key", "node", "leader"))
    stars = members.where("node <> leader").select(F.col("leader").alias("u"), F.col("node").alias("v")).distinct()
    stars = cut_lineage(stars)
    wanted = cut_lineage(stars.select(F.explode(F.array("u", "v")).alias("node")).distinct())
    # Names of nodes are 16 bytes: up to a checked number of them go to all tasks, so that the texts need not be dealt out.
    few = F.broadcast(wanted) if wanted.count() <= MAX_SENT else wanted
    held = measured.where("node is not null").join(few, "node", "left_semi")
    bodies = cut_lineage(held.groupBy("node").agg(F.min("body").alias("body")))
    found = verified(stars, bodies, least)
    groups = cut_lineage(components(found))
    open_ = _still_open(members, groups)
    large = cut_lineage(open_.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > MEET))
    apart = None
    if not large.isEmpty():
        against = compared(_pivots(open_, large), bodies, least)
        found = cut_lineage(found.union(against.where("alike").select("u", "v")))
        groups = cut_lineage(components(found))
        apart = _unlike_pivot(against, groups, least)
        open_ = _still_open(members, groups).join(large, "key", "left_anti")
    # In the other buckets each pair meets in the first bucket it shares.
    names = cut_lineage(open_.select("node").distinct())
    few = F.broadcast(names) if names.count() <= MAX_SENT else names
    counts = measured.where("node is not null").join(few, "node", "left_semi").groupBy("node").agg(F.min("counts").alias("counts"))
    own = cut_lineage(counts.join(texts, "node").select("node", "counts", F.col("sketches").alias("keys")))
    open_ = cut_lineage(open_.join(own, "node"))
    one = open_.select("key", F.col("node").alias("u"), F.col("keys").alias("ku"), F.col("label").alias("lu"), F.col("counts").alias("cu"))
    two = open_.select(
        F.col("key").alias("key2"), F.col("node").alias("v"), F.col("keys").alias("kv"), F.col("label").alias("lv"), F.col("counts").alias("cv")
    )
    first = F.array_min(F.array_intersect("ku", "kv")) == F.col("key")
    meet = one.join(two, (F.col("key") == F.col("key2")) & (F.col("u") < F.col("v")) & (F.col("lu") != F.col("lv")) & first)

    def possible(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            a, b = (np.frombuffer(b"".join(part[c]), dtype="<u4").reshape(-1, 1 << COUNT_BITS) for c in ("cu", "cv"))
            yield part.loc[may_match(a, b, least), ["u", "v"]]

    meet = cut_lineage(meet.select("u", "v", "cu", "cv").mapInPandas(possible, "u binary, v binary"))
    meet = meet if apart is None else meet.union(apart).distinct()
    fresh = cut_lineage(meet.select("u", "v").join(stars, ["u", "v"], "left_anti"))
    if fresh.isEmpty():
        return groups
    return components(found.union(verified(fresh, bodies, least)))


def classes(df: DataFrame, key: str = "doc_id", text: str = "text", least: float = LEAST) -> DataFrame:
    """``doc_id``, ``raw`` (digest of the text), ``class_id`` and ``class_size`` of every row."""
    measured = measure(df, key, text)
    groups = cut_lineage(links(measured, least))
    rows = measured.select("doc_id", "raw", "node")
    named = rows.join(groups, "node", "left").withColumn("group", F.coalesce("least", "node"))
    named = cut_lineage(named.select("doc_id", "raw", "group"))
    alone = named.where("group is null").select(
        "doc_id", "raw", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("class_size")
    )
    sizes = cut_lineage(
        named.where("group is not null").groupBy("group").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size"))
    )
    return named.join(sizes, "group").select("doc_id", "raw", "class_id", "class_size").unionByName(alone)


@shielded
def keep_one(df: DataFrame, key: str = "doc_id", text: str = "text", least: float = LEAST) -> DataFrame:
    """The rows of ``df``, one of each class: the smallest id, then the smallest digest of the text.

    Rows without words are in classes of their own and stay; of identical rows one stays.
    """
    measured = measure(df, key, text)
    groups = cut_lineage(links(measured, least))
    named = measured.select("doc_id", "raw", "node").join(groups, "node", "left")
    named = named.select("doc_id", "raw", F.coalesce("least", "node").alias("group"))
    rows = cut_lineage(named.groupBy("group", "doc_id", "raw").agg(F.count("*").alias("copies")))
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "raw", "copies")
    first = rows.where("group is not null").groupBy("group").agg(F.min(order).alias("first")).select("first.*")
    wordless = rows.where("group is null").select("doc_id", "raw", F.lit(1).cast("long").alias("copies"))
    stay = first.select("doc_id", "raw", "copies").unionByName(wordless)
    stay = cut_lineage(stay.select(F.col("doc_id").alias("_id"), F.col("raw").alias("_raw"), F.col("copies").alias("_copies")))
    same = F.col(key).cast("long").eqNullSafe(F.col("_id")) & (F.unhex(F.md5(text_of(text))) == F.col("_raw"))
    names = [f"`{c}`" for c in df.columns]
    single = df.join(stay.where("_copies = 1"), same, "left_semi").select(*names)
    several = stay.where("_copies > 1")
    if several.isEmpty():
        return single
    return single.union(df.join(several, same).dropDuplicates(["_id", "_raw"]).select(*names))
