"""Hard negatives by exact scores in a residue number system.

Vectors become integers (``floor(scale * x)``). A block of anchors meets a shard of all rows in one task. There the
two matrices are multiplied modulo several small primes, in float32: residues lie around zero and the columns are cut so
that no sum leaves the 24 bits in which float32 is exact. Chinese remaindering puts the signed scores together
again; as many primes are taken as the largest possible score of this block and shard asks for.

The work is done twice, because a negative is judged by the score of a positive: the first pass finds each anchor's best
rows of its own label, the second selects, for every anchor and positive, the first rows of other labels
in the window of scores that the positive opens. A shard gives at most as many rows as are wanted, and a window
function merges the shards. Nothing is collected or broadcast, and no pair of rows leaves a task but those.

Defined results: rows with a null label, a null vector, or a null or non-finite component take no part; components beyond a
shorter vector count as 0; components and scores beyond the range of a long saturate (scores after
exact summing); a row is never its own positive, but other rows with its id may be; equal scores rank by id, null ids last;
an anchor repeated as a row is answered for each row; an anchor without positives, and a positive without
negatives, give no rows; empty tables give no rows; other columns of the input, of whatever name, are not read.
"""

from __future__ import annotations

from math import prod

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tarmac.llm.common import worker_path
from tarmac.session import cut_lineage

SHARD_ROWS = 4096
ANCHOR_ROWS = 512
#: Whole numbers up to this one, and sums that stay below it, are exact in float32.
EXACT = 2**24
#: Residues are below this, so that some thousand products of two of them stay exact.
LARGEST_PRIME = 256
_LONG = 2**63 - 1
_PAIRS = "anchor long, anchor_id long, positive long, positive_id long, positive_score long, negative_id long, negative_score long"
_POSITIVES = "anchor long, positive long, positive_id long, positive_score long"


def primes(most: int = LARGEST_PRIME) -> list[int]:
    """The primes below ``most``, the largest first."""
    whole = range(2, most)
    return [n for n in reversed(whole) if all(n % d for d in range(2, int(n**0.5) + 1))]


def moduli(bound: int) -> list[int]:
    """As many primes as tell all whole numbers from ``-bound`` to ``bound`` apart."""
    chosen = []
    for p in primes():
        chosen.append(p)
        if prod(chosen) > 2 * bound:
            return chosen
    raise ValueError("scores are too large for the primes at hand")


def residues(matrix: np.ndarray, p: int) -> np.ndarray:
    """Residues around zero, in float32."""
    r = matrix % p
    return np.where(r > p // 2, r - p, r).astype(np.float32)


def product_modulo(a: np.ndarray, b: np.ndarray, p: int) -> np.ndarray:
    """``a @ b.T`` modulo ``p``, by float32 products of column blocks that stay exact."""
    columns = EXACT // (p // 2) ** 2
    total = np.zeros((len(a), len(b)), dtype=np.int64)
    for at in range(0, a.shape[1], columns):
        part = residues(a[:, at : at + columns], p) @ residues(b[:, at : at + columns], p).T
        total = (total + part.astype(np.int64)) % p
    return total


def remaindered(parts: list[np.ndarray], chosen: list[int]) -> np.ndarray:
    """The numbers around zero that have these residues, saturated to the range of a long.

    Digits of mixed radix are found with small numbers only; beyond 62 bits they are put together as Python integers.
    """
    digits: list[np.ndarray] = []
    for part, p in zip(parts, chosen, strict=True):
        known, weight = np.zeros_like(part), 1
        for digit, q in zip(digits, chosen):
            known, weight = (known + digit * weight) % p, weight * q % p
        digits.append((part - known) * pow(weight, -1, p) % p)
    whole = prod(chosen)
    large = whole >= 2**62
    value, weight = np.zeros(parts[0].shape, dtype=object if large else np.int64), 1
    for digit, p in zip(digits, chosen, strict=True):
        value = value + (digit.astype(object) if large else digit) * weight
        weight *= p
    value = np.where(value > whole // 2, value - whole, value)
    return np.clip(value, -_LONG - 1, _LONG).astype(np.int64) if large else value


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of two integer matrices."""
    largest = [max(-int(m.min(initial=0)), int(m.max(initial=0))) for m in (a, b)]
    chosen = moduli(largest[0] * largest[1] * max(1, a.shape[1]))
    return remaindered([product_modulo(a, b, p) for p in chosen], chosen)


def _matrix(parts: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(parts), width), dtype=np.int64)
    for i, p in enumerate(parts):
        out[i, : len(p)] = p
    return out


def _ranked(score: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Places by falling score; equal scores stay in the order given."""
    return at[np.argsort(~score[at], kind="stable")]


class _Meeting:
    """The scores of an anchor block against a shard whose rows stand by id, null ids last."""

    def __init__(self, anchors: pd.DataFrame, candidates: pd.DataFrame):
        candidates = candidates.sort_values(["id", "row"], na_position="last", kind="stable")
        width = max(map(len, [*anchors["parts"], *candidates["parts"]]))
        self.scores = scores(_matrix(anchors["parts"], width), _matrix(candidates["parts"], width))
        self.rows = candidates["row"].to_numpy()
        self.ids = [None if pd.isna(i) else int(i) for i in candidates["id"]]
        labels, _ = pd.factorize(pd.concat([anchors["label"], candidates["label"]]))
        self.anchor_labels, self.labels = labels[: len(anchors)], labels[len(anchors) :]

    def alike(self, i: int, row: int, most: int) -> list[tuple]:
        """The best rows of the label of anchor ``i``."""
        score = self.scores[i]
        at = _ranked(score, np.flatnonzero((self.labels == self.anchor_labels[i]) & (self.rows != row)))[:most]
        return [(row, int(self.rows[c]), self.ids[c], int(score[c])) for c in at]

    def others(self, i: int, windows: list[tuple[int, int]], most: int) -> list[list[tuple]]:
        """For each window of scores the first rows of other labels in it."""
        score = self.scores[i]
        low, high = min(w[0] for w in windows), max(w[1] for w in windows)
        at = np.flatnonzero((self.labels != self.anchor_labels[i]) & (score >= low) & (score <= high))
        at = _ranked(score, at)
        falling = ~score[at]
        found = []
        for least, largest in windows:
            first = int(np.searchsorted(falling, ~np.int64(largest), "left"))
            found.append([(self.ids[c], int(score[c])) for c in at[first : first + most] if score[c] >= least])
        return found


def _frame(found: list[tuple], schema: str) -> pd.DataFrame:
    names = [c.split()[0] for c in schema.split(", ")]
    out = pd.DataFrame(found, columns=names, dtype=object)
    return out.astype({n: "Int64" for n in names})


def window_of(score: int, low: tuple[int, int], high: tuple[int, int]) -> tuple[int, int]:
    """Scores s with ``low * score <= s <= high * score``, fractions given as (numerator, denominator)."""
    least, largest = -(-low[0] * score // low[1]), high[0] * score // high[1]
    return tuple(max(-_LONG - 1, min(_LONG, bound)) for bound in (least, largest))


def participants(df: DataFrame, key: str, vector: str, label: str, scale: int) -> DataFrame:
    """``row``, ``id``, ``label`` and ``parts`` (integers) of the rows that take part, stored."""
    x = F.col(vector)
    finite = F.forall(x, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))), F.lit(False)))
    parts = F.transform(x, lambda v: F.floor(v.cast("double") * scale).cast("long"))
    whole = df.where(x.isNotNull() & finite & F.col(label).isNotNull())
    rows = whole.select(F.col(key).cast("long").alias("id"), F.col(label).alias("label"), parts.alias("parts"))
    return cut_lineage(rows.withColumn("row", F.monotonically_increasing_id()))


def mine(
    df: DataFrame, anchors: Column, key: str = "vec_id", vector: str = "embedding", label: str = "label", scale: int = 256,
    positives: int = 5, negatives: int = 10, low: tuple[int, int] = (30, 100), high: tuple[int, int] = (90, 100),
    shard_rows: int = SHARD_ROWS, anchor_rows: int = ANCHOR_ROWS,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score`` and ``negative_score``.

    ``anchors`` is a condition on ``id``. The two counts that size the blocks read file footers and one column.
    """
    worker_path(df.sparkSession)
    rows = participants(df, key, vector, label, scale)
    asked = rows.where(anchors)
    shards = max(1, -(-rows.count() // shard_rows))
    blocks = max(1, -(-asked.count() // anchor_rows))
    shard = F.pmod(F.xxhash64("row"), F.lit(shards))
    block = F.pmod(F.xxhash64("row"), F.lit(blocks))
    every = [F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))) for n in (shards, blocks)]
    held = rows.select("*", shard.alias("shard"), every[1].alias("block")).repartition(shards * blocks, "block", "shard")

    def meet(posed: DataFrame, one, schema: str) -> DataFrame:
        def task(candidates: pd.DataFrame, questions: pd.DataFrame) -> pd.DataFrame:
            found = []
            if len(candidates) and len(questions):
                met = _Meeting(questions, candidates)
                for i, question in enumerate(questions.itertuples()):
                    found += one(met, i, question)
            return _frame(found, schema)

        dealt = posed.select("*", block.alias("block"), every[0].alias("shard")).repartition(shards * blocks, "block", "shard")
        return held.groupBy("block", "shard").cogroup(dealt.groupBy("block", "shard")).applyInPandas(task, schema)

    def first(found: DataFrame, keys: list[str], score: str, named: str, more: list[str], most: int) -> DataFrame:
        order = W.partitionBy(*keys).orderBy(F.desc(score), F.asc_nulls_last(named), *more)
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)

    alike = meet(asked, lambda met, i, q: met.alike(i, q.row, positives), _POSITIVES)
    best = cut_lineage(first(alike, ["anchor"], "positive_score", "positive_id", ["positive"], positives))
    chosen = best.groupBy(F.col("anchor").alias("row")).agg(
        F.collect_list(F.struct("positive", "positive_id", "positive_score")).alias("chosen")
    )

    def select(met: _Meeting, i: int, q) -> list[tuple]:
        windows = [window_of(int(c["positive_score"]), low, high) for c in q.chosen]
        return [
            (q.row, q.id, c["positive"], c["positive_id"], c["positive_score"], *negative)
            for c, found in zip(q.chosen, met.others(i, windows, negatives), strict=True)
            for negative in found
        ]

    found = meet(cut_lineage(asked.join(chosen, "row")), select, _PAIRS)
    ranked = first(found, ["anchor", "positive"], "negative_score", "negative_id", [], negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
