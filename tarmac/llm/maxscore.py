"""Exact top-k inner products with MaxScore over shards.

Vectors become integers (``floor(scale * x)``). Every dimension has two posting lists per shard, of the vectors
positive and negative there. A query's terms are its dimensions with the sign that adds to the score, bounded
by what the list's largest entry can add. Terms whose bounds together cannot lift a vector over the k-th best score are
not essential: only the postings of the essential ones are traversed, and the vectors still competitive
are probed term by term, dropping those that cannot reach the threshold any more, before the rest of their score is taken.

Queries and candidates are cut into blocks of bounded size that meet in every combination, each in a
task of its own; per query the shards' best are merged. Nothing is collected or broadcast.

Defined results: vectors that are null, or hold a null or a non-finite component, take no part; an empty
vector scores 0; components beyond a shorter vector count as 0; components and scores beyond the range of
a long saturate; a row never matches itself, but other rows with its id do; equal scores rank by id, null
ids last; a query repeated as a row is answered for each row; empty tables give no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tarmac.llm.common import worker_path
from tarmac.session import cut_lineage

SHARD_ROWS = 4096
QUERY_ROWS = 4096
MOST_TASKS = 20_000
_FOUND = "query long, query_id long, vec_id long, score long"
_LONG = 2**63 - 1


def integers(df: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """``row``, ``id`` and ``parts`` (integers) of the rows that take part, stored."""
    x = F.col(vector)
    finite = F.forall(x, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))), F.lit(False)))
    parts = F.transform(x, lambda v: F.floor(v.cast("double") * scale).cast("long"))
    rows = df.where(x.isNotNull() & finite).select(F.col(key).cast("long").alias("id"), parts.alias("parts"))
    return cut_lineage(rows.withColumn("row", F.monotonically_increasing_id()))


def _matrix(parts: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(parts), width), dtype=np.int64)
    for i, p in enumerate(parts):
        out[i, : len(p)] = p
    return out


class Shard:
    """Posting lists of a block of vectors."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, null_ids: np.ndarray, vectors: np.ndarray):
        self.rows, self.ids, self.null_ids, self.vectors = rows, ids, null_ids, vectors
        self.lists = []
        for column in vectors.T:
            signed = (np.flatnonzero(column < 0), np.flatnonzero(column > 0))
            self.lists.append(tuple((at, column[at], int(np.abs(column[at]).max(initial=0))) for at in signed))

    def best(self, row: int, query: np.ndarray, k: int) -> list[tuple[int, int]]:
        """Places and scores of the k best, by score, then id."""
        if max(int(np.abs(query).max(initial=0)), 1) * max(int(np.abs(self.vectors).max(initial=0)), 1) * (len(query) + 1) >= _LONG:
            exact = self.vectors.astype(object) @ query.astype(object)
            scores = np.array([max(-_LONG - 1, min(_LONG, int(s))) for s in exact], dtype=np.int64)
            return self._top(np.flatnonzero(self.rows != row), scores, k)
        # (bound, dimension), the largest first; a list's entries times the query's part are all positive.
        terms = sorted(
            ((abs(int(q)) * self.lists[d][int(q > 0)][2], d) for d, q in enumerate(query) if q), reverse=True
        )
        terms = [t for t in terms if t[0]]
        threshold = self._seed(row, query, k, terms)
        scores = np.zeros(len(self.rows), dtype=np.int64)
        if threshold is None:
            return self._top(np.flatnonzero(self.rows != row), self.vectors @ query, k)
        rest, essential = sum(bound for bound, _ in terms), 0
        # A vector in none of the essential lists gets at most the rest; equal scores may still rank by id.
        while essential < len(terms) and rest >= threshold:
            bound, d = terms[essential]
            at, entries, _ = self.lists[d][int(query[d] > 0)]
            scores[at] += entries * query[d]
            rest -= bound
            essential += 1
        competitive = np.flatnonzero((scores + rest >= threshold) & (self.rows != row))
        for bound, d in terms[essential:]:
            if len(competitive) <= 2 * k:
                break
            scores[competitive] += np.maximum(self.vectors[competitive, d] * query[d], 0)
            rest -= bound
            competitive = competitive[scores[competitive] + rest >= threshold]
        full = np.zeros(len(self.rows), dtype=np.int64)
        full[competitive] = self.vectors[competitive] @ query
        return self._top(competitive[full[competitive] >= threshold], full, k)

    def _seed(self, row: int, query: np.ndarray, k: int, terms: list[tuple[int, int]]) -> int | None:
        """The k-th best score among the vectors that are strongest in the first terms; None if there are too few."""
        tried = [np.arange(min(len(self.rows), k + 1))]
        for _, d in terms[:4]:
            at, entries, _ = self.lists[d][int(query[d] > 0)]
            few = min(len(at), 4 * k)
            tried.append(at[np.argpartition(-np.abs(entries), few - 1)[:few]] if few else at)
        at = np.unique(np.concatenate(tried))
        at = at[self.rows[at] != row]
        if len(at) < k:
            return None
        return int(np.partition(self.vectors[at] @ query, len(at) - k)[len(at) - k])

    def _top(self, at: np.ndarray, scores: np.ndarray, k: int) -> list[tuple[int, int]]:
        # ~score falls as the score rises, without the overflow of a negation.
        order = np.lexsort((self.ids[at], self.null_ids[at], ~scores[at]))[:k]
        return [(int(i), int(scores[i])) for i in at[order]]


def search(
    df: DataFrame, queries: Column, k: int, key: str = "vec_id", vector: str = "embedding", scale: int = 256,
    shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` of the k best other rows for each row where ``queries`` holds.

    ``queries`` is a condition on ``id``. The two counts that size the blocks read only file footers and one column.
    """
    worker_path(df.sparkSession)
    rows = integers(df, key, vector, scale)
    asked = rows.where(queries)
    shards = max(1, -(-rows.count() // shard_rows))
    blocks = max(1, -(-asked.count() // query_rows))
    shard = F.pmod(F.xxhash64("row"), F.lit(shards))
    block = F.pmod(F.xxhash64("row"), F.lit(blocks))
    every = [F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))) for n in (shards, blocks)]
    held = rows.select("*", shard.alias("shard"), every[1].alias("block"))
    posed = asked.select("*", block.alias("block"), every[0].alias("shard"))

    def probe(candidates: pd.DataFrame, questions: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(candidates) and len(questions):
            width = max(map(len, [*candidates["parts"], *questions["parts"]]))
            no_id = candidates["id"].isna().to_numpy()
            ids = candidates["id"].fillna(0).to_numpy(dtype=np.int64)
            own = Shard(candidates["row"].to_numpy(), ids, no_id, _matrix(candidates["parts"], width))
            for row, query_id, query in zip(questions["row"], questions["id"], _matrix(questions["parts"], width), strict=True):
                for at, score in own.best(row, query, k):
                    found.append((row, query_id, None if no_id[at] else int(ids[at]), score))
        out = pd.DataFrame(found, columns=["query", "query_id", "vec_id", "score"], dtype=object)
        return out.astype({"query": "int64", "query_id": "Int64", "vec_id": "Int64", "score": "int64"})

    # Rows say little about the work of a pair of blocks, so Spark is told the number of tasks instead of merging small ones.
    tasks = min(shards * blocks, MOST_TASKS)
    held, posed = (side.repartition(tasks, "block", "shard") for side in (held, posed))
    best = held.groupBy("block", "shard").cogroup(posed.groupBy("block", "shard")).applyInPandas(probe, _FOUND)
    order = W.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
