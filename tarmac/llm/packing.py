"""Packing token ids into rows of one length, written as binary matrices.

Documents longer than a row are split losslessly into whole rows and a rest. Rests are packed best fit, longest first:
each goes to the fullest row that still takes it, found in a segment tree over the free places. A task
packs its documents in batches of a bounded number of tokens as they come, so there is no shuffle, no
task holds more than one batch, and the lost places per batch are those of its last few rows.

Each batch is a set of files below a shared folder, in NumPy's format: ``ids`` (rows x length, the last places padded),
``positions`` (same shape, counting from 0 in every segment), ``cumulative`` (ends of the segments of all rows, each row
beginning with 0) and ``begins`` (where a row begins in ``cumulative``). Spark stores an index row per packed row, with the documents and
the part of each. Files of a failed attempt are in no index.

Defined results: null or empty ids become a document of no tokens, which is only in the index if an end mark is
added; repeated rows are packed each by itself; with no documents nothing is written. Ids that do not fit the
matrix's type are an error.
"""

from __future__ import annotations

import io
import sys
import uuid
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tarmac.llm.common import worker_path
from tarmac.llm.warc import storage
from tarmac.session import cut_lineage, scratch_path

ROW_TOKENS = 2048
BATCH_TOKENS = 4 << 20
#: Rows of a batch hold, for each segment, the document, the first of its tokens and how many.
INDEX = "file string, row int, n_tokens int, cumulative array<int>, segments array<struct<doc_id:long,first:long,n:int>>"


class FreePlaces:
    """Segment tree over 0..most free places: how many rows have so many; finds the least that suffices."""

    def __init__(self, most: int):
        self.leaves = 1 << most.bit_length()
        self.counts = [0] * (2 * self.leaves)
        self.rows: dict[int, list[int]] = {}

    def add(self, free: int, row: int) -> None:
        self.rows.setdefault(free, []).append(row)
        self._change(free, 1)

    def _change(self, free: int, by: int) -> None:
        at = self.leaves + free
        while at:
            self.counts[at] += by
            at >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """Remove a row with the fewest free places of at least ``need``: (free, row)."""
        at = self.leaves + need
        if not self.counts[at]:
            # Up to the first right neighbour with rows, then down to its leftmost leaf.
            while at > 1 and not (at % 2 == 0 and self.counts[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.leaves:
                at = 2 * at if self.counts[2 * at] else 2 * at + 1
        free = at - self.leaves
        self._change(free, -1)
        return free, self.rows[free].pop()


def pack(lengths: list[int], capacity: int) -> list[list[int]]:
    """Rows of item numbers, best fit, longest first; no length is above the capacity."""
    places, rows = FreePlaces(capacity), []
    for item in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        found = places.take(lengths[item])
        if found is None:
            found = (capacity, len(rows))
            rows.append([])
        free, row = found
        rows[row].append(item)
        if free > lengths[item]:
            places.add(free - lengths[item], row)
    return rows


def split(n: int, capacity: int) -> list[tuple[int, int]]:
    """(first, number) of the parts of a document of n tokens: whole rows, then the rest."""
    return [(at, min(capacity, n - at)) for at in range(0, n, capacity)]


class Batch:
    """Documents of one batch."""

    def __init__(self, capacity: int, dtype: type, pad: int):
        self.capacity, self.dtype, self.pad = capacity, dtype, pad
        self.parts: list[tuple[int | None, int, np.ndarray]] = []
        self.tokens = 0

    def add(self, doc_id: int | None, first: int, ids: np.ndarray) -> None:
        self.parts.append((doc_id, first, ids))
        self.tokens += len(ids)

    def write(self, folder: str) -> list[tuple]:
        """Write the matrices and return the index rows."""
        rows = pack([len(p[2]) for p in self.parts], self.capacity)
        ids = np.full((len(rows), self.capacity), self.pad, dtype=self.dtype)
        positions = np.zeros((len(rows), self.capacity), dtype=np.uint16 if self.capacity <= 1 << 16 else np.uint32)
        file, index, ends, begins = f"{folder}/batch-{uuid.uuid4().hex}", [], [], []
        for r, items in enumerate(rows):
            at, cumulative, segments = 0, [0], []
            for item in items:
                doc_id, first, part = self.parts[item]
                ids[r, at : at + len(part)] = part
                positions[r, at : at + len(part)] = np.arange(len(part))
                at += len(part)
                cumulative.append(at)
                segments.append({"doc_id": doc_id, "first": first, "n": len(part)})
            begins.append(len(ends))
            ends += cumulative
            index.append((file, r, at, cumulative, segments))
        for name, matrix in (
            ("ids", ids), ("positions", positions), ("cumulative", np.array(ends, dtype=np.int32)),
            ("begins", np.array(begins, dtype=np.int64)),
        ):
            save(f"{file}.{name}.npy", matrix)
        return index


def save(path: str, matrix: np.ndarray) -> None:
    system, place = storage(path)
    system.create_dir(place.rpartition("/")[0], recursive=True)
    head = io.BytesIO()
    np.lib.format.write_array_header_1_0(head, np.lib.format.header_data_from_array_1_0(matrix))
    with system.open_output_stream(place, compression=None) as stream:
        stream.write(head.getvalue())
        stream.write(np.ascontiguousarray(matrix).data.cast("B") if matrix.size else b"")


def load(path: str) -> np.ndarray:
    system, place = storage(path)
    with system.open_input_stream(place) as stream:
        return np.load(io.BytesIO(stream.read()))


def write(
    df: DataFrame, folder: str | None = None, key: str = "doc_id", ids: str = "ids", capacity: int = ROW_TOKENS,
    end: int | None = None, pad: int = 0, batch_tokens: int = BATCH_TOKENS, wide: bool = False,
) -> DataFrame:
    """Pack packed ids (little-endian unsigned 32-bit) and return the stored index.

    ``end`` is appended to every document; ``wide`` writes 32-bit ids instead of 16-bit ones.
    """
    spark = df.sparkSession
    worker_path(spark)
    folder = folder or scratch_path(spark, "packed")
    dtype = np.uint32 if wide else np.uint16
    names = ["file", "row", "n_tokens", "cumulative", "segments"]

    def packed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        batch = Batch(capacity, dtype, pad)
        for frame in frames:
            for doc_id, no_id, raw in zip(frame["doc_id"], frame["no_id"], frame["ids"], strict=True):
                own = np.frombuffer(raw or b"", dtype="<u4")
                if end is not None:
                    own = np.append(own, np.uint32(end))
                if len(own) and own.max() > np.iinfo(dtype).max:
                    raise ValueError(f"document {doc_id} has ids above {np.iinfo(dtype).max}; write it wide")
                for first, n in split(len(own), capacity):
                    batch.add(None if no_id else int(doc_id), first, own[first : first + n].astype(dtype))
                    if batch.tokens >= batch_tokens:
                        yield pd.DataFrame(batch.write(folder), columns=names)
                        batch = Batch(capacity, dtype, pad)
        if batch.parts:
            yield pd.DataFrame(batch.write(folder), columns=names)

    # A null among the ids would make pandas read them all as floats.
    doc_id = F.col(key).cast("long")
    rows = df.select(F.coalesce(doc_id, F.lit(0)).alias("doc_id"), doc_id.isNull().alias("no_id"), F.col(ids).alias("ids"))
    return cut_lineage(rows.mapInPandas(packed, INDEX), "packed-index")


def read(index: DataFrame) -> DataFrame:
    """The segments of packed rows read back: ``doc_id``, ``first`` and ``ids`` (as they were given)."""
    worker_path(index.sparkSession)

    def segments(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        file, matrix = None, None
        for frame in frames:
            out = []
            for r in frame.itertuples(index=False):
                if r.file != file:
                    file, matrix = r.file, load(f"{r.file}.ids.npy")
                for at, s in zip(r.cumulative, r.segments, strict=False):
                    part = array("I", matrix[r.row, at : at + s["n"]].tolist())
                    if sys.byteorder == "big":
                        part.byteswap()
                    out.append((s["doc_id"], s["first"], part.tobytes()))
            told = pd.DataFrame(out, columns=["doc_id", "first", "ids"])
            told["doc_id"] = told["doc_id"].astype("Int64")
            yield told

    return index.select("file", "row", "cumulative", "segments").mapInPandas(segments, "doc_id long, first long, ids binary")
