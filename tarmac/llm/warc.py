"""WARC archives with an index: written and indexed in one pass, read back by byte ranges.

Writing: each task writes archives of its own below a shared folder, one gzip member per record, and returns an index
row per record: file, offset, length, URL and payload digest, besides key and type. The index is
stored by Spark; archives of a task attempt that failed are in no index, so a repeated task does no harm.
Of equal payloads of at least ``least`` bytes the one with the largest key is a ``response``; the others are ``revisit``
records that hold the headers and refer to it.

Reading: index rows, all or some, are gathered by file and block of the file, sorted by offset, and
neighbours are read with one request. Every payload is checked against its digest.

Defined results: a null payload is empty; a null URL is written as ``about:blank``; spaces and control characters in
URLs are percent-encoded; rows with a null key are responses unless an equal payload has a key;
rows that share both the largest key and the payload are all responses; an empty table gives an empty index. Other input columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, functions as F

from tarmac.llm.common import text_of, worker_path
from tarmac.session import cut_lineage, scratch_path

LEAST_REVISITED = 1000
ARCHIVE_BYTES = 1 << 30
#: Index rows are gathered by so many bytes of an archive; requests less than the gap apart become one.
BLOCK_BYTES = 4 << 20
GAP_BYTES = 64 << 10
TASK_BYTES = 128 << 20
INDEX = "file string, offset long, length long, url string, digest string, key string, record_type string, refers_to string"
RECORD = (
    "key string, url string, record_type string, refers_to string, payload_bytes long, payload_digest string, payload binary"
)
#: Fixed by the format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
_ID = "<urn:key:{}>"


def storage(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))


def record(key: str | None, url: str | None, payload: bytes, digest: str, record_type: str, refers_to: str | None) -> bytes:
    """One uncompressed record."""
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", url) if url else "about:blank"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = http if record_type == "revisit" else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {record_type}",
        f"WARC-Record-ID: {_ID.format('' if key is None else key)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
    ]
    if record_type == "revisit":
        head += [f"WARC-Refers-To: {_ID.format(refers_to)}", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(raw: bytes) -> tuple:
    """Fields of RECORD of one uncompressed record; a payload that is not what its digest says is an error."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    named = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    body = rest[: int(named["Content-Length"])]
    if len(body) < int(named["Content-Length"]):
        raise ValueError(f"record {named['WARC-Record-ID']} is cut off")
    http, _, payload = body.partition(b"\r\n\r\n")
    size = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    digest = base64.b32decode(named["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    key = named["WARC-Record-ID"].removeprefix("<urn:key:").removesuffix(">") or None
    revisit = named["WARC-Type"] == "revisit"
    if not revisit and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"record {named['WARC-Record-ID']} does not hold the payload of its digest")
    refers_to = named["WARC-Refers-To"].removeprefix("<urn:key:").removesuffix(">") if revisit else None
    return key, named["WARC-Target-URI"], named["WARC-Type"], refers_to, size, digest, None if revisit else payload


class Archive:
    """Gzip members appended to files of one task."""

    def __init__(self, folder: str):
        self.folder, self.stream = folder, None

    def add(self, raw: bytes) -> tuple[str, int, int]:
        if self.stream is None or self.offset >= ARCHIVE_BYTES:
            self.close()
            self.name, self.offset = f"{self.folder}/part-{uuid.uuid4().hex}.warc.gz", 0
            system, path = storage(self.name)
            system.create_dir(path.rpartition("/")[0], recursive=True)
            self.stream = system.open_output_stream(path, compression=None)
        packer = zlib.compressobj(6, zlib.DEFLATED, 31)
        member = packer.compress(raw) + packer.flush()
        self.stream.write(member)
        at, self.offset = self.offset, self.offset + len(member)
        return self.name, at, len(member)

    def close(self) -> None:
        if self.stream is not None:
            self.stream.close()
            self.stream = None


def deduplicated(df: DataFrame, key: str, url: str, html: str, least: int = LEAST_REVISITED) -> DataFrame:
    """``key`` (as text), ``url``, ``payload``, ``digest``, ``record_type`` and ``refers_to`` of every row."""
    payload = text_of(html).cast("binary")
    rows = df.select(F.col(key).alias("_key"), F.col(url).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    large = rows.where(F.octet_length("payload") >= least)
    groups = large.groupBy(F.col("digest").alias("_digest")).agg(F.max("_key").alias("_largest"), F.count("*").alias("_rows"))
    # One row per payload that is there more than once, stored: Spark sees its size and sends it to all only if small.
    shared = cut_lineage(groups.where("_rows > 1").select("_digest", "_largest"))
    revisits = F.col("_largest").isNotNull() & ~F.col("_largest").eqNullSafe(F.col("_key"))
    return rows.join(shared, F.col("digest") == F.col("_digest"), "left").select(
        F.col("_key").cast("string").alias("key"), "url", "payload", "digest",
        F.when(revisits, "revisit").otherwise("response").alias("record_type"),
        F.when(revisits, F.col("_largest").cast("string")).alias("refers_to"),
    )


def write(
    df: DataFrame, folder: str | None = None, key: str = "page_id", url: str = "url", html: str = "html",
    least: int = LEAST_REVISITED,
) -> DataFrame:
    """Write archives of all rows below ``folder`` (by default a new one in the shared folder) and return the stored index."""
    spark = df.sparkSession
    worker_path(spark)
    folder = folder or scratch_path(spark, "warc")

    def archive(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = Archive(folder)
        try:
            for part in parts:
                rows = []
                for r in part.astype(object).where(part.notna(), None).itertuples(index=False):
                    file, offset, length = out.add(record(r.key, r.url, r.payload, r.digest, r.record_type, r.refers_to))
                    rows.append((file, offset, length, r.url, r.digest, r.key, r.record_type, r.refers_to))
                yield pd.DataFrame(rows, columns=[c.split()[0] for c in INDEX.split(", ")])
        finally:
            out.close()

    return cut_lineage(deduplicated(df, key, url, html, least).mapInPandas(archive, INDEX), "warc-index")


def ranges(places: list[tuple[int, int]], gap: int = GAP_BYTES) -> Iterator[tuple[int, int, list[tuple[int, int]]]]:
    """Requests (start, end, places) for sorted places (offset, length); near neighbours share one."""
    run: list[tuple[int, int]] = []
    for offset, length in places:
        if run and offset - (run[-1][0] + run[-1][1]) > gap:
            yield run[0][0], run[-1][0] + run[-1][1], run
            run = []
        run.append((offset, length))
    if run:
        yield run[0][0], run[-1][0] + run[-1][1], run


def read(index: DataFrame, payload: bool = True) -> DataFrame:
    """The records that index rows point to, each once: RECORD, with ``payload`` null unless asked for."""
    worker_path(index.sparkSession)
    block = F.floor(F.col("offset") / BLOCK_BYTES)
    places = F.sort_array(F.collect_set(F.struct("offset", "length"))).alias("places")
    # Index rows are tiny next to what they point to, so tasks are counted by the bytes to be read.
    total = index.agg(F.sum("length")).first()[0] or 0
    tasks = max(index.sparkSession.sparkContext.defaultParallelism, -(-total // TASK_BYTES))
    dealt = index.select("file", block.alias("block"), "offset", "length").repartition(tasks, "file", "block")
    blocks = dealt.groupBy("file", "block").agg(places).select("file", "places")
    names = [c.split()[0] for c in RECORD.split(", ")]

    def fetch(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for file, places in zip(part["file"], part["places"], strict=True):
                system, path = storage(file)
                with system.open_input_file(path) as source:
                    for start, end, run in ranges([(p["offset"], p["length"]) for p in places]):
                        source.seek(start)
                        held = source.read(end - start)
                        rows = [parse(zlib.decompress(held[at - start : at - start + n], 31)) for at, n in run]
                        told = pd.DataFrame(rows, columns=names)
                        if not payload:
                            told["payload"] = None
                        yield told

    return blocks.mapInPandas(fetch, RECORD)
