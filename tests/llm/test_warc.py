"""Archives written, indexed and read back; records of the standard's form."""

import gzip
import hashlib
import os

import pytest
from pyspark.sql import functions as F

from tarmac.llm import warc

FIELDS = "page_id long, url string, html string, digest string"


def pages():
    long = "<p>é</p>" * 200
    return [
        (1, "http://a/1", long, "x"), (2, "http://a/2", long, "x"), (7, "http://a/7", long, "x"), (None, "http://a/n", long, "x"),
        (3, "http://b\r\nX: y", "short", None), (4, None, "short", None), (5, "http://c", None, None), (6, "http://d", "", None),
        (8, "http://e", "z" * 3_000_000, None), (9, "http://f", "\r\n\r\nWARC/1.1\r\n" * 200, None),
    ]


@pytest.fixture(scope="module")
def index(spark):
    return warc.write(spark.createDataFrame(pages(), FIELDS))


def test_round_trip(spark, index):
    got = {r.key: r for r in warc.read(index).collect()}
    assert len(got) == len(pages())
    for page_id, url, html, _ in pages():
        r, payload = got[None if page_id is None else str(page_id)], (html or "").encode()
        assert r.payload_bytes == len(payload) and r.payload_digest == hashlib.sha1(payload).hexdigest()
        revisit = page_id in (1, 2, None)
        assert (r.record_type, r.refers_to) == (("revisit", "7") if revisit else ("response", None))
        assert r.payload == (None if revisit else bytearray(payload))
    assert got["3"].url == "http://b%0D%0AX:%20y" and got["4"].url == "about:blank"


def test_selected_records_only(spark, index):
    some = index.where(F.col("key").isin("3", "8"))
    assert sorted(r.key for r in warc.read(some).collect()) == ["3", "8"]
    assert warc.read(index.limit(0)).collect() == []


def test_every_record_is_a_gzip_member(index):
    for r in index.collect():
        file = r.file.removeprefix("file://")
        with open(file, "rb") as f:
            f.seek(r.offset)
            raw = gzip.decompress(f.read(r.length))
        assert raw.startswith(b"WARC/1.1\r\n") and raw.endswith(b"\r\n\r\n")
        assert os.path.getsize(file) >= r.offset + r.length


def test_repeated_rows_and_no_rows(spark):
    df = spark.createDataFrame([(1, "u", "q" * 2000, "x")] * 2 + [(0, "u", "q" * 2000, "x")], FIELDS)
    got = sorted((r.key, r.record_type, r.refers_to) for r in warc.read(warc.write(df)).collect())
    # Rows that share the largest key and the payload have one place each.
    assert got == [("0", "revisit", "1"), ("1", "response", None), ("1", "response", None)]
    assert warc.read(warc.write(df.limit(0))).collect() == []


def test_a_changed_payload_is_an_error():
    raw = warc.record("1", "u", b"payload", hashlib.sha1(b"other").hexdigest(), "response", None)
    with pytest.raises(ValueError, match="digest"):
        warc.parse(raw)


def test_neighbours_share_a_request():
    places = [(0, 10), (10, 5), (200, 10), (215, 10)]
    assert [(a, b) for a, b, _ in warc.ranges(places, gap=20)] == [(0, 15), (200, 225)]
