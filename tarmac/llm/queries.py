"""The queries of this folder over the given tables, with their SQL checks where SQL can tell the result."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tarmac.llm import (
    bpe, hard_negatives, license_scan, line_quality, maxscore, mixing, order_minhash, packing, paragraphs, pii, prefix_trie, sharding, warc,
)
from tarmac.llm.common import WORD
from tarmac.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def _table(spark: SparkSession, sf: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet").select(*columns)


@query(r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')), 1, 15))::BIGINT AS h
  FROM documents),
s AS (
  SELECT source, sum(size)::HUGEINT AS source_size,
    [3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::HUGEINT AS w FROM d GROUP BY source),
o AS (
  SELECT *, sum(source_size) OVER () AS total,
    coalesce(sum(2 * source_size) OVER (ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped,
    sum(w) OVER (ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w_open,
    row_number() OVER (ORDER BY source_size / w, source NULLS LAST) AS k FROM s),
-- the first source, by size over weight, that the level does not stop fixes the level
f AS (SELECT k, 3 * total - 2 * capped AS units, 2 * w_open AS parts FROM o
      WHERE (3 * total - 2 * capped) * w <= 2 * source_size * 2 * w_open ORDER BY k LIMIT 1),
t AS (SELECT o.source, o.source_size,
        CASE WHEN f.k IS NULL OR o.k < f.k THEN (2 * o.source_size)::DOUBLE ELSE (o.w * f.units)::DOUBLE / f.parts::DOUBLE END AS target
      FROM o LEFT JOIN f ON true),
r AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size::DOUBLE) ELSE 0 END AS rounds FROM t),
c AS (
  SELECT d.doc_id, d.size, r.source_size, r.target, r.rounds, r.target - r.rounds * r.source_size::DOUBLE AS budget,
    sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h RANGE UNBOUNDED PRECEDING) AS upto,
    sum(d.size) OVER (PARTITION BY d.source, d.h) AS tied
  FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source)
SELECT doc_id, size, source_size::BIGINT AS source_size, target,
  (size * (rounds + CASE WHEN upto <= budget OR (upto - tied <= budget AND 2 * (budget - (upto - tied)) >= tied AND budget > 0)
   THEN 1 ELSE 0 END))::BIGINT AS taken
FROM c""")
def op1_source_mix(spark, sf):
    """Mix all documents: every source near its share, no document more than twice."""
    measured = mixing.measure(_table(spark, sf, "documents", "doc_id", "text", "source"))
    mixed = mixing.assign(measured, mixing.plan(measured))
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return mixed.select("doc_id", "size", "source_size", "target", taken)


@query()
def op2_byte_bpe(spark, sf):
    """Encode every text, decode the ids, and tell digests of both."""
    vocabulary = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    encoded = bpe.encode(_table(spark, sf, "documents", "doc_id", "text"), *vocabulary).select("doc_id", "ids")
    decoded = bpe.decode(encoded, *vocabulary)
    return decoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query(rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '{WORD}') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS lines
  FROM documents),
p AS (SELECT r, unnest(words) AS w, unnest(range(len(words))) AS i FROM d),
g AS (SELECT r, i, w AS a, lead(w) OVER s AS b, lead(w, 2) OVER s AS c FROM p WINDOW s AS (PARTITION BY r ORDER BY i)),
n AS (SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS times FROM g WHERE c IS NOT NULL),
x AS (SELECT r, count(DISTINCT i + k) AS covered FROM n, unnest([0, 1, 2]) AS u(k) WHERE times > 1 GROUP BY r),
l AS (SELECT r, unnest(lines) AS line FROM d),
f AS (SELECT r, sum(length(line)) AS lost FROM l
  WHERE NOT regexp_matches(line, '{line_quality.SENTENCE_END.replace("'", "''")}')
    OR len(regexp_extract_all(line, '[{line_quality.SEPARATORS}]')) >= 3
    OR regexp_matches(line, '{line_quality.NAVIGATION}') OR regexp_matches(line, '{line_quality.BOILERPLATE}')
    OR len(regexp_extract_all(line, '[{line_quality.SYMBOLS}]')) * 3 > len(regexp_extract_all(line, '{WORD}'))
    OR len(regexp_extract_all(line, '!')) * 3 > len(regexp_extract_all(line, '{WORD}'))
  GROUP BY r),
q AS (
  SELECT doc_id, len(words)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
    len(regexp_extract_all(text, '[{line_quality.SYMBOLS}]'))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(covered, 0)::BIGINT AS n_repeat_words,
    coalesce(lost, 0) AS lost, coalesce(list_sum(list_transform(lines, lambda y: length(y))), 0) AS total
  FROM d LEFT JOIN x USING (r) LEFT JOIN f USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND lost * 100 <= total * 30 AS kept
FROM q""".replace("\\\\x", "\\x"))
def op4_line_quality(spark, sf):
    """Line rules and base counts of every document."""
    judged = line_quality.judge(_table(spark, sf, "documents", "doc_id", "text"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query()
def op3_paragraphs(spark, sf):
    """Passages of all documents that repeat across documents."""
    return paragraphs.repeated(_table(spark, sf, "documents", "doc_id", "text"))


@query()
def op5_packing(spark, sf):
    """Pack the token ids of all documents into binary matrices and tell what every packed row holds."""
    vocabulary = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    encoded = bpe.encode(_table(spark, sf, "documents", "doc_id", "text"), *vocabulary)
    index = packing.write(encoded, end=50_256)
    return index.select(
        "n_tokens", F.size("segments").alias("n_segments"), "cumulative",
        F.col("segments.doc_id").alias("doc_ids"), F.col("segments.first").alias("firsts"),
    )


@query("""
WITH v AS (SELECT vec_id, row_number() OVER () AS r, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.r, q.vec_id AS query_id, c.vec_id,
    list_sum(list_transform(list_zip(q.e, c.e), lambda z: coalesce(z[1] * z[2], 0)))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.r <> c.r),
t AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM t WHERE rank <= 5""")
def op6_max_score(spark, sf):
    """The five best other vectors for every fiftieth vector."""
    vectors = _table(spark, sf, "embeddings", "vec_id", "embedding")
    return maxscore.search(vectors, F.col("id") % 50 == 0, 5)


@query()
def op7_license_scan(spark, sf):
    """License notices in all documents."""
    return license_scan.scan(_table(spark, sf, "documents", "doc_id", "text"))


@query()
def op8_pii(spark, sf):
    """Spans of personal data in every text: fixed patterns and learnt contexts."""
    found = pii.find(_table(spark, sf, "documents", "doc_id", "text"))

    def of(kind):
        # A second parameter of the lambda, even one with a default, would be the place in the array.
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    counts = [of(i).alias(f"n_{name}") for i, name in enumerate(pii.KINDS)]
    told = pii.told(F.col("base"))
    return found.select("doc_id", *counts, F.sha2(told, 256).alias("base_sha256"), pii.told(F.col("spans")).alias("spans"))


@query()
def op9_order_minhash(spark, sf):
    """The class of near duplicates of every document."""
    found = order_minhash.classes(_table(spark, sf, "documents", "doc_id", "text"))
    return found.select("doc_id", "class_id", "class_size", (F.col("doc_id") == F.col("class_id")).alias("kept"))


@query("""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
b AS (SELECT page_id, html, strlen(html) AS payload_bytes, max(page_id) OVER (PARTITION BY html) AS largest FROM p)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, sha1(html) AS payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM largest THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM largest THEN largest END AS refers_to
FROM b""")
def op10_warc(spark, sf):
    """Write an archive record per page, then read all records back through the index."""
    index = warc.write(_table(spark, sf, "pages", "page_id", "url", "html"))
    return warc.read(index, payload=False).select(
        F.col("key").cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )


@query("""
WITH t AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS told, turn
  FROM conversations WHERE conv_id IS NOT NULL),
o AS (
  SELECT c, list({'told': told, 'chars': length(text)} ORDER BY turn NULLS FIRST, role, told) AS l,
    -- CRC-32 of the decimal digits, bit by bit
    xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
      lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1))))) % 6 AS h
  FROM t GROUP BY c),
r AS (SELECT o.c, list_concat(coalesce(b.l[1:o.h], []), o.l[o.h + 1:]) AS l FROM o LEFT JOIN o b ON b.c = o.c - o.c % 100),
p AS (SELECT c, l, d, list_transform(l[1:d], lambda x: x.told) AS pre, CASE WHEN d > 0 THEN l[d].chars ELSE 0 END AS chars
  FROM r, unnest(range(0, len(l) + 1)) u(d)),
n AS (
  SELECT pre, d, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * min(chars) AS saves,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE len(l) = d), '')) AS ends_sha256 FROM p GROUP BY pre, d),
k AS (SELECT pre[1:d - 1] AS pre, d - 1 AS d, count(*) AS n_children FROM n WHERE d > 0 GROUP BY ALL),
f AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k ON k.d = n.d AND k.pre = n.pre),
s AS (SELECT a.d, a.pre, count(*) FILTER (WHERE b.n_children = 0) AS n_leaves, sum(b.saves) AS saved
  FROM f a JOIN f b ON b.d >= a.d AND b.pre[1:a.d] = a.pre GROUP BY ALL)
SELECT f.conv_id, f.d::BIGINT AS depth, u.conv_id AS parent_conv_id, f.n_convs::BIGINT AS n_convs, f.n_children::BIGINT AS n_children,
  s.n_leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens, f.ends_sha256
FROM f JOIN s ON s.d = f.d AND s.pre = f.pre LEFT JOIN f u ON f.d > 0 AND u.d = f.d - 1 AND u.pre = f.pre[1:f.d - 1]""")
def op11_prefix_trie(spark, sf):
    """The trie of all rebuilt conversations: members, leaves, what sharing saves, and where conversations end."""
    return prefix_trie.build(_table(spark, sf, "conversations", "conv_id", "turn", "role", "text")).drop("from_conv", "from_place")


@query("""
WITH v AS (
  SELECT vec_id AS id, row_number() OVER () AS r, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.r AS anchor, a.id AS anchor_id, b.r, b.id, a.label = b.label AS alike,
    list_sum(list_transform(list_zip(a.e, b.e), lambda z: coalesce(z[1] * z[2], 0)))::BIGINT AS score
  FROM v a JOIN v b ON a.id % 100 = 0 AND a.r <> b.r),
p AS (SELECT anchor, anchor_id, r AS positive, id AS positive_id, score AS positive_score FROM s WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id NULLS LAST) <= 5),
n AS (SELECT p.*, s.id AS negative_id, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor, p.positive ORDER BY s.score DESC, s.id NULLS LAST)::INTEGER AS rank
  FROM p JOIN s ON s.anchor = p.anchor AND NOT alike AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10""")
def op12_hard_negatives(spark, sf):
    """Ten rows of other labels for every hundredth vector and each of its five nearest of its own label."""
    vectors = _table(spark, sf, "embeddings", "vec_id", "embedding", "label")
    turned = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors.withColumn("label", turned), F.col("id") % 100 == 0)


@query()
def op13_virtual_slots(spark, sf):
    """All documents in eight shards of near equal bytes, by a stored map of virtual slots."""
    documents = _table(spark, sf, "documents", "doc_id", "text")
    placed = sharding.assign(documents, scratch_path(spark, "slot-map"), 8)
    grown = F.lit(None).cast("int").alias("grown_shard")
    return placed.select(
        F.col("key").alias("doc_id"), "size", "text_crc32", "law", "shard", "slot", grown, "virtual_slot", "map_version"
    )
