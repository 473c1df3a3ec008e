"""Personal data: fixed patterns first, then contexts learnt from what they find.

The fixed patterns find e-mail addresses, IP addresses, card and phone numbers. These are the seeds. The words before a
seed (and, with one of them, the word after it) are lexical patterns. Other strings that look like
identifiers are candidates with patterns of the same kind. Spark scores the graph of patterns and
instances in rounds: a pattern is as sure of a kind as the share of its instances that are known to be of it (with a
least number of known ones), an instance as sure as its best pattern, and instances that are sure
enough are known in the next round. A candidate whose characters are those of a seed is known from the start. Spans of
known candidates are added to the spans of the fixed patterns, which all stay.

Places are code points, ends exclusive. Defined results: a null or empty text has no spans; identical
texts get identical spans; whole texts are searched, in time linear in their length; an empty table gives
an empty result. Other columns are kept; input columns of the names added are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tarmac.llm.common import shielded, text_of, worker_path
from tarmac.session import cut_lineage

KINDS = ("email", "ip", "card", "phone")
#: A pattern counts from so many known instances on, and an instance is known from this score on.
LEAST_KNOWN = 3
SURE = 0.8

# The same matches as the plain patterns, but a run that cannot match is not tried again from each of its characters.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")
#: Candidates: digits in groups, codes of letters and digits, words joined by an at sign or one spelt out.
_NUMBER = re.compile(r"(?<![A-Za-z0-9])\+?\(?[0-9]+\)?(?:[\x20./()-]{1,2}[0-9]+\)?)*+(?![A-Za-z0-9])")
_CODE = re.compile(r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]*+(?<=[A-Za-z0-9])")
_SPELT = re.compile(r"[A-Za-z0-9._%+-]{1,64}+[\x20]?(?:\(at\)|\[at\])[\x20]?[A-Za-z0-9-]{1,64}(?:(?:\.|[\x20]?(?:\(dot\)|\[dot\])[\x20]?)[A-Za-z0-9-]{1,64})+")
_BEFORE = re.compile(r"[^\x20\x09-\x0D]+")
_EDGE = "\"'`([{<>}]).,;!?*|&%$"
CONTEXT_CHARS = 96


class Span(NamedTuple):
    start: int
    end: int
    kind: int


def _luhn(digits: str) -> bool:
    doubled = [sum(divmod(2 * int(d), 10)) for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(doubled)) % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Around each at sign: the local part back to the end of the match before, the domain after it."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (domain := _DOMAIN.match(text, at + 1)):
            yield start, domain.end()
            free = domain.end()
        else:
            free = at + 1
        at = text.find("@", free)


def seeds(text: str) -> list[Span]:
    """Spans of the fixed patterns, by start, then kind."""
    found = [Span(start, end, 0) for start, end in _emails(text)] if "@" in text else []
    if _DIGITS.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
                found.append(Span(m.start(), m.end(), 1))
        for m in _CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and _luhn(digits):
                found.append(Span(m.start(), m.end(), 2))
        for m in _PHONE.finditer(text):
            if 10 <= len(_DIGITS.findall(m.group())) <= 15:
                found.append(Span(m.start(), m.end(), 3))
    return sorted(found, key=lambda s: (s.start, s.kind, s.end))


def candidates(text: str, known: list[Span]) -> list[tuple[int, int]]:
    """Other strings of an identifier's shape that overlap no seed."""
    found = []
    if _DIGITS.search(text):
        found += [(m.start(), m.end()) for m in _NUMBER.finditer(text) if len(_DIGITS.findall(m.group())) >= 7]
        for m in _CODE.finditer(text):
            word = m.group()
            if len(word) >= 6 and not word.isdigit() and len(_DIGITS.findall(word)) >= 4:
                found.append((m.start(), m.end()))
    if "(at)" in text or "[at]" in text:
        found += [(m.start(), m.end()) for m in _SPELT.finditer(text)]
    taken = sorted((s.start, s.end) for s in known)
    out: list[tuple[int, int]] = []
    at = 0
    for start, end in sorted(found, key=lambda f: (f[0], -f[1])):
        while at < len(taken) and taken[at][1] <= start:
            at += 1
        if (at == len(taken) or taken[at][0] >= end) and (not out or out[-1][1] <= start):
            out.append((start, end))
    return out


def instance(text: str) -> str:
    """What makes an identifier: its letters, digits and at signs."""
    plain = text.lower().replace("(at)", "@").replace("[at]", "@").replace("(dot)", ".").replace("[dot]", ".")
    return re.sub(r"[^a-z0-9@]", "", plain)


def patterns(text: str, start: int, end: int) -> list[str]:
    """Lexical patterns of a place: two words before; one before if it points on; one on each side."""
    before = [w.strip(_EDGE).lower() for w in _BEFORE.findall(text[max(0, start - CONTEXT_CHARS) : start])][-2:]
    after = [w.strip(_EDGE).lower() for w in _BEFORE.findall(text[end : end + CONTEXT_CHARS])][:2]
    before, after = [w for w in before if w], [w for w in after if w]
    out = []
    if len(before) == 2:
        out.append(f"{before[0]} {before[1]} _")
    if before and before[-1][-1] in ":=#":
        out.append(f"{before[-1]} _")
    if before and after:
        out.append(f"{before[-1]} _ {after[0]}")
    return out


_SPANS = "array<struct<start:int,end:int,kind:int>>"
_MENTIONS = "array<struct<start:int,end:int,kind:int,instance:string,patterns:array<string>>>"


def mentions(df: DataFrame, text: str = "text", base: str = "_base", found: str = "_mentions") -> DataFrame:
    """Add the spans of the fixed patterns, and all mentions: seeds, and candidates (kind -1)."""
    worker_path(df.sparkSession)

    @F.pandas_udf(f"base {_SPANS}, mentions {_MENTIONS}")
    def search(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in parts:
            bases, all_ = [], []
            for body in part:
                own = seeds(body)
                bases.append([s._asdict() for s in own])
                spans = [*own, *(Span(start, end, -1) for start, end in candidates(body, own))]
                all_.append(
                    [{**s._asdict(), "instance": instance(body[s.start : s.end]), "patterns": patterns(body, s.start, s.end)} for s in spans]
                )
            yield pd.DataFrame({"base": bases, "mentions": all_})

    searched = df.drop(base, found).withColumn("_searched", search(F.make_valid_utf8(text_of(text))))
    return searched.withColumn(base, F.col("_searched.base")).withColumn(found, F.col("_searched.mentions")).drop("_searched")


def bootstrap(edges: DataFrame, least: int = LEAST_KNOWN, sure: float = SURE) -> DataFrame:
    """``instance``, ``kind``: what the rounds find until one finds nothing new. ``edges`` is stored: ``pattern``, ``instance`` and ``kind`` (-1: not known)."""
    instances = edges.groupBy("pattern", "instance").agg(F.max("kind").alias("kind"))
    seeded = edges.where("kind >= 0").groupBy("instance").agg(F.min("kind").alias("known"))
    graph = cut_lineage(instances.where("pattern is not null").select("pattern", "instance"))
    seeded = cut_lineage(seeded)
    open_ = cut_lineage(edges.where("kind < 0").select("instance").distinct())
    same = open_.join(seeded, "instance").select("instance", F.col("known").alias("kind"))
    found = cut_lineage(same)
    known = seeded.select("instance", F.col("known").alias("kind"))
    totals = cut_lineage(graph.groupBy("pattern").agg(F.count("*").alias("total")))
    while True:
        support = cut_lineage(graph.join(known, "instance").groupBy("pattern", "kind").agg(F.count("*").alias("n")))
        scored = support.where(F.col("n") >= least).join(totals, "pattern").withColumn("score", F.col("n") / F.col("total"))
        strong = cut_lineage(scored.where(F.col("score") >= sure).groupBy("pattern").agg(F.max_by("kind", F.struct("score", -F.col("kind"))).alias("kind")))
        reached = graph.join(strong, "pattern").groupBy("instance").agg(F.min("kind").alias("kind"))
        fresh = cut_lineage(reached.join(known.select("instance"), "instance", "left_anti"))
        if fresh.isEmpty():
            break
        found = found.union(fresh)
        known = known.union(fresh)
    return cut_lineage(found)


def learnt(searched: DataFrame, digest: str = "_digest", found: str = "_mentions", **options) -> DataFrame:
    """``_digest`` and ``_added`` (spans) of texts with known candidates. ``searched`` is stored and holds digests and mentions."""
    each = searched.where(F.size(found) > 0).select(digest, F.explode(found).alias("m"))
    open_ = each.where("m.kind < 0")
    edges = each.select(F.explode_outer("m.patterns").alias("pattern"), "m.instance", "m.kind").where(F.length("instance") >= 6)
    known = bootstrap(cut_lineage(edges.distinct()), **options).withColumnRenamed("kind", "_kind")
    spans = open_.select(digest, F.col("m.start").alias("start"), F.col("m.end").alias("end"), F.col("m.instance").alias("instance"))
    spans = spans.distinct().join(known, "instance")
    added = F.array_sort(F.collect_list(F.struct("start", "end", F.col("_kind").alias("kind"))))
    return cut_lineage(spans.groupBy(digest).agg(added.alias("_added")))


def ordered(spans: Column) -> Column:
    """Spans by start, then kind, then end."""
    by = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    return F.sort_array(by)


def told(spans: Column) -> Column:
    """``kind:start:end`` of ordered spans, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


@shielded
def find(df: DataFrame, text: str = "text", **options) -> DataFrame:
    """Add ``base`` and ``spans``, both ordered, to all rows; the text itself is not kept."""
    rest = [f"`{c}`" for c in df.columns if c not in (text, "base", "spans")]
    digest = F.unhex(F.md5(text_of(text))).alias("_digest")
    searched = cut_lineage(mentions(df.select(*rest, digest, F.col(text).alias("_text")), "_text").drop("_text"))
    added = learnt(searched, **options).withColumnRenamed("_digest", "_of")
    # One row per text with additions, stored: sent to all tasks only if it is small.
    joined = searched.join(added, F.col("_digest") == F.col("_of"), "left")
    more = F.coalesce("_added", F.array().cast(_SPANS))
    return joined.select(*rest, ordered(F.col("_base")).alias("base"), ordered(F.concat("_base", more)).alias("spans"))


@shielded
def redact(df: DataFrame, text: str = "text", length: str | None = None, **options) -> DataFrame:
    """The rows of ``df`` with every span replaced by its kind in brackets; overlapping spans become one."""
    worker_path(df.sparkSession)
    digest = F.unhex(F.md5(text_of(text)))
    searched = cut_lineage(mentions(df.select(digest.alias("_digest"), F.col(text).alias("_text")), "_text").drop("_text"))
    added = learnt(searched, **options).withColumnRenamed("_digest", "_of")

    @F.pandas_udf("string")
    def mask(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for bodies, extra in parts:
            yield pd.Series([masked(b, x) for b, x in zip(bodies, extra, strict=True)], dtype=object)

    names = df.columns
    joined = df.join(added, digest == F.col("_of"), "left")
    clean = F.when(F.col(text).isNotNull(), mask(F.make_valid_utf8(text_of(text)), F.coalesce("_added", F.array().cast(_SPANS))))
    out = joined.withColumn("_clean", clean)
    fields = {text: F.col("_clean")}
    if length in names:
        fields[length] = F.length("_clean").cast(df.schema[length].dataType)
    return out.select(*[fields.get(c, F.col(f"`{c}`")).alias(c) for c in names])


def masked(text: str, added) -> str:
    """The text with its seeds and the added spans replaced."""
    spans = sorted([*seeds(text), *(Span(s["start"], s["end"], s["kind"]) for s in added)])
    out, at = [], 0
    for s in spans:
        if s.start >= at:
            out += [text[at : s.start], f"[{KINDS[s.kind].upper()}]"]
        at = max(at, s.end)
    return "".join(out) + text[at:] if out else text
