"""License notices found by patience alignment.

A text and a template are aligned on the words that are unique in both: the longest run of them that rises in both is
kept, and the gaps between are aligned the same way, where words that were not unique before may be. Equal
words at the ends of a gap match at once; a gap without unique words is aligned by its longest common
subsequence. Coverage is the share of the template's words that are matched.

Texts are not aligned as a whole: around every place of a template's rarest words lies a window in proportion to the
template, and windows are aligned from left to right, each beyond the last hit. So the work
grows with the text, however long it is, and a notice is found as often as it is there.

Without templates of the caller, the customary notices below and the texts, conditions and headers of ``license_texts`` are
looked for. Many of these share words, so of overlapping hits in them the one with most words matched counts, then the one that covers more.

A template is aligned only in documents and windows that hold so many of its words, each as often as the template at most, that
a hit is possible.

Words that tell one license from another are few. A known text of up to ``WHOLE`` words, or one line that gives an identifier, must be there
whole. In one of less than ``LONG`` words no number and no word that names a license may stand where the text has another.

Words are runs of letters and digits, lower case. Defined results: a null or empty text has no hits; identical texts
have identical hits; templates without words are never found; an empty table gives no rows.
"""

from __future__ import annotations

import bisect
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tarmac.llm.common import text_of, worker_path
from tarmac.llm.license_texts import TEXTS

#: Customary short notices of public licenses.
NOTICES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "MIT": "Released under the MIT License",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "reserved": "All rights reserved",
}
LEAST = 0.8
#: Known texts of up to so many words must be matched whole; in those below ``LONG`` words other numbers and names count against a hit.
WHOLE = 5
LONG = 100
#: Words that name a license.
NAMES = frozenset(
    "affero apache attribution bsd cc commons creative general gnu isc lesser mit mozilla nc nd noncommercial noderivatives sa sharealike "
    "agpl cc0 clause gpl identifier lgpl mpl reserved spdx".split()
)
#: One line that names a license, for every license with a known text.
IDENTIFIERS = {
    f"{name}:identifier": f"SPDX-License-Identifier: {name}"
    for name in sorted({n.partition(":")[0] for n in NOTICES | TEXTS} - {"reserved", "BSD"})
}
_WORD = re.compile(r"[^\W_]+")
_HIT = "license string, coverage double, start int, end int"


def rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest part of pairs, sorted by the first place, whose second places rise too (patience piles)."""
    tops: list[int] = []
    ends: list[int] = []
    before: list[int] = []
    for i, (_, b) in enumerate(pairs):
        pile = bisect.bisect_left(tops, b)
        before.append(ends[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(b)
            ends.append(i)
        else:
            tops[pile], ends[pile] = b, i
    out, at = [], ends[-1] if ends else -1
    while at >= 0:
        out.append(pairs[at])
        at = before[at]
    return out[::-1]


def _common(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Places of a longest common subsequence, from the rows of its table kept as integers."""
    places: dict[str, int] = defaultdict(int)
    for i, x in enumerate(a):
        places[x] |= 1 << i
    full = (1 << len(a)) - 1
    rows = [full]
    for y in b:
        met = rows[-1] & places.get(y, 0)
        rows.append(((rows[-1] + met) | (rows[-1] - met)) & full)
    out, i, j = [], len(a) - 1, len(b)
    # A zero bit i of row j: the subsequence of a[: i + 1] and b[:j] is longer than that of a[:i].
    while i >= 0 and j > 0:
        if rows[j] >> i & 1:
            i -= 1
        elif not rows[j - 1] >> i & 1:
            j -= 1
        else:
            out.append((i, j - 1))
            i, j = i - 1, j - 1
    return out[::-1]


def align(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Matched places of two word lists, in order."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        times_a, times_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {b[j]: j for j in range(b0, b1)}
        unique = [(i, place[a[i]]) for i in range(a0, a1) if times_a[a[i]] == 1 and times_b.get(a[i]) == 1]
        if not unique:
            out += [(a0 + i, b0 + j) for i, j in _common(a[a0:a1], b[b0:b1])]
            continue
        for i, j in rising(unique):
            out.append((i, j))
            todo.append((a0, i, b0, j))
            a0, b0 = i + 1, j + 1
        todo.append((a0, a1, b0, b1))
    return sorted(out)


class Scanner:
    """Templates with the words that call for an alignment."""

    def __init__(self, templates: dict[str, str], least: float = LEAST, decisive: bool = False):
        """``decisive``: very short templates must be matched whole, and others not against a number or name that is another."""
        self.templates = {n: [w.lower() for w in _WORD.findall(t)] for n, t in templates.items()}
        self.templates = {n: w for n, w in self.templates.items() if w}
        whole = {n for n, w in self.templates.items() if decisive and (len(w) <= WHOLE or w[0] == "spdx")}
        self.needed = {n: len(w) if n in whole else max(1, -int(-least * len(w) // 1)) for n, w in self.templates.items()}
        self.musts = {
            n: {i for i, x in enumerate(w) if x.isdigit() or x in NAMES} if decisive and len(w) < LONG else set()
            for n, w in self.templates.items()
        }
        times = Counter(w for words in self.templates.values() for w in set(words))
        self.calls: dict[str, list[tuple[str, int]]] = {}
        self.counts: dict[str, Counter] = {}
        for name, words in self.templates.items():
            # A hit may lack some words of the template, so one more than that many words call for it.
            missing = len(words) - self.needed[name]
            own = Counter(words)
            self.counts[name] = own
            order = sorted(range(len(words)), key=lambda i: (times[words[i]], own[words[i]], -len(words[i]), i))
            for i in order[: missing + 1]:
                self.calls.setdefault(words[i], []).append((name, i))

    def scan(self, text: str) -> list[tuple[str, float, int, int]]:
        words = [w.lower() for w in _WORD.findall(text)] if text else []
        held = Counter(words)
        open_ = {n for n in self.templates if self._possible(n, held, len(words))}
        if not open_:
            return []
        calls = {w: some for w, each in self.calls.items() if w in held and (some := [c for c in each if c[0] in open_])}
        found = list(_WORD.finditer(text))
        hits, free = [], dict.fromkeys(self.templates, 0)
        for at, word in enumerate(words):
            for name, place in calls.get(word, ()):
                template = self.templates[name]
                slack = len(template) // 4 + 1
                begin = max(free[name], at - place - slack)
                end = min(len(words), at - place + len(template) + slack)
                if at < free[name]:
                    continue
                if not self._possible(name, words[begin:end], end - begin):
                    continue
                pairs = align(words[begin:end], template)
                if len(pairs) >= self.needed[name] and not self._another(name, words[begin:end], pairs):
                    first, last = begin + pairs[0][0], begin + pairs[-1][0]
                    hits.append((name, len(pairs) / len(template), found[first].start(), found[last].end()))
                    free[name] = last + 1
        return sorted(hits, key=lambda h: (h[2], h[0]))

    def _another(self, name: str, words: list[str], pairs: list[tuple[int, int]]) -> bool:
        """Whether a number or name of the template is missed and the text has another in its place."""
        missed = self.musts[name] - {j for _, j in pairs}
        for place in missed:
            k = bisect.bisect([j for _, j in pairs], place)
            after = pairs[k - 1][0] + 1 if k else 0
            upto = pairs[k][0] if k < len(pairs) else after + 2
            if any(w.isdigit() or w in NAMES for w in words[after if k else max(0, upto - 2) : upto]):
                return True
        return False

    def _possible(self, name: str, words, size: int) -> bool:
        """Whether so many words, with their counts or as a list, can hold a hit: each matches as often as it is in both at most."""
        own, needed = self.counts[name], self.needed[name]
        missing = len(self.templates[name]) - needed
        if size < needed or len(own.keys() & (words.keys() if isinstance(words, Counter) else set(words))) < len(own) - missing:
            return False
        held = words if isinstance(words, Counter) else Counter(words)
        return sum(min(n, held[w]) for w, n in own.items()) >= needed

    def best(self, text: str) -> list[tuple[str, float, int, int]]:
        """Hits by license, ``license:part`` being the names; of overlapping ones that with most words matched, then covered."""
        kept: list[tuple[str, float, int, int]] = []
        for hit in sorted(self.scan(text), key=lambda h: (-round(h[1] * len(self.templates[h[0]])), -h[1], h[2], h[0])):
            if all(hit[3] <= k[2] or k[3] <= hit[2] for k in kept):
                kept.append(hit)
        return sorted(((name.partition(":")[0], *rest) for name, *rest in kept), key=lambda h: (h[2], h[0]))


def scan(
    df: DataFrame, templates: dict[str, str] | None = None, least: float = LEAST, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per notice: ``key``, ``license``, ``coverage``, ``start`` and ``end`` (code points, end exclusive)."""
    worker_path(df.sparkSession)
    known = NOTICES | TEXTS | IDENTIFIERS if templates is None else templates
    fields = [c.split()[0] for c in _HIT.split(", ")]

    @F.pandas_udf(f"array<struct<{_HIT.replace(' ', ':').replace(',:', ',')}>>")
    def hits(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scanner = Scanner(known, least, decisive=templates is None)
        of = scanner.best if templates is None else scanner.scan
        for part in parts:
            yield part.map(lambda body: [dict(zip(fields, hit, strict=True)) for hit in of(body)])

    found = df.select(F.col(key).alias(key), hits(F.make_valid_utf8(text_of(text))).alias("_hits"))
    return found.select(key, F.inline("_hits"))
