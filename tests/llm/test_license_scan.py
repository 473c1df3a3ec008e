"""Alignment against the table of the longest common subsequence, notices in texts, and odd rows."""

import random

import pytest

from tarmac.llm import license_scan


def naive(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def rises(pairs):
    return all(a < c and b < d for (a, b), (c, d) in zip(pairs, pairs[1:]))


def test_common_and_alignment():
    rng = random.Random(1)
    for _ in range(1500):
        a, b = ([rng.choice("abcd") for _ in range(rng.randrange(1, 12))] for _ in range(2))
        exact = license_scan._common(a, b)
        assert len(exact) == naive(a, b) and rises(exact) and all(a[i] == b[j] for i, j in exact)
        pairs = license_scan.align(a, b)
        assert rises(pairs) and all(a[i] == b[j] for i, j in pairs) and len(pairs) <= len(exact)


def test_unique_anchors_win_over_repeated_words():
    a, b = "the x the y the z the".split(), "the y the z".split()
    assert license_scan.align(a, b) == [(0, 0), (3, 1), (4, 2), (5, 3)]


@pytest.mark.parametrize("seed", range(3))
def test_longest_rising_part(seed):
    rng = random.Random(seed)
    pairs = list(enumerate(rng.sample(range(50), 20)))
    got = license_scan.rising(pairs)
    best = naive([b for _, b in pairs], sorted(b for _, b in pairs))
    assert len(got) == best and rises(got)


def test_every_notice_is_found_in_full_and_changed(spark):
    rng, rows, want = random.Random(2), [], {}
    for i, (name, notice) in enumerate(license_scan.NOTICES.items()):
        words = notice.split()
        if len(words) > 5:
            words[rng.randrange(len(words))] += "x"
        filler = " ".join(f"f{rng.randrange(1000)}" for _ in range(3000))
        rows += [(2 * i, f"{filler}\n{notice.upper()}.\n{filler}"), (2 * i + 1, f"{filler} {' '.join(words)} {filler}")]
        want[2 * i], want[2 * i + 1] = name, name
    found = license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.license for r in found} == want and len(found) == len(want)
    texts = dict(rows)
    for r in found:
        held = texts[r.doc_id][r.start : r.end]
        assert len(held) <= 1.5 * len(license_scan.NOTICES[r.license])
        assert r.coverage == 1.0 or r.coverage >= 0.8


def test_odd_rows(spark):
    rows = [(1, None, "a"), (2, "", "b"), (None, "All rights reserved", "c"), (3, "Released under the MIT License. " * 3, "d"), (4, "the mit of released license", "e")]
    df = spark.createDataFrame(rows, "doc_id long, text string, license string")
    found = sorted(((r.doc_id, r.license, r.start) for r in license_scan.scan(df).collect()), key=str)
    assert found == sorted([(None, "reserved", 0), (3, "MIT", 0), (3, "MIT", 32), (3, "MIT", 64)], key=str)
    assert license_scan.scan(df.limit(0)).collect() == []
    assert license_scan.scan(df, {"none": "", "dots": "..."}).collect() == []


def test_every_license_text_is_found_once():
    scanner = license_scan.Scanner(license_scan.NOTICES | license_scan.TEXTS)
    for name, text in license_scan.TEXTS.items():
        hits = scanner.best(f"some words before. Copyright 2020 somebody\n{text}\nand others behind it")
        assert [h[0] for h in hits] == [name.partition(":")[0]], (name, hits)
        assert hits[0][1] == 1
    assert scanner.best("the software is provided to any person and this permission is granted " * 50) == []


@pytest.mark.parametrize(
    "text, license",
    [
        ("Released under the MIT License.", "MIT"), ("Released under the BSD License.", None), ("released under the new license", None),
        ("Released under the ISC license", None), ("Released under the GPL License", None),
        ("This work is licensed under the GNU General Public License, version 3.", "GPL-3.0"),
        ("This work is licensed under the GNU General Public License, version 2.", None),
        ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "MPL-2.0"),
        ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 1.1.", None),
        ("// SPDX-License-Identifier: Apache-2.0", "Apache-2.0"), ("SPDX-License-Identifier: GPL-2.0-or-later", "GPL-2.0"),
        ("SPDX-License-Identifier: Zlib", None), ("Licensed under CC BY-NC 4.0", "CC-BY-NC-4.0"), ("Licensed under CC BY-NC 2.5", None),
    ],
)
def test_names_and_versions_decide(text, license):
    known = license_scan.NOTICES | license_scan.TEXTS | license_scan.IDENTIFIERS
    scanner = license_scan.Scanner(known, decisive=True)
    padded = f"Some words before it stand here. {text} And some words come after it."
    assert [h[0] for h in scanner.best(padded)] == ([license] if license else [])


def test_unchanged_notices_are_found_among_their_own_words():
    rng = random.Random(7)
    known = license_scan.NOTICES
    scanner = license_scan.Scanner(known, decisive=True)
    for _ in range(60):
        body = [rng.choice(["the", "license", "river", "under", "work", "terms"]) for _ in range(60)]
        names = rng.sample(sorted(known), 2)
        for name, at in zip(names, (40, 20)):
            body[at:at] = [*known[name].split(), "river"]
        hits = scanner.best(" ".join(body))
        assert {h[0] for h in hits} == set(names) and all(h[1] == 1.0 for h in hits)
