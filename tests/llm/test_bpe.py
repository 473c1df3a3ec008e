"""The transducer against the library, the decoder against Python's, and odd rows."""

import base64
import random
from array import array

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st

from tarmac.llm import bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
RANKS = bpe.parse_ranks(open(PATH, "rb").read())
PLAIN = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=RANKS, special_tokens={})
CODEC = bpe.Codec(RANKS, PATTERN)


def ids(text):
    return list(array("I", CODEC.encode(text)))


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    text = text.encode("utf-8", "replace").decode()
    assert ids(text) == PLAIN.encode_ordinary(text)
    assert CODEC.decode(CODEC.encode(text)) == text


@pytest.mark.parametrize("text", ["a" * 30_000, "ab" * 20_000, "é漢🙂" * 9_000, " \n\t" * 9_000, "x 1,\n" * 40_000, "", "🙂"])
def test_long_texts(text):
    assert ids(text) == PLAIN.encode_ordinary(text)
    assert CODEC.decode(CODEC.encode(text)) == text


def test_long_matches_are_told_as_they_come():
    rng = random.Random(1)
    text = "".join(rng.choice("abcdefgh") for _ in range(40_000))
    assert ids(text) == PLAIN.encode_ordinary(text)


def test_other_ranks_and_full_memos():
    """Random vocabularies, whose merges need not come in the order of their ranks, with memos that are always full."""
    rng = random.Random(2)
    for _ in range(30):
        tokens = [bytes((b,)) for b in range(256)]
        known = set(tokens)
        while len(tokens) < 300:
            joined = rng.choice(tokens[97:100] + tokens[256:]) + rng.choice(tokens[97:100] + tokens[256:])
            if joined not in known:
                tokens.append(joined)
                known.add(joined)
        if rng.random() < 0.5:
            rest = tokens[256:]
            rng.shuffle(rest)
            tokens[256:] = rest
        ranks = {t: i for i, t in enumerate(tokens)}
        machine = bpe.Transducer(ranks, max_pairs=5)
        for _ in range(40):
            piece = bytes(rng.choice(b"abc") for _ in range(rng.randrange(1, 30)))
            want = [ranks[piece]] if piece in ranks else [ranks[t] for t in bpe.merge(piece, ranks)]
            assert machine.encode(piece) == want


@given(st.binary(max_size=40), st.lists(st.integers(0, 40), max_size=6))
def test_utf8_in_blocks(data, cuts):
    stream, at, out = bpe.Utf8Stream(), 0, ""
    for cut in sorted({min(c, len(data)) for c in cuts} | {len(data)}):
        out += stream.feed(data[at:cut])
        at = cut
    assert out + stream.end() == data.decode("utf-8", "replace")


def test_odd_rows(spark):
    rows = [(1, None, "a"), (2, "", "b"), (None, "one two", "c"), (None, "one two", "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = bpe.decode(bpe.encode(df, PATH, PATTERN), PATH, PATTERN)
    assert sorted(out.columns) == ["decoded", "doc_id", "ids", "text"]
    assert [(r.text, r.decoded) for r in out.collect()] == [(None, ""), ("", ""), ("one two", "one two"), ("one two", "one two")]
    assert bpe.encode(df.limit(0), PATH, PATTERN).collect() == []


def test_bytes_that_are_not_utf8(spark):
    df = spark.sql("SELECT 1L AS doc_id, CAST(X'41FF42' AS STRING) AS text")
    out = bpe.decode(bpe.encode(df, PATH, PATTERN), PATH, PATTERN).select("decoded").first()
    assert out.decoded == "A�B"


def test_ranks_are_parsed():
    assert bpe.parse_ranks(base64.b64encode(b"ab") + b" 7\n") == {b"ab": 7}


def test_matches_together_equal_one_by_one(spark):
    rng = random.Random(3)
    texts = [" ".join("".join(rng.choice("abcdeé漢 ") for _ in range(rng.randrange(12))) for _ in range(90)) for _ in range(60)]
    texts += [None, "", "x", "z" * 100_000, "ab" * 40]
    codec = bpe.Codec(RANKS, PATTERN)
    asked, one = [], codec.matches.transducer.encode
    codec.matches.transducer.encode = lambda piece: asked.append(piece) or one(piece)
    got = [list(array("I", packed)) for packed in codec.encode_all(texts)]
    assert got == [PLAIN.encode_ordinary(t or "") for t in texts]
    # Unseen matches went through the machine together, but for very long ones.
    assert {len(piece) > 64 for piece in asked} <= {True}
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: list(array("I", r.ids)) for r in bpe.encode(rows, PATH, PATTERN).collect()} == dict(enumerate(got))


def test_matches_together_with_other_ranks_and_full_memos(monkeypatch):
    """Vocabularies as above, with few places for pairs, so that they share them."""
    monkeypatch.setattr(bpe, "PAIR_PLACES", 4)
    rng = random.Random(4)
    for _ in range(20):
        tokens = [bytes((b,)) for b in range(256)]
        while len(tokens) < 300:
            joined = rng.choice(tokens[97:100] + tokens[256:]) + rng.choice(tokens[97:100] + tokens[256:])
            if joined not in tokens:
                tokens.append(joined)
        rest = tokens[256:]
        rng.shuffle(rest)
        ranks = {t: i for i, t in enumerate(tokens[:256] + rest)}
        machine = bpe.Transducer(ranks, max_pairs=5)
        pieces = [bytes(rng.choice(b"abc") for _ in range(rng.randrange(1, 30))) for _ in range(40)]
        pieces = [p for p in pieces if p not in ranks]
        assert [list(array("I", p)) for p in machine.encode_all(pieces)] == [[ranks[t] for t in bpe.merge(p, ranks)] for p in pieces]
        assert machine.encode_all([]) == []
    with pytest.raises(ValueError, match="byte 100|single bytes"):
        bpe.Transducer({b"a": 0, b"b": 1}).encode_all([b"abd"])


@settings(max_examples=500, deadline=None)
@given(st.text(st.characters(max_codepoint=127), max_size=60), st.text(st.characters(max_codepoint=bpe.WRITTEN_OUT - 1), max_size=60))
def test_patterns_written_out_split_alike(ascii, other):
    for text in (ascii, other, ascii + other):
        assert CODEC.written_out.findall(text) == CODEC.pattern.findall(text)


def test_every_character_is_split_alike():
    for i in range(0x110000):
        if not 0xD800 <= i < 0xE000:
            text = f"a {chr(i)}1{chr(i)}  {chr(i)}"
            assert i >= bpe.WRITTEN_OUT or CODEC.written_out.findall(text) == CODEC.pattern.findall(text)
            assert (CODEC._later.search(text) is not None) == (i >= bpe.WRITTEN_OUT)
