"""Byte-level BPE as a finite-state transducer.

The merges are given as ranks of byte strings. Each match of the split pattern is encoded by itself by a transducer that reads one byte at a time.
A token may begin at every byte, so the machine is a trie with a loop at its root. It is determinised as far as the
texts ask for: a state stands for all tokens begun and not ended (each is a suffix of the longest, which names it), and its output
are the tokens that end there. A byte sequence is the BPE of its text exactly if every two neighbouring tokens are, and
every prefix of a text has one encoding, so exactly one token that ends at a byte goes with the token before it.
A token is told as soon as all tokens begun lie beyond it or lead back to it; no token is longer than the longest of the vocabulary, which bounds
the lookahead. Unseen matches of several texts go through the machine together, a byte of each at a time. Memos of neighbours and of matches
seen lately are emptied when they are full, which changes no result.

Decoding joins the tokens' bytes in blocks and turns them to text with a state machine that carries an
unfinished UTF-8 sequence from block to block.

Token ids are kept as packed little-endian unsigned 32-bit integers (``ids``, binary), the form in which
training shards hold them. Defined results: a null or empty text has no ids; bytes that are not UTF-8 are
read as U+FFFD (and written as such by the decoder); null ids decode to an empty text; ids outside of the vocabulary are an
error. Texts of any length are encoded in blocks cut where the pattern cannot match across, and decoded in
blocks. Identical rows get identical ids; empty tables stay empty; an input column of the result's name is
replaced, all others are kept.
"""

from __future__ import annotations

import base64
import gc
import re
import sys
from array import array
from collections.abc import Iterable, Iterator
from itertools import compress, repeat
from operator import is_

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F

from tarmac.llm.common import text_of, worker_path

#: Vocabulary files are broadcast to the workers; larger ones are refused.
MAX_VOCABULARY_BYTES = 64 << 20
MAX_PAIRS = 400_000
MAX_MATCHES = 600_000
#: Within one match, tokens are told every so many bytes.
TOLD_BYTES = 1 << 12
#: Pairs of neighbours whose answer an array holds, the last one asked for in each place; a power of two.
PAIR_PLACES = 1 << 20
#: Texts of so many characters are looked through for unseen matches at once; so few of these are encoded one by one.
TEXT_CHARS = 1 << 21
FEW_MATCHES = 200
LONG_MATCH = 64
BLOCK_CHARS = 1 << 16
BLOCK_IDS = 1 << 16




def parse_ranks(content: bytes) -> dict[bytes, int]:
    """Lines of a base64 token and its rank."""
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in content.splitlines() if line.strip())}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """Plain BPE: join the neighbours of lowest rank, the leftmost first, until none is in the ranks."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        rank, at = min((ranks.get(parts[i] + parts[i + 1], sys.maxsize), i) for i in range(len(parts) - 1))
        if rank == sys.maxsize:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts


class Seams:
    """Whether BPE leaves two tokens whole side by side.

    Merges run in the order of their ranks. What can go wrong is a merge across the seam, so only the
    part that ends the left token and the part that begins the right one matter, as both grow towards
    their tokens: the seam breaks if at some time their join has a rank below the next growth of
    either (on a tie the leftmost goes first). That holds where every merge ranks above those that made
    its parts; tokens for which it does not are merged in full.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.grown: dict[bytes, tuple[list[bytes], list[bytes]] | None] = {}

    def whole(self, token: bytes) -> bool:
        """Whether the token's bytes merge to the token."""
        return self._growth(token) is not None or merge(token, self.ranks) == [token]

    def _growth(self, token: bytes) -> tuple[list[bytes], list[bytes]] | None:
        """First and last parts while the token is merged; None if it is not, or not in order."""
        if token not in self.grown:
            parts, first, last, before = [token[i : i + 1] for i in range(len(token))], [token[:1]], [token[-1:]], -1
            while len(parts) > 1:
                rank, at = min((self.ranks.get(parts[i] + parts[i + 1], sys.maxsize), i) for i in range(len(parts) - 1))
                if rank == sys.maxsize or rank < before:
                    break
                before = rank
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
                if at == 0:
                    first.append(parts[0])
                if at == len(parts) - 1:
                    last.append(parts[-1])
            self.grown[token] = (first, last) if len(parts) == 1 else None
        return self.grown[token]

    def holds(self, left: bytes, right: bytes) -> bool:
        ends, begins = self._growth(left), self._growth(right)
        if ends is None or begins is None:
            return merge(left + right, self.ranks) == [left, right]
        tails, heads, ranks = ends[1], begins[0], self.ranks
        i = j = 0
        while True:
            across = ranks.get(tails[i] + heads[j], sys.maxsize)
            tail = ranks[tails[i + 1]] if i + 1 < len(tails) else sys.maxsize
            head = ranks[heads[j + 1]] if j + 1 < len(heads) else sys.maxsize
            if across < tail and across <= head and across != sys.maxsize:
                return False
            if tail == head == sys.maxsize:
                return True
            if tail <= head:
                i += 1
            else:
                j += 1


class Transducer:
    """Encodes the bytes of one match at a time."""

    def __init__(self, ranks: dict[bytes, int], max_pairs: int = MAX_PAIRS):
        self.ranks, self.max_pairs = ranks, max_pairs
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.prefixes = {token[:n] for token in ranks for n in range(1, len(token) + 1)}
        self.seams = Seams(ranks)
        self.pairs: dict[tuple[int, int], bool] = {}
        self.names: list[bytes] = [b""]
        self.states: dict[bytes, int] = {b"": 0}
        self.steps: list[dict[int, int]] = [{}]
        #: (id, length) of the tokens that end in a state, the longest first.
        self.ending: list[list[tuple[int, int]]] = [[]]
        #: The same as arrays: steps (-1: not made yet), and where a state's tokens begin among all, with length 0 behind the last.
        self.table = np.full((64, 256), -1, dtype=np.int32)
        self.first = np.zeros(64, dtype=np.int64)
        self.end_token, self.end_size, self.listed = np.zeros(64, dtype=np.int64), np.zeros(64, dtype=np.int64), [0, 0]
        self.asked = np.full(PAIR_PLACES, -1, dtype=np.int64)
        self.answers = np.zeros(PAIR_PLACES, dtype=bool)

    def _step(self, state: int, byte: int) -> int:
        """Make the transition: of the tokens begun, those that take the byte go on; the longest names the state."""
        name = self.names[state] + bytes((byte,))
        while name not in self.prefixes:
            if not name:
                raise ValueError(f"byte {byte} is not in the vocabulary")
            name = name[1:]
        after = self.states.get(name)
        if after is None:
            after = self.states[name] = len(self.names)
            self.names.append(name)
            self.steps.append({})
            ends = [(self.ranks[name[k:]], len(name) - k) for k in range(len(name)) if name[k:] in self.ranks]
            self.ending.append([e for e in ends if self.seams.whole(self.tokens[e[0]])])
        self.steps[state][byte] = after
        return after

    def _goes(self, pair: tuple[int, int]) -> bool:
        """Whether a token stays whole after another, or at the start of a match (-1)."""
        if len(self.pairs) >= self.max_pairs:
            self.pairs.clear()
        left, right = pair
        self.pairs[pair] = goes = left < 0 or self.seams.holds(self.tokens[left], self.tokens[right])
        return goes

    def encode(self, piece: bytes) -> list[int]:
        """Token ids of one match; a match that is a token by itself is that token."""
        if piece in self.ranks:
            return [self.ranks[piece]]
        ids: list[int] = []
        # The token that ends at each place not yet told, and its length.
        last, size, state = [-1], [0], 0
        steps, ending, pairs = self.steps, self.ending, self.pairs
        for byte in piece:
            state = steps[state].get(byte) or self._step(state, byte)
            for token, n in ending[state]:
                if n <= len(last):
                    pair = (last[-n], token)
                    goes = pairs.get(pair)
                    if self._goes(pair) if goes is None else goes:
                        last.append(token)
                        size.append(n)
                        break
            else:
                raise ValueError("the vocabulary does not hold all single bytes")
            if len(last) > 2 * TOLD_BYTES:
                self._tell(state, ids, last, size)
        return ids + self._chain(last, size, len(last) - 1)

    def _list(self) -> None:
        """Bring the arrays of states up to date."""
        states, tokens = self.listed
        new = [t for state in self.ending[states:] for t in (*state, (0, 0))]
        if len(self.names) > len(self.table):
            more = max(len(self.names), 2 * len(self.table)) - len(self.table)
            self.table = np.concatenate([self.table, np.full((more, 256), -1, dtype=np.int32)])
            self.first = np.concatenate([self.first, np.zeros(more, dtype=np.int64)])
        if tokens + len(new) > len(self.end_token):
            more = np.zeros(tokens + len(new), dtype=np.int64)
            self.end_token, self.end_size = np.concatenate([self.end_token, more]), np.concatenate([self.end_size, more])
        self.end_token[tokens : tokens + len(new)] = [token for token, _ in new]
        self.end_size[tokens : tokens + len(new)] = [n for _, n in new]
        lengths = [len(state) + 1 for state in self.ending[states:]]
        self.first[states : len(self.names)] = tokens + np.cumsum([0, *lengths])[:-1]
        self.listed = [len(self.names), tokens + len(new)]

    def _go(self, left: np.ndarray, token: np.ndarray) -> np.ndarray:
        """Whether tokens stay whole after others, given one higher, or at the start of a match (0)."""
        asked = (left << 32) | token
        at = ((asked.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).view(np.int64) & (PAIR_PLACES - 1)
        goes = self.answers[at]
        new = np.flatnonzero(self.asked[at] != asked)
        if len(new):
            different, which = np.unique(asked[new], return_inverse=True)
            told = []
            for key in different.tolist():
                pair = ((key >> 32) - 1, key & 0xFFFFFFFF)
                known = self.pairs.get(pair)
                told.append(self._goes(pair) if known is None else known)
            goes[new] = np.array(told, dtype=bool)[which]
            # Of several pairs with one place any may stay, with its own answer.
            self.asked[at[new]] = asked[new]
            stays = self.asked[at[new]] == asked[new]
            self.answers[at[new][stays]] = goes[new][stays]
        return goes

    def encode_all(self, pieces: list[bytes]) -> list[bytes]:
        """Packed ids of many matches, none of them empty: the machine reads a byte of each at a time."""
        lengths = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        order = np.argsort(-lengths, kind="stable")
        text, starts, lengths = np.frombuffer(b"".join(pieces), dtype=np.uint8), (np.cumsum(lengths) - lengths)[order], lengths[order]
        longest = int(lengths[0]) if len(lengths) else 0
        # The token that ends at each place, one higher (0 at the start), and its length.
        last, size = (np.zeros((longest + 1, len(pieces)), dtype=np.int32) for _ in range(2))
        state = np.zeros(len(pieces), dtype=np.int64)
        for place in range(1, longest + 1):
            here = int(np.searchsorted(-lengths, -place, side="right"))
            byte = text[starts[:here] + (place - 1)]
            before, now = state[:here], self.table[state[:here], byte]
            if len(new := np.flatnonzero(now < 0)):
                for step in np.unique(before[new] * 256 + byte[new]).tolist():
                    after = self._step(step // 256, step % 256)
                    if len(self.names) > self.listed[0]:
                        self._list()
                    self.table[step // 256, step % 256] = after
                now = self.table[before, byte]
            state[:here] = now
            open_, at = np.arange(here), self.first[now]
            while len(open_):
                token, n = self.end_token[at], self.end_size[at]
                if not n.all():
                    raise ValueError("the vocabulary does not hold all single bytes")
                goes = self._go(last[place - n, open_].astype(np.int64), token)
                done, left = open_[goes], ~goes
                last[place, done], size[place, done] = token[goes] + 1, n[goes]
                open_, at = open_[left], at[left] + 1
        # From the end back.
        told, open_, at = [], np.arange(len(pieces)), lengths
        counts = np.zeros(len(pieces), dtype=np.int64)
        while len(open_):
            told.append((open_, last[at, open_] - 1))
            counts[open_] += 1
            at = at - size[at, open_]
            open_, at = open_[at > 0], at[at > 0]
        ends = np.cumsum(counts)
        ids = np.empty(int(ends[-1]) if len(ends) else 0, dtype="<u4")
        for i, (of, token) in enumerate(told):
            ids[ends[of] - 1 - i] = token
        packed, out = ids.tobytes(), [b""] * len(pieces)
        for i, begin, end in zip(order.tolist(), (4 * (ends - counts)).tolist(), (4 * ends).tolist(), strict=True):
            out[i] = packed[begin:end]
        return out

    @staticmethod
    def _chain(last: list[int], size: list[int], at: int) -> list[int]:
        """The tokens up to a place, from the end back."""
        out = []
        while at > 0:
            out.append(last[at])
            at -= size[at]
        return out[::-1]

    def _tell(self, state: int, ids: list[int], last: list[int], size: list[int]) -> None:
        """Tell the tokens that lie before all tokens begun, whichever of them goes on."""
        end, name = len(last) - 1, self.names[state]
        open_ = {end} | {end - n for n in range(1, len(name) + 1) if name[len(name) - n :] in self.prefixes and n <= end}
        # Each place leads back to one before it; where all have met, nothing can change any more.
        while len(open_) > 1:
            latest = max(open_)
            open_.remove(latest)
            open_.add(latest - size[latest])
        settled = open_.pop()
        ids += self._chain(last, size, settled)
        del last[:settled], size[:settled]


class Matches(dict):
    """Packed ids of the matches seen lately. When full, those not asked for since the last time go."""

    def __init__(self, transducer: Transducer, most: int = MAX_MATCHES):
        self.transducer, self.most = transducer, most
        self.before: dict[str, bytes] = {}

    def __missing__(self, match: str) -> bytes:
        packed = self.before.get(match)
        if packed is None:
            ids = array("I", self.transducer.encode(match.encode("utf-8", "replace")))
            if sys.byteorder == "big":
                ids.byteswap()
            packed = ids.tobytes()
        if len(match) <= LONG_MATCH:
            if 2 * len(self) >= self.most:
                self.before = dict(self)
                self.clear()
            self[match] = packed
        return packed

    def seen(self, matches: list[str]) -> tuple[list[bytes | None], list[int], list[str]]:
        """Packed ids of the matches of a text, and the places and names of those not seen."""
        parts = list(map(self.get, matches))
        places = list(compress(range(len(parts)), map(is_, parts, repeat(None))))
        return parts, places, [matches[i] for i in places]

    def filled(self, texts: list[tuple[list[bytes | None], list[int], list[str]]]) -> Iterator[bytes]:
        """Packed ids of several texts, whose unseen matches are encoded together."""
        self._learn({m for _, _, unseen in texts for m in unseen})
        for parts, places, unseen in texts:
            for i, match in zip(places, unseen, strict=True):
                parts[i] = self[match]
            yield b"".join(parts)

    def _learn(self, new: set[str]) -> None:
        """Encode unseen matches together; a few, and very long ones, are left to be asked for."""
        before = self.before
        again = [m for m in new if m in before]
        unseen = [m for m in new.difference(again) if len(m) <= LONG_MATCH]
        if len(unseen) < FEW_MATCHES:
            return
        pieces = [m.encode("utf-8", "replace") for m in unseen]
        whole = list(map(self.transducer.ranks.get, pieces))
        parted = [rank is None for rank in whole]
        packed = iter(self.transducer.encode_all(list(compress(pieces, parted))))
        if 2 * (len(self) + len(new)) >= self.most:
            self.before = dict(self)
            self.clear()
        self.update(zip(again, map(before.__getitem__, again), strict=True))
        self.update(zip(unseen, [next(packed) if rank is None else rank.to_bytes(4, "little") for rank in whole], strict=True))


class Utf8Stream:
    """Text of byte blocks; an unfinished sequence waits for the next block."""

    def __init__(self):
        self.waiting = b""

    def feed(self, block: bytes) -> str:
        block = self.waiting + block
        cut = len(block)
        for back in range(1, min(3, cut) + 1):
            byte = block[-back]
            if byte >= 0xC0:
                needs = 2 if byte < 0xE0 else 3 if byte < 0xF0 else 4
                cut -= back if needs > back else 0
                break
            if byte < 0x80:
                break
        self.waiting = block[cut:]
        return block[:cut].decode("utf-8", "replace")

    def end(self) -> str:
        rest, self.waiting = self.waiting, b""
        return rest.decode("utf-8", "replace")


#: Split patterns that the standard library's engine, which takes less time, can follow once their classes are written out.
KNOWN_PATTERNS = {
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+": (
        "'s|'t|'re|'ve|'m|'ll|'d| ?[{L}]+| ?[{N}]+| ?[^{S}{L}{N}]+|[{S}]+(?![^{S}])|[{S}]+"
    )
}
#: Classes are written out for the characters before this one.
WRITTEN_OUT = 0x3000


def written_out(pattern: str) -> str | None:
    """The like of a known pattern for texts without later characters."""
    if pattern not in KNOWN_PATTERNS:
        return None
    out, all_ = KNOWN_PATTERNS[pattern], "".join(map(chr, range(WRITTEN_OUT)))
    for name, kind in (("{L}", r"\p{L}+"), ("{N}", r"\p{N}+"), ("{S}", r"\s+")):
        out = out.replace(name, "".join(f"\\u{ord(x[0]):04x}-\\u{ord(x[-1]):04x}" for x in regex.findall(kind, all_)))
    return out


class Codec:
    """Encoder and decoder of one vocabulary, with the memos of this worker."""

    _cut = regex.compile(r"(?<=\S)\s")
    _later = re.compile(f"[{chr(WRITTEN_OUT)}-\U0010ffff]")

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.matches = Matches(Transducer(ranks))
        self.pattern = regex.compile(pattern)
        out = written_out(pattern)
        self.written_out = re.compile(out) if out else None
        self.tokens = self.matches.transducer.tokens

    def _split(self, text: str) -> list[str]:
        if self.written_out and (text.isascii() or not self._later.search(text)):
            return self.written_out.findall(text)
        return self.pattern.findall(text)

    def blocks(self, text: str) -> Iterator[str]:
        """Parts of about BLOCK_CHARS that begin at a space after a non-space, where a match always begins."""
        at = 0
        while len(text) - at > 2 * BLOCK_CHARS and (cut := self._cut.search(text, at + BLOCK_CHARS)):
            yield text[at : cut.start()]
            at = cut.start()
        yield text[at:]

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        return b"".join(b"".join(map(self.matches.__getitem__, self._split(x))) for x in self.blocks(text))

    def encode_all(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """The same for many texts, in order; unseen matches of about ``TEXT_CHARS`` are encoded together."""
        held = []
        chars = 0
        for text in texts:
            long = text is not None and len(text) > BLOCK_CHARS
            if chars >= TEXT_CHARS or long:
                yield from self.matches.filled(held)
                held, chars = [], 0
            if long:
                yield self.encode(text)
            else:
                held.append(self.matches.seen(self._split(text or "")))
                chars += len(text or "")
        yield from self.matches.filled(held)

    def decode(self, packed: bytes | None) -> str:
        ids = array("I", packed or b"")
        if sys.byteorder == "big":
            ids.byteswap()
        stream = Utf8Stream()
        told = [
            stream.feed(b"".join(map(self.tokens.__getitem__, ids[at : at + BLOCK_IDS]))) for at in range(0, len(ids), BLOCK_IDS)
        ]
        return "".join(told) + stream.end()


_CODECS: dict[tuple[int, str], Codec] = {}


def codec(content: bytes, pattern: str) -> Codec:
    """The codec of a vocabulary, made once in each worker process."""
    key = (hash(content), pattern)
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(parse_ranks(content), pattern)
        # Vocabulary and memos have no cycles: the collector need not walk through them again and again.
        gc.freeze()
    return _CODECS[key]


def _vocabulary(spark: SparkSession, path: str):
    with open(path, "rb") as file:
        content = file.read()
    if len(content) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path} has {len(content)} bytes, more than a vocabulary may have")
    worker_path(spark)
    return spark.sparkContext.broadcast(content)


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", into: str = "ids") -> DataFrame:
    """Add packed token ids of ``text``; ``path`` is a file of ranks the driver can read."""
    vocabulary = _vocabulary(df.sparkSession, path)

    @F.pandas_udf("binary")
    def ids(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = codec(vocabulary.value, pattern)
        for part in parts:
            yield pd.Series(list(own.encode_all(part)), dtype=object)

    return df.withColumn(into, ids(F.make_valid_utf8(text_of(text))))


def decode(df: DataFrame, path: str, pattern: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """Add the text of packed token ids."""
    vocabulary = _vocabulary(df.sparkSession, path)

    @F.pandas_udf("string")
    def texts(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = codec(vocabulary.value, pattern)
        for part in parts:
            yield part.map(own.decode)

    return df.withColumn(into, texts(F.coalesce(F.col(ids), F.lit(b""))))
