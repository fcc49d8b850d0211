"""Byte-level BPE encoding and decoding by monoid tree reduction.

A text is halved recursively. A leaf is encoded directly; two neighbours are
joined by encoding a boundary window again and growing it until the tokens
outside are proved stable. Two rules prove it:

* **Between pattern matches.** The pattern reads at most ``LOOK`` characters
  past a match, and a match depends on nothing before its start. So in the left
  half every match that ends ``LOOK`` or more before the cut stands; in the
  right half everything after a shared match boundary stands. The window runs
  from the first unstable match on the left and grows on the right until one of
  its stable match ends is a match end of the right half as well.
* **Inside one match.** A sequence of BPE tokens is the encoding of its bytes
  exactly if every two neighbours are the encoding of their joined bytes. So the
  window of tokens around the cut grows until the pairs at both of its edges
  pass that test.

Decoding concatenates token bytes up the same tree. Both run per document in
tasks; texts move through no shuffle. Null texts encode to no tokens.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from postflow.llm import common as C

LEAF_CHARS = 4096      # text leaves of the tree
LEAF_BYTES = 64        # leaves inside one long match
LOOK = 3               # characters past a match's end that decide it
MAX_WORDS = 150_000    # words in the cache's younger generation; two generations take some 60 MB
MAX_MATCHES = 50_000   # matches kept besides: those without a space before them, and those of oddly spaced texts
_CODECS: dict[tuple[str, str], "TreeBPE"] = {}
C.WORKER_CACHES.append(_CODECS)


class _Words(dict):
    """Ids of " " + word, made when first asked for; long words are not kept, so a bound on entries bounds bytes."""

    def __init__(self, make, old: dict[str, bytes]):
        super().__init__()
        self.make, self.old = make, old

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            ids = self.make(word)
        if len(word) <= LEAF_BYTES:
            self[word] = ids
        return ids


class _OddSpacing(Exception):
    """The word is empty or has white space at an end: no boundary is proved before or after it."""


class TreeBPE:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.ranks = ranks
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.find = regex.compile(pattern)
        self.matches: dict[str, bytes] = {}     # ids of one match
        self.words = _Words(self._word, {})
        self.pairs: dict[tuple[int, int], bool] = {}

    # ---- inside one match
    def merge(self, raw: bytes) -> list[int]:
        """Direct encoding: merge the neighbouring parts of lowest rank until none is left."""
        ranks = self.ranks
        if raw in ranks:
            return [ranks[raw]]
        parts = [raw[i:i + 1] for i in range(len(raw))]
        scores = [ranks.get(a + b) for a, b in zip(parts, parts[1:])]
        while scores:
            best, at = None, -1
            for i, s in enumerate(scores):
                if s is not None and (best is None or s < best):
                    best, at = s, i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            del scores[at]
            if at < len(scores):
                scores[at] = ranks.get(parts[at] + parts[at + 1])
            if at:
                scores[at - 1] = ranks.get(parts[at - 1] + parts[at])
        return [ranks[p] for p in parts]

    def stands(self, a: int, b: int) -> bool:
        """Is (a, b) the encoding of its own bytes? Then no merge crosses the border."""
        key = (a, b)
        ok = self.pairs.get(key)
        if ok is None:
            if len(self.pairs) > MAX_WORDS:
                self.pairs.clear()
            ok = self.pairs[key] = self.merge(self.bytes_of[a] + self.bytes_of[b]) == [a, b]
        return ok

    def join_ids(self, left: list[int], right: list[int]) -> list[int]:
        """Encoding of the joined bytes from the encodings of both sides."""
        if not left or not right:
            return left + right
        i, j = len(left) - 1, 1                 # window: left[i:], right[:j]
        while True:
            mid = self.merge(b"".join(self.bytes_of[t] for t in left[i:] + right[:j]))
            ok_l = i == 0 or self.stands(left[i - 1], mid[0])
            ok_r = j == len(right) or self.stands(mid[-1], right[j])
            if ok_l and ok_r:
                return left[:i] + mid + right[j:]
            i = i if ok_l else max(0, i - max(1, len(left) - i))
            j = j if ok_r else min(len(right), 2 * j)

    def encode_bytes(self, raw: bytes) -> list[int]:
        if len(raw) <= LEAF_BYTES:
            return self.merge(raw)
        half = len(raw) // 2
        return self.join_ids(self.encode_bytes(raw[:half]), self.encode_bytes(raw[half:]))

    def encode_match(self, m: str) -> bytes:
        """Ids of one match of the pattern, as little-endian 32-bit integers."""
        ids = self.matches.get(m)
        if ids is None:
            ids = self._ids(m)
            if len(m) <= LEAF_BYTES:
                if len(self.matches) >= min(MAX_MATCHES, MAX_WORDS):
                    self.matches = {}
                self.matches[m] = ids
        return ids

    def _ids(self, m: str) -> bytes:
        return np.array(self.encode_bytes(m.encode("utf-8", "surrogatepass")), dtype="<i4").tobytes()

    # ---- over matches
    def ends(self, text: str, start: int, stop: int) -> list[int]:
        return [m.end() for m in self.find.finditer(text, start, stop)]

    def _spans(self, text: str, a: int, b: int) -> list[int]:
        """Ends of the pattern's matches in text[a:b], read as if it stood alone."""
        if b - a <= LEAF_CHARS:
            return self.ends(text, a, b)
        mid = (a + b) // 2
        left, right = self._spans(text, a, mid), self._spans(text, mid, b)
        keep = len(left)
        while keep and left[keep - 1] > mid - LOOK:
            keep -= 1
        start = left[keep - 1] if keep else a
        known, grow = set(right), 256
        while True:
            stop = min(b, mid + grow)
            window = self.ends(text, start, stop)
            for k, e in enumerate(window):
                if (e <= stop - LOOK or stop == b) and e in known:
                    return left[:keep] + window[:k + 1] + right[right.index(e) + 1:]
            if stop == b:                       # the window reached the end: it is the answer
                return left[:keep] + window
            grow *= 2

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text."""
        return np.frombuffer(self.encode_raw(text), dtype="<i4").tolist()

    def encode_raw(self, text: str) -> bytes:
        if len(text) <= LEAF_CHARS:
            return self._leaf(text)
        cut = len(text) // 2
        space = text.find(" ", cut, cut + LEAF_CHARS // 8)
        if space > 0 and self._proved(text, space):      # a boundary window of no tokens
            return self.encode_raw(text[:space]) + self.encode_raw(text[space:])
        out, at = [], 0
        for e in self._spans(text, 0, len(text)):
            out.append(self.encode_match(text[at:e]))
            at = e
        return b"".join(out)

    @staticmethod
    def _proved(text: str, i: int) -> bool:
        """A single space between two other characters: the matches left of it end
        there, and one starts there, whatever lies further away."""
        return i + 1 < len(text) and not text[i - 1].isspace() and not text[i + 1].isspace()

    def _leaf(self, text: str) -> bytes:
        """Direct encoding; words after proved boundaries are looked up in a cache."""
        head, *rest = text.split(" ")
        if any(not w or w[0].isspace() or w[-1].isspace() for w in (head, rest[-1] if rest else "x")):
            if not text.startswith(" ") or text.startswith("  ") or not rest or not rest[0] or rest[0][0].isspace() \
                    or rest[-1][-1:].isspace() or not rest[-1]:
                return self._matched(text)
            head = ""                                    # the text starts with one space: all words are space-led
        self._bound()
        try:
            body = b"".join(map(self.words.__getitem__, rest))
        except _OddSpacing:
            return self._matched(text)
        return (self._matched(head) if head else b"") + body

    def _bound(self) -> None:
        if len(self.words) >= MAX_WORDS:         # the full generation becomes the old one
            self.words.old = {}
            self.words = _Words(self._word, self.words)

    def _word(self, w: str) -> bytes:
        """Ids of " " + w. Where its first match, alone, is one match too, that is kept as a word, and only there."""
        if not w or w[0].isspace() or w[-1].isspace():
            raise _OddSpacing
        text = " " + w
        ends = self.ends(text, 0, len(text))
        if len(ends) == 1:
            return self._ids(text)
        e = ends[0]
        if e > 1 and not text[e - 1].isspace() and self.ends(text[:e], 0, e) == [e]:
            out, at = [self.words[text[1:e]]], e
        else:
            out, at = [], 0
        for e in ends[len(out):]:
            out.append(self.encode_match(text[at:e]))
            at = e
        return b"".join(out)

    def _matched(self, text: str) -> bytes:
        out, at = [], 0
        for e in self.ends(text, 0, len(text)):
            out.append(self.encode_match(text[at:e]))
            at = e
        return b"".join(out)

    def decode(self, ids: list[int]) -> bytes:
        if len(ids) <= LEAF_CHARS:
            return b"".join(map(self.bytes_of.__getitem__, ids))
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f) if a}


def codec(path: str, pattern: str) -> TreeBPE:
    """The codec of this Python worker (its caches live as long as the worker)."""
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = TreeBPE(load_ranks(path), pattern)
    return _CODECS[path, pattern]


def encode_texts(df: DataFrame, path: str, pattern: str, text_col: str = "text",
                 ids_col: str = "ids") -> DataFrame:
    """``df`` with ``ids_col`` (array<int>), the token ids of ``text_col`` (null: none)."""
    def make():
        enc = codec(path, pattern).encode_raw

        def work(texts):
            raw = [enc(t) for t in C.texts_of(texts)]
            at = np.concatenate([[0], np.cumsum([len(r) // 4 for r in raw], dtype=np.int64)]).astype("<i4")
            values = pa.array(np.frombuffer(b"".join(raw), dtype="<i4"), pa.int32())
            return [pa.ListArray.from_arrays(pa.array(at, pa.int32()), values)]
        return work
    return C.map_columns(df, [text_col], {ids_col: T.ArrayType(T.IntegerType(), False)}, make, rows=500)


def int_lists(column: pa.ListArray):
    """Python lists of an Arrow list column of integers; null reads as empty."""
    at, values = column.offsets.to_numpy(), column.values.to_numpy()
    for i in range(len(column)):
        yield values[at[i]:at[i + 1]].tolist()


def decode_ids(df: DataFrame, path: str, pattern: str, ids_col: str = "ids",
               out_col: str = "decoded") -> DataFrame:
    """``df`` with ``out_col`` (binary), the bytes of the tokens (null ids: no bytes)."""
    def make():
        dec = codec(path, pattern).decode
        return lambda ids: [pa.array([dec(i) for i in int_lists(ids)], pa.binary())]
    return C.map_columns(df, [ids_col], {out_col: T.BinaryType()}, make, rows=500)
