"""Whole-text encoding with the ``tokenizers`` library, cached by word.

Both public BPE files cut a text before every single space that stands between
two non-space characters, and what follows such a cut does not depend on what
stands before it. So a text's ids are the concatenation of the ids of its
space-led words, and each word is encoded once per cache life. Texts with other
spacing (runs of white space, leading or trailing blanks) go to the library whole.

For the ``spaced`` file a new word of Latin letters with trailing punctuation, or
several such words joined by line breaks, is cut as the file's own rules cut it
(``PLAIN``), and the library's model encodes the pieces; any other word goes
through the whole library. Files whose rules are not among the known two have no
such short cut.

The ``lower`` file drops white space and letter case and never keeps a letter and
the punctuation or digit beside it in one piece. So its texts are put in lower case and
cut there too, many at once in numpy, before words are looked up: "The", "the," and
"the.\nThe" need one cached word and the marks. White space of any kind may stand anywhere.

The cache is bounded: two generations, the older one dropped when the younger is full.
"""

from __future__ import annotations

import gc
import json
import os
import re
import struct

import numpy as np

from postflow.llm import common as C

MAX_WORDS = 150_000     # entries of each of two generations, about 65 MB together
MAX_HEADS = 30_000      # entries for words without a space before them
MAX_CACHED = 100        # characters of a cached word
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"          # composed, and in lower case one by one
MARKS = r"!-&(-/:-@\[-`{-~"          # ASCII punctuation but the apostrophe, which both files treat apart
PLAIN = re.compile(f"[{LETTERS}]+[{MARKS}]*(?:\n[{LETTERS}]+[{MARKS}]*)*")
PIECE = re.compile(f"[{LETTERS}]+|[{MARKS}]+|\n")
WHOLE = re.compile(f"[{LETTERS}]+|[{MARKS}]+|[0-9]")       # what the ``lower`` rule leaves in one piece
ASCII_MARKS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c != "'")
PACK = [struct.Struct(f"<{n}I").pack for n in range(32)]
RUN_BYTES = 1 << 20      # texts cut at once by the ``lower`` rule
LETTER, MARK, APOSTROPHE, DIGIT, FAR = 1, 2, 3, 4, 5       # FAR: not ASCII and not among LETTERS
KIND = bytes(LETTER if c.isalpha() else DIGIT if c.isdigit() else MARK if c in ASCII_MARKS else APOSTROPHE if c == "'" else 0
             for c in map(chr, range(128))) + bytes([FAR]) * 128
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
CUTS = {(LETTER, MARK), (LETTER, APOSTROPHE), (MARK, LETTER)} | {
    pair for k in (LETTER, MARK, APOSTROPHE, DIGIT) for pair in ((k, DIGIT), (DIGIT, k))}
CUT = bytes((at >> 3, at & 7) in CUTS for at in range(256))          # by 8 * kind before + kind after
KEEP = bytes((at >> 3, at & 7) == (LETTER, FAR) for at in range(256))
_ENCODERS: dict[str, "WordCachedEncoder"] = {}
C.WORKER_CACHES.append(_ENCODERS)


class OddSpacing(Exception):
    """The word is empty or has white space at an end: the text is not cut at single spaces."""


class _Words(dict):
    """Ids (little-endian unsigned 32-bit) of " " + word, or of a UTF-8 word of the ``lower`` rule, made when first asked for."""

    def __init__(self, make, old: dict[str | bytes, bytes]):
        super().__init__()
        self.make, self.old = make, old

    def __missing__(self, word: str | bytes) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            ids = self.make(word)
        if len(word) <= MAX_CACHED:
            self[word] = ids
        return ids


def byte_characters() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the others,
    in ascending order, for the characters from 256 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


def lower_cut(raws: list[bytes]) -> list[bytes]:
    """UTF-8 texts in lower case (letters of ``LETTERS``) with a space wherever the ``lower`` rule cuts between two
    characters of ``LETTERS``, ASCII punctuation and ASCII digits. Other characters stay with their neighbours: they
    may be letters, or combine with the letter before them, which keeps its case, as the file's rules compose first."""
    raw = b"\n".join(raws)                                # no text touches the next one
    b, kind = (np.frombuffer(bytearray(raw.translate(t)), np.uint8) for t in (LOWER, KIND))
    two = np.flatnonzero(b == 0xC3)                       # the first byte of U+00C0 to U+00FF
    two = two[(b[two + 1] & 0xDF) != 0x97]                # not the signs of multiplication and division
    kind[two] = kind[two + 1] = LETTER
    b[two[b[two + 1] < 0x9F] + 1] += 0x20
    beside = (kind[:-1] * 8 + kind[1:]).tobytes()
    at, keep = (np.flatnonzero(np.frombuffer(beside.translate(t), np.uint8)) for t in (CUT, KEEP))
    at += 1
    b[keep] = np.frombuffer(raw, np.uint8)[keep]
    ends = np.cumsum([len(r) + 1 for r in raws])
    ends = [0, *(ends + np.searchsorted(at, ends)).tolist()]
    flat = np.insert(b, at, 32).tobytes()
    return [flat[i:j] for i, j in zip(ends, ends[1:])]


class WordCachedEncoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        self.lib.encode_special_tokens = True    # their strings in a text are ordinary text
        self.model = self.lib.model
        self.vocab_size = self.lib.get_vocab_size()
        self.max_words = MAX_WORDS
        self.rule = self._rule(path)
        self.alphabet = byte_characters()
        self.space = self.alphabet[ord(" ")]
        self.make = self._lower_word if self.rule == "lower" else self._word
        self.words = _Words(self.make, {})
        self.heads: dict[str, bytes] = {}        # ids of words without a space before them

    @staticmethod
    def _rule(path: str) -> str | None:
        """How the file cuts words: ``spaced`` (pieces keep the space before them), ``lower``
        (white space goes, letters in lower case) or None for any other rule."""
        with open(path, encoding="utf-8") as f:
            rules = json.load(f)
        norm, pre, model = rules["normalizer"], rules["pre_tokenizer"], rules["model"]
        if model["type"] != "BPE" or model.get("dropout"):
            return None
        if norm is None and pre["type"] == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"]:
            return "spaced"
        steps = [s["type"] for s in (norm or {}).get("normalizers", [])]
        cuts = pre.get("pretokenizers", [])
        if steps == ["NFC", "Replace", "Lowercase"] and [c["type"] for c in cuts] == ["Split", "ByteLevel"]:
            head, *rest = cuts[0]["pattern"].get("Regex", "").partition(r"|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
            space = norm["normalizers"][1]
            if re.fullmatch(r"'[a-z]+(\|'[a-z]+)*", head) and rest[0] and not rest[1] and cuts[0]["invert"] \
                    and cuts[0]["behavior"] == "Removed" and (space["pattern"], space["content"]) == ({"Regex": r"\s+"}, " "):
                return "lower"
        return None

    def ids(self, text: str) -> np.ndarray:
        return np.array(self.lib.encode(text, add_special_tokens=False).ids, dtype="<u4")

    def trim(self) -> None:
        """Drop the older generation between tasks; the worker may run other operators next."""
        self.words.old = {}

    def _piece(self, piece: str) -> bytes:
        """Ids of a piece that the file's rules leave whole."""
        if not piece.isascii() or piece[0] in " \n":
            piece = piece.encode().decode("latin-1").translate(self.alphabet)
        return self._model_ids(piece)

    def _model_ids(self, piece: str) -> bytes:
        ids = [t.id for t in self.model.tokenize(piece)]
        return PACK[len(ids)](*ids) if len(ids) < len(PACK) else np.array(ids, "<u4").tobytes()

    def _head(self, piece: str) -> bytes:
        return self._cached_head(piece, self._piece)

    def _cached_head(self, key: str, make) -> bytes:
        got = self.heads.get(key)
        if got is None:
            got = make(key)
            if len(self.heads) >= MAX_HEADS:
                self.heads = {}
            if len(key) <= MAX_CACHED:
                self.heads[key] = got
        return got

    def _word(self, word: str) -> bytes:
        """Ids of " " + word."""
        if self.rule is not None and word.isascii():           # the most frequent forms, without a pattern
            if word.isalpha():
                return self._model_ids(self.space + word)
            stem = word.rstrip(ASCII_MARKS)
            if stem.isalpha():
                return self.words[stem] + self._head(word[len(stem):])
        if not word or word[0].isspace() or word[-1].isspace():
            raise OddSpacing
        if self.rule is None or not PLAIN.fullmatch(word):
            return self.ids(" " + word).tobytes()
        pieces = PIECE.findall(word)
        if len(pieces) == 1:
            return self._piece(" " + word)
        return self.words[pieces[0]] + b"".join(map(self._head, pieces[1:]))

    def _lower_word(self, word: bytes) -> bytes:
        """Ids of a word of ``lower_cut``."""
        text = word.decode()
        if word.isalpha():                                    # ASCII letters
            return self._model_ids(text)
        return self._piece(text) if WHOLE.fullmatch(text) else self.ids(text).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        collects = gc.isenabled()
        gc.disable()                                          # no cycles are made here, and the caches would be walked over and over
        try:
            return self._lower_texts(texts) if self.rule == "lower" else [self._text(t) for t in texts]
        finally:
            if collects:
                gc.enable()

    def _bound(self) -> None:
        if len(self.words) > self.max_words:                  # the full generation becomes the old one
            self.words.old = {}
            self.words = _Words(self.make, self.words)

    def _lower_texts(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        held: list[bytes] = []
        size = 0
        for i, raw in enumerate(map(str.encode, texts), 1):
            held.append(raw)
            size += len(raw)
            if size >= RUN_BYTES or i == len(texts):
                for t in lower_cut(held):
                    self._bound()
                    out.append(b"".join(map(self.words.__getitem__, t.split())))
                held, size = [], 0
        return out

    def _text(self, t: str) -> bytes:
        self._bound()
        head, *rest = t.split(" ")
        try:
            if not head or head[0].isspace() or head[-1].isspace():
                raise OddSpacing
            first = self._cached_head("\0" + head, lambda key: self.ids(key[1:]).tobytes())
            return first + b"".join(map(self.words.__getitem__, rest))
        except OddSpacing:
            return self.ids(t).tobytes() if t else b""


def encoder(path: str, max_words: int | None = None) -> WordCachedEncoder:
    """The encoder of this Python worker; workers are reused, and so is its cache. ``max_words`` (``MAX_WORDS``
    by default) bounds each of the cache's two generations."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordCachedEncoder(path)
    _ENCODERS[path].max_words = max_words or MAX_WORDS
    return _ENCODERS[path]
