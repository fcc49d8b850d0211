"""Byte-level BPE, packing and token files against the public libraries."""

import glob
import hashlib
import random
import re
import tempfile
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer

from postflow.llm import bpe, packing, queries, token_files, tokenizing
from postflow.llm.tokenizing import WordCachedEncoder
from tests.llm.conftest import ROWS

RANKS = bpe.load_ranks(P.path("byte_bpe_50k.tiktoken"))
ENC = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def library(name):
    t = Tokenizer.from_file(P.path(name))
    t.encode_special_tokens = True
    return t


def test_tree_bpe_equals_library_on_random_text(monkeypatch):
    monkeypatch.setattr(bpe, "LEAF_CHARS", 64)
    monkeypatch.setattr(bpe, "LEAF_BYTES", 8)
    codec, rnd = bpe.TreeBPE(RANKS, P.PATTERN), random.Random(1)
    parts = ["a", "b", "é", "  ", "\n", " ", "'s", "'re", "1", "23", ".", "!!", "the", " of", "日本", "x" * 40, "ab" * 30, "\t", "'", "ll", " \n"]
    for _ in range(1500):
        t = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 120)))
        assert codec.encode(t) == ENC.encode_ordinary(t), repr(t)
        assert codec.decode(codec.encode(t)) == t.encode()


@pytest.mark.parametrize("text", ["a" * 20000, "ab1" * 5000, " " * 9000, "é" * 5000, "x y  z\n" * 3000, "<|endoftext|> x"])
def test_tree_bpe_long_matches(text):
    codec = bpe.TreeBPE(RANKS, P.PATTERN)
    assert codec.encode(text) == ENC.encode_ordinary(text)
    assert codec.decode(codec.encode(text)) == text.encode()


def test_bpe_caches_are_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "MAX_WORDS", 50)
    codec, rnd = bpe.TreeBPE(RANKS, P.PATTERN), random.Random(2)
    for _ in range(200):
        t = " ".join("".join(rnd.choice("abcdef") for _ in range(5)) for _ in range(70))
        assert codec.encode(t) == ENC.encode_ordinary(t)
    assert len(codec.matches) <= 50


def test_encode_and_decode_frames(docs, no_docs):
    ids = bpe.encode_texts(docs, P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    out = bpe.decode_ids(ids, P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    got = out.select("text", "ids", "decoded", "kept").collect()
    assert len(got) == len(ROWS)
    for r in got:
        assert list(r.ids) == ENC.encode_ordinary(r.text or "")
        assert bytes(r.decoded) == (r.text or "").encode() and r.kept == "x"
    assert bpe.encode_texts(no_docs, P.path("byte_bpe_50k.tiktoken"), P.PATTERN).count() == 0


def test_tree_caches_stay_small(monkeypatch):
    """A word's match is kept once, long words not at all, and no more words than two generations hold."""
    codec = bpe.TreeBPE(RANKS, P.PATTERN)
    texts = ["a cat, a cat. a (cat) cat", "x " + "日本語" * 400 + " y", "x !!\n!! y\nz 's it's 12ab"]
    assert [codec.encode(t) for t in texts] == [ENC.encode_ordinary(t) for t in texts]
    assert "cat" in codec.words and " cat" not in codec.matches
    assert max(map(len, [*codec.words, *codec.matches])) <= bpe.LEAF_BYTES
    monkeypatch.setattr(bpe, "MAX_WORDS", 50)
    monkeypatch.setattr(bpe, "MAX_MATCHES", 20)
    for i in range(300):
        t = f"a{chr(97 + i % 26)}{chr(97 + i // 26)}, b{i}. 'tis"
        assert codec.encode(t) == ENC.encode_ordinary(t)
        assert len(codec.words) < 60 and len(codec.words.old) < 60 and len(codec.matches) <= 20


def test_byte_bpe_query(spark, docs, workdir):
    """The digests, with two Python workers a core at most: what each holds adds up beside the heap."""
    docs.write.parquet(f"{workdir}/bpe/documents.parquet")
    made = queries.op7_byte_bpe(spark, f"{workdir}/bpe")
    got = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in made.collect()}
    sha = lambda raw: hashlib.sha256(raw).hexdigest()
    want = {(i, len(ids), sha(" ".join(map(str, ids)).encode()), sha((t or "").encode()))
            for i, t, _ in ROWS for ids in [ENC.encode_ordinary(t or "")]}
    assert got == want and made.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert len(re.findall("MapInArrow", made._jdf.queryExecution().executedPlan().toString())) == 2


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_cached_encoder_equals_library(name):
    enc, lib = WordCachedEncoder(P.path(name)), library(name)
    texts = [r[1] or "" for r in ROWS] + [" a", "a ", "a  b", "\n", "a \x01 b", "A É ö", "<|endoftext|> x y", "'s 's it's", "́a ́b", "a　 b", "a  b"]
    want = [lib.encode(t, add_special_tokens=False).ids for t in texts]
    for _ in range(2):                                    # cold and warm cache
        assert [np.frombuffer(x, "<u4").tolist() for x in enc.encode(texts)] == want


@pytest.mark.parametrize("name, rule", [("byte_bpe_50k.json", "spaced"), ("word_bpe_49k.json", "lower")])
def test_plain_words_equal_library(name, rule, monkeypatch):
    monkeypatch.setattr(tokenizing, "MAX_WORDS", 200)      # generations change hands in the run
    monkeypatch.setattr(tokenizing, "MAX_HEADS", 50)
    enc, lib, rnd = WordCachedEncoder(P.path(name)), library(name), random.Random(7)
    assert enc.rule == rule
    parts = ["a", "The", "É", "ñ", "ß", "Ünder", "ÿ", "×", "÷", "ª", "µ", ".", ",", "!!", "_", "'", "'s", "`", "~", "\n", "\n\n", "7", "日", "e\u0301", "İ", "x" * 120, "\u00a0", "<|endoftext|>"]
    texts = [" ".join("".join(rnd.choice(parts[:11] if rnd.random() < .7 else parts) for _ in range(rnd.randint(1, 5)))
                      for _ in range(rnd.randint(1, 12))) for _ in range(3000)]
    want = [lib.encode(t, add_special_tokens=False).ids for t in texts]
    for _ in range(2):
        assert [np.frombuffer(x, "<u4").tolist() for x in enc.encode(texts)] == want
    assert max(map(len, enc.words)) <= tokenizing.MAX_CACHED


def test_lower_rule_shares_words():
    enc, lib = WordCachedEncoder(P.path("word_bpe_49k.json")), library("word_bpe_49k.json")
    words, calls = ["alpha", "été", "gamma"], []
    forms = ["{}", "{},", "({})", "{}.\nNext", "{}\t{}", "{}'s", "2{}0", "[{}]:", "{}-{}"]
    texts = [f.replace("{}", g(w)) for w in words for f in forms for g in (str, str.upper, str.title)]
    tokenize, whole = enc._model_ids, enc.ids
    enc._model_ids = lambda piece: calls.append(piece) or tokenize(piece)
    enc.ids = lambda text: calls.append(text) or whole(text)
    got = [np.frombuffer(x, "<u4").tolist() for x in enc.encode(texts)]
    assert got == [lib.encode(t, add_special_tokens=False).ids for t in texts]
    assert len(calls) == len(set(calls)) == 3 + 1 + 1 + 2 + 7          # words, next, 's, 2 and 0, marks


def test_lower_rule_keeps_what_composes(monkeypatch):
    enc, lib = WordCachedEncoder(P.path("word_bpe_49k.json")), library("word_bpe_49k.json")
    texts = ["", "\0", "a\0b \0", "T\u0308'", "xT", "\u0308", "É", "\u0304É\u0304", "=\u0338<", "9'S'LL", "ÀÖ×Ø÷Þßÿ", "\u212aÅ", " \x0b\x1c\x85a\u00a0B",
             "A.\u0301B", "日本2019年.", "’s ‘Tis", "Σ ΑΣ İ", "²½x,", "  ", "a"]
    want = [lib.encode(t, add_special_tokens=False).ids for t in texts]
    for size in (1, 8, 1 << 20):                          # texts alone and side by side
        monkeypatch.setattr(tokenizing, "RUN_BYTES", size)
        assert [np.frombuffer(x, "<u4").tolist() for x in enc.encode(texts)] == want
    assert enc.encode([]) == [] and enc.encode(["", ""]) == [b"", b""]


def test_tournament_tree_is_first_fit():
    rnd = np.random.default_rng(3)
    sizes = np.sort(rnd.integers(1, 100, 300))[::-1]
    seq, off = packing.first_fit_decreasing(sizes, 100)
    room = []
    for s, b, o in zip(sizes.tolist(), seq.tolist(), off.tolist()):
        want = next((i for i, r in enumerate(room) if r >= s), len(room))
        if want == len(room):
            room.append(100)
        assert (b, o) == (want, 100 - room[want])
        room[want] -= s


def test_packing(docs, no_docs):
    lib = library("word_bpe_49k.json")
    out = packing.pack_documents(docs, P.path("word_bpe_49k.json"), end_id=1, group_docs=5, keep_ids=True).collect()
    by_id = {}
    for r in out:
        by_id.setdefault(r.doc_id, []).append(r)
    for doc_id, text, _ in ROWS:
        ids = np.array(lib.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        rows = sorted(by_id[doc_id], key=lambda r: r.start)
        assert all(r.doc_tokens == len(ids) for r in rows)
        assert all(zlib.crc32(ids[r.start:r.start + r.length].tobytes()) == r.ids_crc32 for r in rows)
        assert all(bytes(r.ids) == ids[r.start:r.start + r.length].tobytes() for r in rows)
        times = sum(x[0] == doc_id for x in ROWS)
        assert sum(r.length for r in rows) == times * len(ids)
    by_seq = {}
    for r in out:
        by_seq.setdefault(r.sequence_id, []).append(r)
    for rows in by_seq.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= packing.CAPACITY
    assert packing.pack_documents(no_docs, P.path("word_bpe_49k.json")).count() == 0


def test_token_files(spark, docs, no_docs):
    lib = library("byte_bpe_50k.json")
    out = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    manifest = token_files.write_token_files(docs, P.path("byte_bpe_50k.json"), "file://" + out, seq_len=64, file_tokens=500)
    got = token_files.read_documents(spark, "file://" + out, manifest).orderBy("start").collect()
    want = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0))
    at = 0
    assert [r.doc_id for r in got] == [w[0] for w in want]
    for r, w in zip(got, want):
        ids = np.array(lib.encode(w[1] or "", add_special_tokens=False).ids + [2], "<u4")
        assert (r.start, r.n_tokens, bytes(r.ids)) == (at, len(ids), ids.tobytes())
        at += len(ids)
    files = glob.glob(out + "/*.arrow")
    assert len(files) == manifest.count() > 2
    f = token_files.SequenceFile(max(files, key=lambda p: len(token_files.SequenceFile(p))))
    ids, mask = f[len(f) - 1]
    assert len(ids) == len(mask) == 64 and ids.dtype == np.uint16 and not ids.flags.owndata
    assert f.table.schema.field("ids").type == pa.list_(pa.uint16(), 64)
    none = token_files.write_token_files(no_docs, P.path("byte_bpe_50k.json"), "file://" + out + "/none")
    assert token_files.read_documents(spark, "file://" + out + "/none", none).count() == 0
