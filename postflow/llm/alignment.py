"""Cross-tokenizer alignment with inverted bitmaps of token-id pairs.

Two tokenizers cut the same bytes: a byte-level BPE (A, ids of " " + text) and a
sentence-piece BPE with byte fallback (B, which adds the space itself). Where a
token of A and a token of B end at the same byte, a group closes and its two
last tokens are linked. The question about a link is corpus-wide: how often are
its two ids linked, and is that the most for its id of B?

1. Chunks of some MB of text number their documents from 0 (at most 65,536, so a
   document is 16 bits). A chunk keeps an inverted index: for each pair of ids a
   compressed bitmap of documents for each bit of its multiplicity (plane p holds
   the documents in which bit p of the pair's number of links is set). A bitmap is
   an array of 16-bit numbers, or plain bits where that is shorter.
2. A pair's bitmap over the corpus is the union of its chunks' bitmaps, the chunk
   being the high part of the document number, so it never stands in one place.
   Its planes are OR-merged and popcounted chunk by chunk (documents), the planes'
   popcounts weighed by 2**p (links), and Spark adds both up by pair.
3. Only (pair, count, best) goes back to the chunks that hold the pair; the postings
   return the scores to their documents. Rows moved are the distinct pairs of
   each chunk, so they grow no faster than the text.

Words are aligned once per cache life: both tokenizers cut before every single
space between two other characters, and nothing crosses that cut.

Defined results: null and empty texts, and texts that either tokenizer does not
give back byte for byte (a literal U+2581), have no tokens: zeros and an empty
``groups``. Null ids and repeated rows are documents like any other; other
columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from itertools import accumulate, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postflow.llm import common as C

CHUNK_BYTES = 8 << 20
CHUNK_DOCS = 1 << 16
ROWS = 500                   # documents aligned at a time
B_BITS = 20                  # an id pair is a << B_BITS | b
MAX_WORDS = 250_000          # of each of two generations of cached words, some 350 bytes each
LINE_WORDS = 2000            # new words in one call of a library
LONG_WORD = 256              # longer words are aligned each time
CUT = re.compile(r"(?<=\S) (?=\S)")
SPACE_MARK = "▁"
UNSEEN = object()
_ALIGNERS: dict[tuple[str, str], "PairAligner"] = {}


def byte_alphabet() -> dict[str, int]:
    """Character -> byte of byte-level vocabularies: printable Latin-1 characters stand
    for themselves, the other bytes take the code points from 256 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class PairAligner:
    """Aligned words: (tokens of A, of B, groups, linked pairs as int64 bytes, groups text with a final ";"),
    or None for a word that a tokenizer does not give back."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True              # their strings are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        of = byte_alphabet()
        vocab = self.a.get_vocab(with_added_tokens=False)
        self.a_bytes = {i: bytes(of.get(c, 0) for c in t) for t, i in vocab.items()}
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE_MARK, " ").encode()
                        for i, p in enumerate(map(self.b.id_to_piece, range(self.b.vocab_size())))]
        self.a_size = np.array([len(self.a_bytes.get(i, b"")) for i in range(max(self.a_bytes) + 1)], np.int64)
        self.b_size = np.array([len(x) for x in self.b_bytes], np.int64)
        self.texts = pa.array([f"{i}{end}" for n, last in ((len(self.a_size), "|"), (len(self.b_size), ";"))
                               for i in range(n) for end in (",", last)])
        self.words: dict[str, tuple | None] = {}
        self.old: dict[str, tuple | None] = {}

    def align_word(self, word: str) -> tuple | None:
        """The alignment of one word; None if a tokenizer does not give it back."""
        raw = (" " + word).encode()
        a, b = self.a.encode(" " + word, add_special_tokens=False).ids, self.b.encode(word)
        left, right = list(map(self.a_bytes.__getitem__, a)), list(map(self.b_bytes.__getitem__, b))
        if b"".join(left) != raw or b"".join(right) != raw:
            return None
        ends_a, ends_b = list(accumulate(map(len, left))), list(accumulate(map(len, right)))
        both = set(ends_a).intersection(ends_b)
        groups = zip(*("".join([f"{i};" if e in both else f"{i}," for i, e in zip(ids, ends)])[:-1].split(";")
                       for ids, ends in ((a, ends_a), (b, ends_b))))
        last = zip(*([i for i, e in zip(ids, ends) if e in both] for ids, ends in ((a, ends_a), (b, ends_b))))
        pairs = b"".join([(x << B_BITS | y).to_bytes(8, "little") for x, y in last])
        return len(a), len(b), len(both), pairs, "".join([f"{x}|{y};" for x, y in groups])

    def align_line(self, words: list[str]) -> list[tuple] | None:
        """Alignments of words that neither start nor end with white space, from one call of each library
        over all of them with single spaces between; None if one of the words is not given back."""
        line = " ".join(words)
        raw = (" " + line).encode()
        a = np.array(self.a.encode(" " + line, add_special_tokens=False).ids, np.int64)
        b = np.array(self.b.encode(line), np.int64)
        if any(b"".join(map(of.__getitem__, ids.tolist())) != raw for of, ids in ((self.a_bytes, a), (self.b_bytes, b))):
            return None
        ends_a, ends_b = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        word_ends = np.cumsum([len(w.encode()) + 1 for w in words])
        both = np.intersect1d(ends_a, ends_b, assume_unique=True)
        if not np.isin(word_ends, both).all():
            return None
        at_a, at_b = np.searchsorted(ends_a, both), np.searchsorted(ends_b, both)
        pairs = (a[at_a] << B_BITS | b[at_b]).astype("<i8").tobytes()
        n_a, n_b, n = (np.diff(np.searchsorted(e, word_ends, "right"), prepend=0) for e in (ends_a, ends_b, both))
        code_a, code_b = 2 * a, 2 * (b + len(self.a_size))             # odd: last token of its group
        code_a[at_a] += 1
        code_b[at_b] += 1
        order = np.argsort(np.concatenate([2 * np.searchsorted(both, ends_a), 2 * np.searchsorted(both, ends_b) + 1]), kind="stable")
        strings = self.texts.take(pa.array(np.concatenate([code_a, code_b])[order]))
        offsets = pa.array(np.concatenate([[0], np.cumsum(n_a + n_b)]), pa.int32())
        text = pc.binary_join(pa.ListArray.from_arrays(offsets, strings), "").to_pylist()
        stop = (8 * np.cumsum(n)).tolist()
        return [(x, y, g, pairs[e - 8 * g:e], t) for x, y, g, e, t in zip(n_a.tolist(), n_b.tolist(), n.tolist(), stop, text)]

    def learn(self, new: list[str]) -> list[tuple | None]:
        out: list[tuple | None] = [None] * len(new)
        plain = [i for i, w in enumerate(new) if w and not w[0].isspace() and not w[-1].isspace() and SPACE_MARK not in w]
        for k in range(0, len(plain), LINE_WORDS):
            at = plain[k:k + LINE_WORDS]
            words = [new[i] for i in at]
            for i, x in zip(at, self.align_line(words) or map(self.align_word, words)):
                out[i] = x
        for i in set(range(len(new))).difference(plain):
            out[i] = self.align_word(new[i])
        return out

    def look_up(self, words: list[str]) -> list[tuple | None]:
        """The alignments of distinct ``words``."""
        if len(self.words) > MAX_WORDS:
            self.words, self.old = {}, self.words
        out = list(map(self.words.get, words, repeat(UNSEEN)))
        missing = [i for i, x in enumerate(out) if x is UNSEEN]
        new = []
        for i in missing:
            out[i] = self.old.get(words[i], UNSEEN)
            if out[i] is UNSEEN:
                new.append(i)
        for i, x in zip(new, self.learn([words[i] for i in new])):
            out[i] = x
        self.words.update((words[i], out[i]) for i in missing if len(words[i]) <= LONG_WORD)
        return out

    def trim(self) -> None:
        """Keep one generation between tasks; the worker may run other operators next."""
        self.old = {}


def aligner(a_path: str, b_path: str) -> PairAligner:
    """The aligner of this Python worker; workers are reused, and so is its cache."""
    if (a_path, b_path) not in _ALIGNERS:
        _ALIGNERS[a_path, b_path] = PairAligner(a_path, b_path)
    return _ALIGNERS[a_path, b_path]


def cut_words(texts: pa.Array) -> tuple[pa.ListArray, pa.DictionaryArray]:
    """Each text cut at every single space between two characters that are no white space, and all words encoded."""
    lists = pc.split_pattern(texts, " ")
    kinds = lists.values.dictionary_encode()
    edge = np.array([not w or w[0].isspace() or w[-1].isspace() for w in kinds.dictionary.to_pylist()], bool)
    if not edge.any():
        return lists, kinds
    odd = np.zeros(len(texts), bool)
    odd[pc.list_parent_indices(lists).to_numpy()[edge[kinds.indices.to_numpy()]]] = True
    at = np.flatnonzero(odd)
    own = pa.array([CUT.split(t) for t in texts.take(pa.array(at)).to_pylist()], lists.type)
    order = np.arange(len(texts))
    order[at] = len(texts) + np.arange(len(at))
    lists = pa.concat_arrays([lists, own]).take(pa.array(order))
    return lists, lists.flatten().dictionary_encode()


class Aligned:
    """Alignment of some texts: numbers of each, and the links as (pair, text number)."""

    def __init__(self, tool: PairAligner, texts: pa.Array):
        n = len(texts)
        lists, kinds = cut_words(pc.fill_null(texts, ""))
        doc = pc.list_parent_indices(lists).to_numpy().astype(np.int64)
        found = tool.look_up(kinds.dictionary.to_pylist())
        none = (0, 0, 0, b"", "")
        bad = np.array([x is None for x in found], bool)
        found = [x or none for x in found]
        word = kinds.indices.to_numpy().astype(np.int64)
        dead = np.zeros(n, bool)
        dead[doc[bad[word]]] = True
        dead |= pc.equal(pc.fill_null(pc.binary_length(texts), 0), 0).to_numpy(zero_copy_only=False)
        live = ~dead[doc]
        *sizes, pairs, strings = zip(*found) if found else ((),) * 5
        size = np.array(sizes, np.int64).reshape(3, -1).T
        sums = np.zeros((n, 3), np.int64)
        np.add.at(sums, doc[live], size[word[live]])
        self.n_a, self.n_b, self.n_groups = sums.T
        links = np.frombuffer(b"".join(pairs), "<i8")
        first, count = (np.cumsum(size[:, 2]) - size[:, 2])[word[live]], size[word[live], 2]
        at = np.repeat(first - (np.cumsum(count) - count), count) + np.arange(count.sum())
        self.pair, self.doc = links[at], np.repeat(doc[live], count)
        groups = pa.ListArray.from_arrays(lists.offsets, pa.array(strings, pa.string()).take(kinds.indices))
        self.groups = pc.if_else(pa.array(dead), "", pc.replace_substring_regex(pc.binary_join(groups, ""), ";$", ""))


class PairIndex:
    """Inverted index of one chunk: for every plane, the pairs and their document bitmaps."""

    def __init__(self, n_docs: int, planes: list[tuple[np.ndarray, np.ndarray, bytes]]):
        self.n_docs, self.planes = n_docs, planes

    @classmethod
    def of_links(cls, pair: np.ndarray, doc: np.ndarray, n_docs: int) -> "PairIndex":
        key, times = np.unique(pair << 16 | doc, return_counts=True)
        planes = []
        for p in range(int(times.max(initial=0)).bit_length()):
            planes.append(cls._bitmaps(key[(times >> p & 1).astype(bool)], n_docs))
        return cls(n_docs, planes)

    @staticmethod
    def _bitmaps(key: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray, bytes]:
        """(pairs, documents of each, the bitmaps one after another) of sorted pair << 16 | document."""
        pairs, first, size = np.unique(key >> 16, return_index=True, return_counts=True)
        docs = (key & 0xFFFF).astype("<u2")
        width = -(-n_docs // 8)
        dense = 2 * size > width
        if not dense.any():
            return pairs, size, docs.tobytes()
        out, done = [], 0
        for i in np.flatnonzero(dense).tolist():
            bits = np.zeros(width * 8, np.uint8)
            bits[docs[first[i]:first[i] + size[i]]] = 1
            out += [docs[done:first[i]].tobytes(), np.packbits(bits).tobytes()]
            done = first[i] + size[i]
        return pairs, size, b"".join([*out, docs[done:].tobytes()])

    def postings(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(plane, pair of each posting, document of each posting), opened from the bitmaps."""
        width = -(-self.n_docs // 8)
        for p, (pairs, size, blob) in enumerate(self.planes):
            dense = 2 * size > width
            raw = np.frombuffer(blob, np.uint8)
            ends = np.cumsum(np.where(dense, width, 2 * size))
            docs, done = [], 0
            for i in np.flatnonzero(dense).tolist():
                a = int(ends[i]) - width
                docs += [raw[done:a].view("<u2"), np.flatnonzero(np.unpackbits(raw[a:a + width]))]
                done = a + width
            docs.append(raw[done:].view("<u2"))
            yield p, np.repeat(pairs, size), np.concatenate(docs).astype(np.int64)

    def counts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pairs, documents, links): planes OR-merged and popcounted, and popcounts by weight."""
        if not self.planes:
            return (np.zeros(0, np.int64),) * 3
        pairs = np.unique(np.concatenate([x[0] for x in self.planes]))
        documents, links = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), np.int64)
        seen = [pair << 16 | doc for _, pair, doc in self.postings()]
        merged = seen[0] if len(seen) == 1 else np.unique(np.concatenate(seen))
        own, n = np.unique(merged >> 16, return_counts=True)
        documents[np.searchsorted(pairs, own)] = n
        for p, (held, size, _) in enumerate(self.planes):
            links[np.searchsorted(pairs, held)] += size << p
        return pairs, documents, links

    def scores(self, pairs: np.ndarray, links: np.ndarray, best: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(links whose pair is best, sum of the links' counts) of each document, the sorted ``pairs`` being scored."""
        n_best, total = np.zeros(self.n_docs, np.int64), np.zeros(self.n_docs, np.int64)
        for p, pair, doc in self.postings():
            at = np.searchsorted(pairs, pair)
            np.add.at(total, doc, links[at] << p)
            np.add.at(n_best, doc, best[at].astype(np.int64) << p)
        return n_best, total

    def pack(self) -> bytes:
        return C.pack_batch(pa.RecordBatch.from_pydict({
            "n": pa.array([self.n_docs] * len(self.planes), pa.int64()),
            "pairs": pa.array([x[0].astype("<i8").tobytes() for x in self.planes], pa.binary()),
            "size": pa.array([x[1].astype("<i4").tobytes() for x in self.planes], pa.binary()),
            "bits": pa.array([x[2] for x in self.planes], pa.binary())}))

    @classmethod
    def unpack(cls, blob: bytes, n_docs: int) -> "PairIndex":
        rows = C.unpack_batch(blob).to_pylist()
        return cls(n_docs, [(np.frombuffer(r["pairs"], "<i8"), np.frombuffer(r["size"], "<i4").astype(np.int64), r["bits"]) for r in rows])


def index_chunks(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text",
                 keep_groups: bool = False, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Aligned documents as rows (chunk_id, n, docs, index), written once below the shared folder."""
    docs = C.pick(docs, doc_id=id_col, text=text_col)
    spark = docs.sparkSession
    C.small_batches(spark)
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"] + ["groups"] * keep_groups

    def run(batches):
        tool, part, seq = aligner(a_path, b_path), TaskContext.get().partitionId(), 0
        rows: list[pa.RecordBatch] = []
        pairs: list[np.ndarray] = []
        owner: list[np.ndarray] = []
        n = size = 0

        def emit():
            nonlocal rows, pairs, owner, n, size, seq
            held = pa.Table.from_batches(rows).combine_chunks().to_batches()[0]
            index = PairIndex.of_links(np.concatenate(pairs), np.concatenate(owner), n)
            out = pa.RecordBatch.from_pydict({
                "chunk_id": pa.array([part << 32 | seq], pa.int64()), "n": pa.array([n], pa.int64()),
                "docs": pa.array([C.pack_batch(held)], pa.binary()), "index": pa.array([index.pack()], pa.binary())})
            rows, pairs, owner, n, size, seq = [], [], [], 0, 0, seq + 1
            return out

        for whole in batches:
            for i in range(0, whole.num_rows, ROWS):
                b = whole.slice(i, ROWS)
                if n and (size + b.nbytes > chunk_bytes or n + b.num_rows > CHUNK_DOCS):
                    yield emit()
                found = Aligned(tool, b.column(1))
                digest = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in found.groups.to_pylist()]
                made = [found.n_a, found.n_b, found.n_groups, found.n_groups]
                rows.append(pa.RecordBatch.from_arrays([
                    b.column(0), *(pa.array(x, pa.int64()) for x in made), pa.array(digest, pa.string()),
                    *[found.groups] * keep_groups], names=names))
                pairs.append(found.pair)
                owner.append(found.doc + n)
                n += b.num_rows
                size += b.nbytes
        if n:
            yield emit()
        tool.trim()

    out = C.shared_uri(spark, "aligned")
    docs.mapInArrow(run, "chunk_id long, n long, docs binary, index binary").write.option("compression", "uncompressed").parquet(out)
    return spark.read.parquet(out)


def chunk_counts(chunks: DataFrame) -> DataFrame:
    """(chunk_id, pair, documents, links): the popcounts of each chunk's bitmaps."""
    def run(batches):
        for whole in batches:
            for chunk, n, blob in zip(*(whole.column(i).to_pylist() for i in range(3))):
                pairs, documents, links = PairIndex.unpack(blob, n).counts()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(pairs), chunk), pa.int64()), *(pa.array(x, pa.int64()) for x in (pairs, documents, links))],
                    names=["chunk_id", "pair", "documents", "links"])

    return chunks.select("chunk_id", "n", "index").mapInArrow(run, "chunk_id long, pair long, documents long, links long")


def pair_counts(counts: DataFrame) -> DataFrame:
    """(pair, a, b, documents, links, best) over the corpus; ``best``: no pair of the same b has more links."""
    b = F.col("pair").bitwiseAND(F.lit((1 << B_BITS) - 1))
    total = counts.groupBy("pair").agg(F.sum("documents").alias("documents"), F.sum("links").alias("links"))
    most = F.max("links").over(Window.partitionBy("b"))
    return (total.withColumn("b", b).withColumn("best", F.col("links") == most)
                 .select("pair", F.shiftright("pair", B_BITS).alias("a"), "b", "documents", "links", "best"))


def align_documents(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text",
                    keep_groups: bool = False, chunk_bytes: int = CHUNK_BYTES) -> tuple[DataFrame, DataFrame]:
    """(documents, pairs): one row per document with n_a, n_b, n_groups, n_links, groups_sha256
    (and ``groups``, the text, when ``keep_groups``), n_best and count_sum; one row per linked pair of ids."""
    chunks = index_chunks(docs, a_path, b_path, id_col, text_col, keep_groups, chunk_bytes)
    counts = chunk_counts(chunks).repartition("pair")         # totals and the way back read this one exchange
    pairs = pair_counts(counts)
    back = counts.select("chunk_id", "pair").join(pairs.select("pair", "links", "best"), "pair")
    kind = docs.schema[id_col].dataType.simpleString()

    def score(key, held, found):
        pair = found.column("pair").to_numpy()
        order = np.argsort(pair)
        links, best = (found.column(c).to_numpy()[order] for c in ("links", "best"))
        out = []
        for n, docs_blob, index_blob in zip(*(held.column(c).to_pylist() for c in ("n", "docs", "index"))):
            n_best, total = PairIndex.unpack(index_blob, n).scores(pair[order], links, best)
            rows = pa.Table.from_batches([C.unpack_batch(docs_blob)])
            out.append(rows.append_column("n_best", pa.array(n_best, pa.int64())).append_column("count_sum", pa.array(total, pa.int64())))
        return pa.concat_tables(out) if out else empty

    fields = [("n_a", "long"), ("n_b", "long"), ("n_groups", "long"), ("n_links", "long"), ("groups_sha256", "string"),
              *[("groups", "string")] * keep_groups, ("n_best", "long"), ("count_sum", "long")]
    arrow = {"long": pa.int64(), "string": pa.string()}
    from pyspark.sql.pandas.types import to_arrow_type

    empty = pa.schema([("doc_id", to_arrow_type(docs.schema[id_col].dataType)), *((n, arrow[t]) for n, t in fields)]).empty_table()
    scored = (chunks.select("chunk_id", "n", "docs", "index").groupBy("chunk_id")
                    .cogroup(back.groupBy("chunk_id"))
                    .applyInArrow(score, f"doc_id {kind}, " + ", ".join(f"{n} {t}" for n, t in fields)))
    return scored, pairs
