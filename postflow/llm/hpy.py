"""Language-model scoring with a hierarchical Pitman-Yor model.

Tokens are lower-cased words and one end token per document. Restaurants stand on
three levels: one for each word that comes before a training token (a document
starts after an end token), whose customers are the tokens that follow it; above
it the class of the word before (of its last two bytes, ``CONTEXTS`` classes); at
the top the unigram, whose base is uniform over the training vocabulary and one
unknown word. A new table seats a customer one level up. Context restaurants grow
with the text; contexts never seen fall back to their class.

Seatings are drawn in sweeps. In a sweep every dish of every restaurant
is seated anew, one customer after another (beyond some tens, in growing blocks
of 1/32 of those seated), given the totals of all restaurants after the sweep
before. Discounts come from the counts of counts, strengths are parameters. A
token's probability is the mean of the predictive probabilities of the sweeps
after the burn-in; a text's score is the sum of their log10.

Data flow: documents are stored once as chunks. A chunk sends the counts of its
distinct (word, word before) pairs, in one block per hash bucket of the words, so
a hot context is split over all buckets, and a dish's classes and unigram meet in
one. After a sweep each bucket sends its tables per context, summed, to the hash
bucket that owns the context, which answers with the totals; the order of the keys
is sent once. Only the totals of classes and unigram (a few numbers) pass the
driver. Buckets answer each chunk in the order of its pairs, and the chunk scores
its documents. What moves grows with the distinct pairs of chunks, not with
tokens, and no row stands for a hot word. A bucket holds a word's distinct
contexts, once each.

Words are keyed by a 64-bit hash. Defined results: null or empty texts hold the
end token alone; null ids are neither learned from nor held out; repeated rows
count each time; an empty table gives no rows.
"""

from __future__ import annotations

import uuid
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postflow.llm import common as C

CONTEXTS = 16
END = b" "                  # no word holds a space
MESSAGE = "kind byte, to int, frm int, blob binary"
ASK, REPLY, STATE, TOTALS = range(4)      # tables per context to its owner, totals back, a bucket's seating, sums of classes and unigram


def _pack(**arrays: np.ndarray) -> bytes:
    """Arrays as a short header and, of each, the first bytes of all its numbers, then the second ones and so on, by
    zstd where that is smaller. Unsigned 64-bit numbers (keys, sorted mostly) go as differences. There are as many
    messages as pairs of buckets, so what each costs beside its numbers counts."""
    heads, bodies = [], []
    for k, a in arrays.items():
        a = np.ascontiguousarray(a).ravel()
        if a.dtype == np.uint64:
            a = np.diff(a, prepend=np.uint64(0))
        raw = a.view(np.uint8).reshape(len(a), a.dtype.itemsize).T.tobytes()
        small = pa.compress(raw, codec="zstd", asbytes=True) if len(raw) > 32 else raw
        body = small if len(small) < len(raw) else raw
        heads.append(f"{k}:{a.dtype.str}:{len(a)}:{len(body)}")
        bodies.append(body)
    head = ",".join(heads).encode()
    return b"".join([len(head).to_bytes(2, "little"), head, *bodies])


def _unpack(blob) -> dict[str, np.ndarray]:
    blob = memoryview(blob)
    at = 2 + int.from_bytes(blob[:2], "little")
    out = {}
    for head in bytes(blob[2:at]).decode().split(","):
        k, kind, n, size = head.split(":")
        kind, n, body = np.dtype(kind), int(n), blob[at:at + int(size)]
        at += int(size)
        raw = body if len(body) == n * kind.itemsize else pa.decompress(pa.py_buffer(body), n * kind.itemsize, codec="zstd")
        a = np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(kind.itemsize, n).T).view(kind).reshape(n)
        out[k] = np.cumsum(a, dtype=np.uint64) if kind == np.uint64 else a
    return out


class ChunkTokens:
    """The tokens of a chunk and its distinct (word, word before) pairs, in bucket order."""

    def __init__(self, batch: pa.RecordBatch, folds: int, held: int, buckets: int):
        import xxhash

        ids = batch.column("doc_id").to_pylist()
        part = [None if i is None else zlib.crc32(str(i).encode()) % folds for i in ids]
        self.held_out = np.array([p == held for p in part], bool)
        learn = np.array([p is not None and p != held for p in part], bool)
        number: defaultdict = defaultdict()
        number.default_factory = number.__len__
        tokens, sizes = [], []
        for text in batch.column("text").to_pylist():
            words = (text or "").encode("utf-8", "surrogatepass").lower().split()      # ASCII case and white space only
            words.append(END)
            tokens.append(np.fromiter(map(number.__getitem__, words), np.int32, len(words)))
            sizes.append(len(words))
        token = np.concatenate(tokens) if tokens else np.empty(0, np.int32)
        self.sizes = np.array(sizes, np.int64)
        self.starts = np.r_[0, np.cumsum(self.sizes)[:-1]].astype(np.int64)
        self.doc = np.repeat(np.arange(len(ids)), self.sizes)
        words = list(number)
        key = np.array([xxhash.xxh64_intdigest(w) for w in words], np.uint64)
        order = np.lexsort((key, key % np.uint64(buckets)))                     # words by (bucket, key)
        rank = np.empty(len(words), np.int64)
        rank[order] = np.arange(len(words))
        self.key = key[order]
        self.klass = np.array([zlib.crc32(w[-2:]) % CONTEXTS for w in words], np.uint8)[order]
        before = np.empty(len(token), np.int64)
        before[1:] = rank[token[:-1]]
        before[self.starts] = rank[number[END]] if len(ids) else 0
        seen, self.pair = np.unique(rank[token] * max(1, len(words)) + before, return_inverse=True)     # ``pair`` of each token
        self.n_train = np.bincount(self.pair, weights=learn[self.doc], minlength=len(seen)).astype(np.int64)
        self.word, self.context = np.divmod(seen, max(1, len(words)))
        self.word_bucket = (self.key % np.uint64(buckets)).astype(np.int64)
        self.pair_bucket = self.word_bucket[self.word]


def seat(c: np.ndarray, strength: np.ndarray, discount: float, rng) -> np.ndarray:
    """Tables of each dish after its ``c`` customers sat down one by one.

    ``strength`` is (theta + discount x tables) x probability of the dish in the parent.
    """
    t = np.minimum(c, 1)
    n, active = 1, np.flatnonzero(c > 1)
    while len(active):
        step = max(1, n // 32)
        new = strength[active]
        p = new / (n - discount * t[active] + new)
        t[active] += rng.binomial(np.minimum(step, c[active] - n), np.clip(p, 0, 1))
        n += step
        active = active[c[active] > n]
    return t


class Bucket:
    """Seating of the dishes of one hash bucket."""

    def __init__(self, number: int, data: dict[str, np.ndarray], model: dict):
        self.number, self.data, self.model = number, data, model
        self.word, self.context = np.cumsum(data["word_step"]), data["context"].astype(np.int64)
        self.c = data["c"].astype(np.int64)
        self.n_words = int(self.word[-1]) + 1 if len(self.word) else 0
        self.count = np.bincount(self.word, weights=self.c, minlength=self.n_words).astype(np.int64)
        self.t = np.minimum(self.c, 1)
        self._parent()
        self.top_t = np.minimum(self.top_c, 1)

    def _parent(self) -> None:
        self.top_c = np.bincount(self.word, weights=self.t, minlength=self.n_words).astype(np.int64)

    def totals(self) -> np.ndarray:
        """Rows (customers, tables) of each context, then of the parent."""
        by = lambda x: np.bincount(self.context, weights=x, minlength=CONTEXTS)
        return np.stack([np.r_[by(self.c), self.top_c.sum()], np.r_[by(self.t), self.top_t.sum()]], axis=1).astype(np.int64)

    def top_prob(self, total: np.ndarray) -> np.ndarray:
        d, theta = self.model["d_top"], self.model["theta"]
        return (np.maximum(self.top_c - d * self.top_t, 0) + (theta + d * total[-1, 1]) * self.model["base"]) / (theta + total[-1, 0])

    def sweep(self, turn: int, total: np.ndarray) -> None:
        rng = np.random.default_rng([self.model["seed"], turn, self.number])
        d, theta = self.model["d"], self.model["theta"]
        self.t = seat(self.c, ((theta + d * total[:-1, 1])[self.context]) * self.top_prob(total)[self.word], d, rng)
        self._parent()
        d_top = self.model["d_top"]
        self.top_t = seat(self.top_c, np.full(self.n_words, (theta + d_top * total[-1, 1]) * self.model["base"]), d_top, rng)

    def predictive(self, total: np.ndarray) -> np.ndarray:
        """Probability of each pair's word in its context."""
        d, theta = self.model["d"], self.model["theta"]
        below = self.top_prob(total)[self.word]
        return (np.maximum(self.c - d * self.t, 0) + ((theta + d * total[:-1, 1])[self.context]) * below) / (theta + total[:-1, 0])[self.context]


class Seating:
    """Seating of the word contexts of one hash bucket, over a ``Bucket`` that has their classes."""

    def __init__(self, number: int, data: dict[str, np.ndarray], model: dict):
        self.number, self.data, self.model = number, data, model
        self.word, self.context = np.cumsum(data["word_step"]), data["context"].astype(np.int64)
        self.c = data["c"].astype(np.int64)
        up, self.up = np.unique(self.word * CONTEXTS + data["klass"][self.context], return_inverse=True)
        self.t = np.minimum(self.c, 1)
        self.classes = Bucket(number, {"word_step": _steps(up // CONTEXTS), "context": up % CONTEXTS, "c": self._above()}, model)
        self.count = np.bincount(self.word, weights=self.c, minlength=self.classes.n_words).astype(np.int64)

    def _above(self) -> np.ndarray:
        return np.bincount(self.up, weights=self.t).astype(np.int64)

    def per_context(self, x: np.ndarray) -> np.ndarray:
        return np.bincount(self.context, weights=x, minlength=len(self.data["klass"])).astype(np.int64)

    def _back(self, total: np.ndarray, tables: np.ndarray) -> np.ndarray:
        """Strength times the probability of each pair's word in the class of its context."""
        m = self.model
        return (m["theta"] + m["d_word"] * tables)[self.context] * self.classes.predictive(total)[self.up]

    def sweep(self, turn: int, total: np.ndarray, tables: np.ndarray) -> None:
        """``total``: classes and unigram, ``tables``: of each context, all after the sweep before."""
        rng = np.random.default_rng([self.model["seed"], turn, self.number, 1])
        self.t = seat(self.c, self._back(total, tables), self.model["d_word"], rng)
        self.classes.c = self._above()
        self.classes.sweep(turn, total)

    def predictive(self, total: np.ndarray, tables: np.ndarray, customers: np.ndarray) -> np.ndarray:
        """Probability of each pair's word after the word before."""
        m = self.model
        own = np.maximum(self.c - m["d_word"] * self.t, 0)
        return (own + self._back(total, tables)) / (m["theta"] + customers)[self.context]

    def state(self) -> dict[str, np.ndarray]:
        return {"t": self.t.astype(np.uint32), "class_t": self.classes.t.astype(np.uint32), "top_t": self.classes.top_t.astype(np.uint32)}

    def restore(self, state: dict[str, np.ndarray], turn: int) -> None:
        self.t, self.classes.t = state[f"t{turn}"].astype(np.int64), state[f"class_t{turn}"].astype(np.int64)
        self.classes.c = self._above()
        self.classes._parent()
        self.classes.top_t = state[f"top_t{turn}"].astype(np.int64)


class _Model:
    """Task code; holds only sizes."""

    def __init__(self, folds: int, held: int, buckets: int):
        self.folds, self.held, self.buckets = folds, held, buckets

    def tokens(self, blob) -> ChunkTokens:
        return ChunkTokens(C.unpack_batch(blob), self.folds, self.held, self.buckets)

    def count(self, batches):
        for rows in batches:
            for chunk, blob in zip(rows.column(0).to_pylist(), rows.column(1)):
                k = self.tokens(blob.as_buffer())
                out = {"bucket": [], "chunk_id": [], "blob": []}
                w_at = np.searchsorted(k.word_bucket, np.arange(self.buckets + 1))
                p_at = np.searchsorted(k.pair_bucket, np.arange(self.buckets + 1))
                for b in np.flatnonzero(np.diff(w_at)).tolist():
                    w, p = slice(w_at[b], w_at[b + 1]), slice(p_at[b], p_at[b + 1])
                    out["bucket"].append(b)
                    out["chunk_id"].append(chunk)
                    context, at = np.unique(k.context[p], return_inverse=True)
                    by_key = np.argsort(k.key[context])                      # sorted keys take fewer bytes
                    context, at = context[by_key], np.argsort(by_key)[at]
                    out["blob"].append(_pack(key=k.key[w], word_step=_steps(k.word[p] - w_at[b]), context=at.astype(np.uint32),
                                             context_key=k.key[context], klass=k.klass[context], n=k.n_train[p].astype(np.uint32)))
                yield pa.RecordBatch.from_pydict({"bucket": pa.array(out["bucket"], pa.int32()),
                                                  "chunk_id": pa.array(out["chunk_id"], pa.int64()), "blob": pa.array(out["blob"], pa.binary())})

    def merge(self, t):
        """One row per bucket: its pairs with their training counts, and which of them each chunk holds."""
        got = [_unpack(b.as_buffer()) for b in t.column("blob")]
        keys, word = np.unique(np.concatenate([g["key"] for g in got]), return_inverse=True)
        found, first, context = np.unique(np.concatenate([g["context_key"] for g in got]), return_index=True, return_inverse=True)
        order = np.lexsort((found, found % np.uint64(self.buckets)))            # contexts by (owner, key), as words in chunks
        rank = np.empty(len(found), np.int64)
        rank[order] = np.arange(len(found))
        context = rank[context]
        klass = np.concatenate([g["klass"] for g in got])[first][order]
        at, c_at, codes = 0, 0, []
        for g in got:
            mine = context[c_at:c_at + len(g["context_key"])][g["context"]]
            codes.append(word[at:at + len(g["key"])][np.cumsum(g["word_step"])].astype(np.int64) * len(found) + mine)
            at += len(g["key"])
            c_at += len(g["context_key"])
        pairs, pair = np.unique(np.concatenate(codes), return_inverse=True)
        c = np.bincount(pair, weights=np.concatenate([g["n"] for g in got]), minlength=len(pairs)).astype(np.uint32)
        sizes = np.array([len(x) for x in codes], np.int64)
        cuts = np.cumsum(sizes)[:-1]
        data = _pack(word_step=_steps(pairs // len(found)), context=(pairs % len(found)).astype(np.uint32), context_key=found[order], klass=klass,
                     c=c, sizes=sizes, chunk=t.column("chunk_id").to_numpy().astype(np.int64),
                     pair_step=np.concatenate([_steps(x) for x in np.split(pair, cuts)]))
        return pa.table({"bucket": t.column("bucket").slice(0, 1), "data": pa.array([data], pa.binary())})

    def _asks(self, b: Seating, **values: np.ndarray) -> list[tuple]:
        """A message to each owner of contexts of the bucket, with the owner's part of ``values``."""
        owner = (b.data["context_key"] % np.uint64(self.buckets)).astype(np.int64)
        at = np.searchsorted(owner, np.arange(self.buckets + 1))
        return [(ASK, o, b.number, _pack(**{k: v[at[o]:at[o + 1]] for k, v in values.items()})) for o in np.flatnonzero(np.diff(at)).tolist()]

    def open(self, batches):
        """Before any sweep: the contexts of each bucket with their customers and tables."""
        for rows in batches:
            for number, blob in zip(rows.column(0).to_pylist(), rows.column(1)):
                b = Seating(number, _unpack(blob.as_buffer()), {})
                sent = self._asks(b, key=b.data["context_key"], c=b.per_context(b.c), t=b.per_context(b.t).astype(np.uint32))
                yield _messages([*sent, (TOTALS, 0, number, _pack(
                    total=b.classes.totals(), size=np.array([b.c.sum(), (b.count > 0).sum()]),
                    once=np.array([(x == i).sum() for x in (b.c, b.classes.c, b.classes.top_c) for i in (1, 2)])))])

    def owner(self, t):
        """One row per owner: its contexts' customers and first tables, and which of them each bucket holds."""
        got = [_unpack(b.as_buffer()) for b in t.column("blob")]
        keys, at = np.unique(np.concatenate([g["key"] for g in got]), return_inverse=True)
        c, tables = (np.bincount(at, weights=np.concatenate([g[x] for g in got])).astype(np.int64) for x in "ct")
        data = _pack(frm=t.column("frm").to_numpy().astype(np.int64), sizes=np.array([len(g["key"]) for g in got]), at=at.astype(np.uint32), c=c, t=tables)
        return pa.table({"owner": t.column("to").slice(0, 1), "data": pa.array([data], pa.binary())})

    @staticmethod
    def _replies(number: int, d: dict[str, np.ndarray], **totals: np.ndarray) -> pa.RecordBatch:
        cuts = np.cumsum(d["sizes"])[:-1]
        return _messages([(REPLY, frm, number, _pack(**{k: v[at] for k, v in totals.items()}))
                          for frm, at in zip(d["frm"].tolist(), np.split(d["at"], cuts))])

    def first_replies(self, batches):
        for rows in batches:
            for number, blob in zip(rows.column(0).to_pylist(), rows.column(1)):
                d = _unpack(blob.as_buffer())
                yield self._replies(number, d, c=d["c"], t=d["t"].astype(np.uint32))

    def reply(self, mine, asked):
        d = _unpack(mine.column("data")[0].as_buffer())
        sent = {f: _unpack(b.as_buffer())["t"] for f, b in zip(asked.column("frm").to_pylist(), asked.column("blob"))}
        tables = np.bincount(d["at"], weights=np.concatenate([sent[f] for f in d["frm"].tolist()])).astype(np.uint32)
        return pa.Table.from_batches([self._replies(mine.column("owner")[0].as_py(), d, t=tables)])

    @staticmethod
    def _inbox(mine, inbox, model: dict, turn: int) -> tuple[Seating, dict]:
        """The bucket after ``turn`` sweeps, and what is known: its earlier states and the contexts' totals."""
        rows = sorted(zip(inbox.column("kind").to_pylist(), inbox.column("frm").to_pylist(), range(inbox.num_rows)))
        got = [(kind, _unpack(inbox.column("blob")[i].as_buffer())) for kind, _, i in rows]
        replies, known = [g for kind, g in got if kind == REPLY], {}
        for kind, g in got:
            if kind == STATE:
                known.update(g)
        known |= {("c" if k == "c" else f"T{turn}"): np.concatenate([g[k] for g in replies]) for k in replies[0]}
        b = Seating(mine.column("bucket")[0].as_py(), _unpack(mine.column("data")[0].as_buffer()), model)
        if turn:
            b.restore(known, turn)
        return b, known

    def sweep(self, model: dict, total: np.ndarray, turn: int, burn_in: int):
        """The task code of sweep ``turn``, given the totals after the one before."""
        return lambda mine, inbox: self.swept(mine, inbox, model, total, turn, burn_in)

    def swept(self, mine, inbox, model: dict, total: np.ndarray, turn: int, burn_in: int):
        b, known = self._inbox(mine, inbox, model, turn - 1)
        b.sweep(turn, total, known[f"T{turn - 1}"])
        if turn - 1 <= burn_in:                          # not needed for the mean
            known = {"c": known["c"]}
        known |= {f"{k}{turn}": v for k, v in b.state().items()}
        return pa.Table.from_batches([_messages([
            *self._asks(b, t=b.per_context(b.t).astype(np.uint32)), (STATE, b.number, b.number, _pack(**known)),
            (TOTALS, 0, b.number, _pack(total=b.classes.totals()))])])

    def answer(self, mine, inbox, model: dict, totals: list[np.ndarray], burn_in: int):
        """The log10 of the mean probability of each chunk's pairs."""
        sweeps = len(totals) - 1
        b, known = self._inbox(mine, inbox, model, sweeps)
        mean = np.zeros(len(b.c))
        for turn in range(burn_in + 1, sweeps + 1):
            b.restore(known, turn)
            mean += b.predictive(totals[turn], known[f"T{turn}"], known["c"])
        log_p = np.log10(mean / (sweeps - burn_in))
        d, at, out = b.data, 0, {"chunk_id": [], "bucket": [], "blob": []}
        for chunk, size in zip(d["chunk"].tolist(), d["sizes"].tolist()):
            pair = np.cumsum(d["pair_step"][at:at + size])
            at += size
            word = b.word[pair]
            new = np.r_[True, word[1:] != word[:-1]]
            out["chunk_id"].append(chunk)
            out["bucket"].append(b.number)
            out["blob"].append(_pack(log_p=log_p[pair].astype(np.float32), c=b.count[word[new]]))
        return pa.table(out, schema=pa.schema([("chunk_id", pa.int64()), ("bucket", pa.int32()), ("blob", pa.binary())]))

    def score(self, chunks, answers, model: dict):
        out = []
        for blob in chunks.column("docs").to_pylist():
            batch = C.unpack_batch(blob)
            k = ChunkTokens(batch, self.folds, self.held, self.buckets)
            log_p, c = np.zeros(len(k.word)), np.zeros(len(k.key), np.int64)
            w_at = np.searchsorted(k.word_bucket, np.arange(self.buckets + 1))
            p_at = np.searchsorted(k.pair_bucket, np.arange(self.buckets + 1))
            for b, answer in zip(answers.column("bucket").to_pylist(), answers.column("blob")):
                got = _unpack(answer.as_buffer())
                log_p[p_at[b]:p_at[b + 1]] = got["log_p"]
                c[w_at[b]:w_at[b + 1]] = got["c"]
            count = c[k.word[k.pair]]
            per_doc = lambda x: np.add.reduceat(x, k.starts) if len(k.starts) else np.empty(0)
            base = per_doc(np.log10(count + 1.0)) - k.sizes * np.log10(model["N"] + model["V"] + 1.0)
            out.append(pa.table({
                "doc_id": batch.column("doc_id"), "held_out": pa.array(k.held_out), "n_tokens": pa.array(k.sizes),
                "n_known": pa.array(per_doc((count > 0).astype(np.int64)).astype(np.int64)),
                "train_tokens": pa.array(np.full(len(k.sizes), model["N"], np.int64)),
                "base_score": pa.array(base), "score": pa.array(per_doc(log_p[k.pair]))}))
        return pa.concat_tables(out)


def _steps(ascending: np.ndarray) -> np.ndarray:
    """Differences of ascending numbers; they compress well, and cumsum restores them."""
    return np.diff(ascending, prepend=0).astype(np.uint32)


def _messages(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"kind": pa.int8(), "to": pa.int32(), "frm": pa.int32(), "blob": pa.binary()}
    return pa.RecordBatch.from_pydict({k: pa.array(v, t) for (k, t), v in zip(kinds.items(), zip(*rows))})


def _stored(rows: DataFrame, key: str) -> DataFrame:
    """``rows`` as a table bucketed by ``key``, so every sweep reads it without a shuffle."""
    spark, name = rows.sparkSession, f"postflow_hpy_{uuid.uuid4().hex[:16]}"
    (rows.write.format("parquet").option("path", C.shared_uri(spark, "hpy")).option("compression", "uncompressed")
         .bucketBy(min(C.shuffle_parts(spark), C.MAX_BUCKETS), key).saveAsTable(name))
    return spark.table(name)


def score_documents(docs: DataFrame, folds: int = 7, held: int = 2, sweeps: int = 4, burn_in: int = 2, theta: float = 1.0,
                    seed: int = 13, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from documents whose crc32 of the id as text leaves another remainder
    than ``held`` modulo ``folds``; scores all.
    """
    docs = C.pick(docs, doc_id=id_col, text=text_col)
    kind = docs.schema["doc_id"].dataType.simpleString()
    chunks = C.write_chunks(docs)
    work = _Model(folds, held, max(64, chunks.count()))
    blocks = chunks.mapInArrow(work.count, "bucket int, chunk_id long, blob binary")
    table = _stored(blocks.groupBy("bucket").applyInArrow(lambda t: work.merge(t), "bucket int, data binary"), "bucket")
    sent = C.checkpointed(table.mapInArrow(work.open, MESSAGE))
    owners = _stored(sent.where(F.col("kind") == ASK).groupBy("to").applyInArrow(lambda t: work.owner(t), "owner int, data binary"), "owner")

    def gather(name: str) -> np.ndarray:
        """Sums over the buckets: a few numbers."""
        def rows(batches):
            for rows in batches:
                for blob in rows.column(0):
                    x = _unpack(blob.as_buffer())[name]
                    yield pa.RecordBatch.from_pydict({"i": pa.array(range(len(x)), pa.int32()), "v": pa.array(x, pa.int64())})
        found = sent.where(F.col("kind") == TOTALS).select("blob").mapInArrow(rows, "i int, v long").groupBy("i").agg(F.sum("v").alias("v"))
        return np.array([r.v for r in sorted(found.collect())], np.int64)

    def now() -> np.ndarray:
        got = gather("total")
        return got.reshape(-1, 2).astype(np.float64) if len(got) else np.zeros((CONTEXTS + 1, 2))

    n, v = gather("size").tolist() or (0, 0)
    once = gather("once").tolist() or [0] * 6
    d_word, d, d_top = (float(np.clip(a / max(1, a + 2 * b), 0.05, 0.95)) for a, b in zip(once[::2], once[1::2]))
    model = {"N": n, "V": v, "base": 1.0 / (v + 1), "d_word": d_word, "d": d, "d_top": d_top, "theta": theta, "seed": seed}
    totals = [now()]
    inbox = owners.mapInArrow(work.first_replies, MESSAGE)
    by_bucket = lambda m: table.groupBy("bucket").cogroup(m.groupBy("to"))
    for turn in range(1, sweeps + 1):
        sent = C.checkpointed(by_bucket(inbox).applyInArrow(work.sweep(model, totals[-1], turn, burn_in), MESSAGE))
        totals.append(now())
        replies = (owners.groupBy("owner").cogroup(sent.where(F.col("kind") == ASK).groupBy("to"))
                         .applyInArrow(lambda o, m: work.reply(o, m), MESSAGE))
        inbox = replies.union(sent.where(F.col("kind") == STATE))
    answers = by_bucket(inbox).applyInArrow(lambda b, m: work.answer(b, m, model, totals, burn_in), "chunk_id long, bucket int, blob binary")
    schema = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return (chunks.groupBy("chunk_id").cogroup(answers.groupBy("chunk_id"))
                  .applyInArrow(lambda c, a: work.score(c, a, model), schema))
