"""Language identification by a byte convolutional network.

Filters of several widths slide over the bytes of fixed-length windows; max
pooling over a window and a softmax layer give its language probabilities. A
document's probabilities are its windows' means, weighted by their bytes, over
its whole text.

Training is numpy on the driver over a bounded sample: per language the
``docs_per_lang`` labelled documents of smallest id hash, ``windows_per_doc``
windows of each, evenly spaced over the text. So at most languages x
docs_per_lang x windows_per_doc x WINDOW bytes reach the driver, whatever the
corpus. Prediction maps over all documents, without a shuffle.

The first layer is a table lookup (bytes are one-hot), and pairs of neighbouring
offsets are added up once into tables of 65,536 rows for prediction.

Defined results: ``und`` with score 0 for a null text, a text without a letter,
or when nothing was learned; repeated rows are predicted alike. Rows without an id are
predicted, never learned from and not held out; of rows that repeat an id and language one
text (the least) enters the sample.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postflow.llm import common as C

WINDOW = 256
WIDTHS = (2, 3, 4)
UNKNOWN = "und"


@dataclass
class ByteCNN:
    langs: list[str]
    filters: int = 12
    widths: tuple[int, ...] = WIDTHS
    seed: int = 5
    conv: dict = field(default_factory=dict)        # width -> [width, 256, filters]

    def __post_init__(self):
        rng = np.random.default_rng(self.seed)
        if not self.conv:
            self.conv = {w: rng.normal(0, 0.3, (w, 256, self.filters)).astype(np.float32) for w in self.widths}
        n = len(self.widths) * self.filters
        self.bias = np.zeros(n, np.float32)
        self.dense = rng.normal(0, 0.1, (n, len(self.langs))).astype(np.float32)
        self.out = np.zeros(len(self.langs), np.float32)
        self._pairs = None

    # ---- training
    def _pooled(self, x: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Max over positions of each filter, and where it stands."""
        feats, where = [], []
        for w in self.widths:
            n = x.shape[1] - w + 1
            z = self.conv[w][0][x[:, :n]]
            for j in range(1, w):
                z = z + self.conv[w][j][x[:, j:j + n]]
            at = z.argmax(axis=1)
            where.append(at)
            feats.append(np.take_along_axis(z, at[:, None, :], axis=1)[:, 0])
        return np.concatenate(feats, axis=1), where

    def train(self, x: np.ndarray, y: np.ndarray, epochs: int = 4, batch: int = 32, rate: float = 0.02) -> None:
        """Adam on the cross-entropy; gradients pass the maxima only."""
        rng = np.random.default_rng(self.seed)
        params = [*self.conv.values(), self.bias, self.dense, self.out]
        m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        step = 0
        for _ in range(epochs):
            for idx in np.array_split(rng.permutation(len(x)), max(1, len(x) // batch)):
                xb, yb = x[idx], y[idx]
                pooled, where = self._pooled(xb)
                h = np.maximum(pooled + self.bias, 0)
                p = _softmax(h @ self.dense + self.out)
                p[np.arange(len(yb)), yb] -= 1
                p /= len(yb)
                dh = (p @ self.dense.T) * (h > 0)
                grads = []
                for k, w in enumerate(self.widths):
                    part, g = dh[:, k * self.filters:(k + 1) * self.filters], np.zeros_like(self.conv[w])
                    rows, cols = np.arange(len(xb))[:, None], np.arange(self.filters)
                    for j in range(w):
                        np.add.at(g[j], (xb[rows, where[k] + j], cols), part)
                    grads.append(g)
                grads += [dh.sum(0), h.T @ p, p.sum(0)]
                step += 1
                for q, g, a, b in zip(params, grads, m, v):
                    a += 0.1 * (g - a)
                    b += 0.001 * (g * g - b)
                    q -= rate * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.999 ** step)) + 1e-8)

    # ---- prediction
    def _tables(self) -> dict:
        if self._pairs is None:
            self._pairs = {}
            for w in self.widths:
                c = self.conv[w]
                steps = [(j, (c[j][:, None] + c[j + 1][None]).reshape(65536, -1)) for j in range(0, w - 1, 2)]
                if w % 2:
                    steps.append((w - 1, c[w - 1]))
                self._pairs[w] = steps
        return self._pairs

    def window_probs(self, x: np.ndarray) -> np.ndarray:
        """Language probabilities of windows [n, WINDOW] of bytes."""
        pair = (x[:, :-1].astype(np.int32) << 8) | x[:, 1:]
        feats = []
        for w, steps in self._tables().items():
            n = x.shape[1] - w + 1
            z = None
            for j, tab in steps:
                part = tab[(pair if len(tab) > 256 else x)[:, j:j + n]]
                z = part if z is None else np.add(z, part, out=z)
            feats.append(z.max(axis=1))
        h = np.maximum(np.concatenate(feats, axis=1) + self.bias, 0)
        return _softmax(h @ self.dense + self.out)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def windows_of(raw: bytes) -> np.ndarray:
    """All windows of a text, the last one padded with zero bytes."""
    n = max(1, -(-len(raw) // WINDOW))
    flat = np.zeros(n * WINDOW, np.uint8)
    flat[:len(raw)] = np.frombuffer(raw, np.uint8)
    return flat.reshape(n, WINDOW)


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def learns(id_col: Column, folds: int = 4, held: int = 2) -> Column:
    """Rows to learn from: crc32 of the id as text leaves another remainder than ``held``."""
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(folds)) != held, F.lit(False))


def held_out(id_col: Column, folds: int = 4, held: int = 2) -> Column:
    """Rows of the fold that is never learned from; false for a null id (which is not learned from, either)."""
    return id_col.isNotNull() & ~learns(id_col, folds, held)


def train(docs: DataFrame, may_learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          docs_per_lang: int = 300, windows_per_doc: int = 3) -> ByteCNN | None:
    """A network learned from the bounded sample; None without any labelled text."""
    rows = docs.select(C.col(id_col).alias("doc_id"), C.col(text_col).alias("text"), C.col(lang_col).alias("lang"),
                       may_learn.alias("learn")).where("learn AND text IS NOT NULL AND lang IS NOT NULL")
    chosen = C.sampled_ids(rows, docs_per_lang, seed=11)               # bounded: languages x docs_per_lang

    def cut(batches):
        C.drop_caches()
        for b in batches:
            lang, part = [], []
            for text, name in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if has_letter(text):
                    w = windows_of(text.encode("utf-8", "surrogatepass"))
                    for i in sorted({int(k) for k in np.linspace(0, len(w) - 1, windows_per_doc)}):
                        lang.append(name)
                        part.append(w[i].tobytes())
            yield pa.RecordBatch.from_pydict({"lang": pa.array(lang, pa.string()), "window": pa.array(part, pa.binary())})

    picked = rows.join(F.broadcast(chosen), "doc_id", "left_semi")
    sample = (picked.groupBy("doc_id", "lang").agg(F.min("text").alias("text")).select("text", "lang")    # an id's repeats once
                    .mapInArrow(cut, "lang string, window binary").orderBy("lang", "window").collect())
    if not sample:
        return None
    langs = sorted({r.lang for r in sample})
    net = ByteCNN(langs)
    x = np.frombuffer(b"".join(bytes(r.window) for r in sample), np.uint8).reshape(len(sample), WINDOW)
    y = np.array([langs.index(r.lang) for r in sample])
    rng = np.random.default_rng(3)                     # short texts too: half of the windows once more, cut short
    short = x[::2].copy()
    short[np.arange(WINDOW) >= rng.integers(16, WINDOW, len(short))[:, None]] = 0
    net.train(np.concatenate([x, short]), np.concatenate([y, y[::2]]))
    return net


def predict_texts(net: ByteCNN | None, texts: list[str | None], batch: int = 512) -> tuple[list[str], list[float]]:
    """(language, score) of whole texts, their windows in batches."""
    lang, score = [UNKNOWN] * len(texts), [0.0] * len(texts)
    if net is None:
        return lang, score
    raw = [(i, t.encode("utf-8", "surrogatepass")) for i, t in enumerate(texts) if t and has_letter(t)]
    held, owner, size = [], [], []
    total = np.zeros((len(texts), len(net.langs)))

    def flush():
        if held:
            x = np.concatenate(held)
            for a in range(0, len(x), batch):
                p = net.window_probs(x[a:a + batch]) * np.concatenate(size)[a:a + batch, None]
                np.add.at(total, np.concatenate(owner)[a:a + batch], p)
            held.clear(), owner.clear(), size.clear()

    n = 0
    for i, r in raw:
        w = windows_of(r)
        held.append(w)
        owner.append(np.full(len(w), i))
        size.append(np.minimum(WINDOW, len(r) - WINDOW * np.arange(len(w))))
        n += len(w)
        if n >= 8 * batch:
            flush()
            n = 0
    flush()
    for i, _ in raw:
        p = total[i] / total[i].sum()
        lang[i], score[i] = net.langs[int(p.argmax())], float(p.max())
    return lang, score


def predict(docs: DataFrame, net: ByteCNN | None, text_col: str = "text", lang_out: str = "lang_pred",
            score_out: str = "score") -> DataFrame:
    """``docs`` with the predicted language and its probability; all columns stay."""
    shared = docs.sparkSession.sparkContext.broadcast(net)      # a few hundred KB by construction

    def make():
        C.drop_caches()
        return lambda texts: list(predict_texts(shared.value, texts.to_pylist()))
    return C.map_columns(docs, [text_col], {lang_out: T.StringType(), score_out: T.DoubleType()}, make)
