"""Quality classifier: perplexity under interpolated modified Kneser-Ney n-grams.

The model is an n-gram model per language over UTF-8 bytes, so no script's characters are
merged; perplexity is per character. It is trained on trusted text (in
the queries: documents labelled good and not toxic). Training is count joins in
DataFrames, sharded by (language, n-gram): raw counts at the highest order,
continuation counts (distinct left neighbours) below, three discounts per
language and order from the counts of counts, context sums, and one join per
order that interpolates with the order below.

All trusted texts are counted, each whole and once for its id and language. Only they, and a small share of
the others, are shuffled: a bitmap of the trusted ids' hashes is broadcast first. Tasks count n-grams in
bounded blocks and Spark sums them, so no text and no list of documents passes through the driver. The model
holds one number for each distinct n-gram and context (at most 2^32 of each language, as symbols are bytes;
in written text far fewer), and each task joins the n-grams of
its documents to the model's sorted shards (one per language and order) without
a shuffle. Whole texts are scored;
``prior_chars`` characters at the language's usual rate steady the perplexity of
short ones. ``docs_per_lang`` and ``windows`` give, if asked for, a model of a bounded sample; no query does.

A document's threshold is its language's: the ``quantile`` of the perplexity of
all trusted documents in that language, times
``slack``. Documents above it are rejected. Languages without trusted text, and
null languages, use the model and threshold pooled over all trusted text.

Defined results: an empty or null text has no perplexity and is rejected; without
any trusted text nothing is rejected and perplexities are null; repeated rows are
scored alike. A row without an id is scored like any other but is never trusted; of rows
that repeat an id and language one text (the least) is learned from.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postflow.llm import common as C

ORDER = 4
WINDOW = 1000
POOL = ""            # the pooled model's language
BLOCK = 1 << 22      # n-grams that a task counts at once
START = 0            # the symbol before a text's start
NUL = 0xC0           # stands for the byte 0; no UTF-8 text holds it


def symbols(text: str) -> np.ndarray:
    """The text's UTF-8 bytes, none of them ``START``."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    return np.where(raw == START, np.uint8(NUL), raw)


@dataclass
class KneserNey:
    grams: dict                                     # (lang, n) -> (sorted codes, log10-free probabilities)
    backoff: dict                                   # (lang, n) -> (sorted contexts, weights)

    def symbols(self, text: str) -> np.ndarray:
        return symbols(text)

    def languages(self) -> set:
        return {lang for lang, _ in self.grams}

    def log_probs(self, lang: str, sym: np.ndarray) -> np.ndarray:
        """Natural log probability of each symbol given those before it."""
        s = sym.astype(np.uint32)
        code = s.copy()
        codes = [code]
        for n in range(1, ORDER):
            shifted = np.zeros_like(s)
            shifted[n:] = s[:-n] << np.uint32(8 * n)
            code = code | shifted
            codes.append(code)
        p = np.zeros(len(s))
        weight = np.ones(len(s))
        todo = np.arange(len(s))
        for n in range(ORDER, 0, -1):
            keys, probs = self.grams[lang, n]
            want = codes[n - 1][todo]
            at = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
            hit = keys[at] == want
            rows = todo[hit]
            p[rows] = weight[rows] * probs[at[hit]]
            todo = todo[~hit]
            if not len(todo):
                break
            ctx, gammas = self.backoff[lang, n]
            want = want[~hit] >> np.uint32(8)
            at = np.minimum(np.searchsorted(ctx, want), len(ctx) - 1)
            weight[todo] *= np.where(ctx[at] == want, gammas[at], 1.0)
        p[todo] = weight[todo] / 256.0                   # below the lowest order: uniform
        return np.log(p)


def _texts(docs: DataFrame, trusted: DataFrame | None) -> DataFrame:
    """(lang, part): every trusted text, whole; of an id's repeats in a language one, as they must not outweigh the rest."""
    rows = docs.where("length(text) > 0 AND doc_id IS NOT NULL")
    if trusted is not None:                                # no semi-join: Spark would push it below the look-up of ``C.narrowed``
        rows = rows.join(trusted.select("doc_id").distinct(), "doc_id")
    once = rows.groupBy("doc_id", "lang").agg(F.min("text").alias("part"))
    return once.select(F.coalesce("lang", F.lit(POOL)).alias("lang"), "part")


def _sample(docs: DataFrame, trusted: DataFrame | None, docs_per_lang: int, windows: int) -> DataFrame:
    """(lang, part) rows of a bounded sample: ``docs_per_lang`` documents of smallest id hash, ``windows`` evenly spaced
    windows of each."""
    ids = docs.where("length(text) > 0").select("doc_id", "lang")      # ids alone meet the labels, texts are not shuffled
    if trusted is not None:
        ids = ids.join(trusted, "doc_id", "left_semi")
    chosen = C.sampled_ids(ids, docs_per_lang, seed=19)                # bounded: languages x docs_per_lang

    def cut(batches):
        for b in batches:
            langs, parts = [], []
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                starts = range(0, max(1, len(text)), WINDOW)
                for i in sorted({int(k) for k in np.linspace(0, len(starts) - 1, windows)}):
                    langs.append(lang)
                    parts.append(text[starts[i]:starts[i] + WINDOW])
            yield pa.RecordBatch.from_pydict({"lang": pa.array(langs, pa.string()), "part": pa.array(parts, pa.string())})

    return _texts(docs.join(F.broadcast(chosen), "doc_id", "left_semi"), None).mapInArrow(cut, "lang string, part string")


def _raw_counts(parts: DataFrame) -> DataFrame:
    """(lang, g, c): how often each n-gram of the highest order stands in a language's parts, and in all (``POOL``)."""
    def count(batches):
        C.drop_caches()
        held, size = {}, 0

        def counted():
            for lang, codes in held.items():
                g, c = np.unique(np.concatenate(codes), return_counts=True)
                yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(g), pa.string()),
                                                  "g": pa.array(g.astype(np.int64)), "c": pa.array(c.astype(np.int64))})

        for b in batches:
            for lang, part in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                raw = np.concatenate([np.full(ORDER - 1, START, np.uint8), symbols(part)])
                for a in range(0, len(raw) - ORDER + 1, BLOCK):
                    s = raw[a:a + BLOCK + ORDER - 1].astype(np.uint32)
                    code = np.zeros(len(s) - ORDER + 1, np.uint32)
                    for j in range(ORDER):
                        code = (code << np.uint32(8)) | s[j:len(s) - ORDER + 1 + j]
                    held.setdefault(lang, []).append(code)
                    size += len(code)
                    if size >= BLOCK:
                        yield from counted()
                        held, size = {}, 0
        yield from counted()

    own = C.checkpointed(parts.mapInArrow(count, "lang string, g long, c long").groupBy("lang", "g").agg(F.sum("c").alias("c")))
    pool = own.groupBy("g").agg(F.sum("c").alias("c")).select(F.lit(POOL).alias("lang"), "g", "c")
    return own.where(F.col("lang") != POOL).unionByName(pool)


def train(docs: DataFrame, trusted: DataFrame | None = None, docs_per_lang: int | None = None, windows: int = 4) -> KneserNey | None:
    """Model of the documents (doc_id, text, lang) named by ``trusted`` (doc_id), by default
    of all; None if there is no text."""
    parts = _texts(docs, trusted) if docs_per_lang is None else _sample(docs, trusted, docs_per_lang, windows)
    counts = {ORDER: C.checkpointed(_raw_counts(parts))}
    if counts[ORDER].isEmpty():
        return None
    for n in range(ORDER - 1, 0, -1):                    # continuation counts: distinct left neighbours
        longer = counts[n + 1].select("lang", F.col("g").bitwiseAND((1 << 8 * n) - 1).alias("g"))
        counts[n] = C.checkpointed(longer.groupBy("lang", "g").agg(F.count("*").alias("c")))
    grams, backoff, below = {}, {}, None
    for n in range(1, ORDER + 1):
        g = counts[n].withColumn("ctx", F.shiftright("g", 8))
        of = [F.sum(F.when(F.col("c") == i, 1).otherwise(0)).alias(f"n{i}") for i in range(1, 5)]
        y = F.col("n1") / F.nullif(F.col("n1") + 2 * F.col("n2"), F.lit(0))
        rate = [F.least(F.lit(float(i)), F.greatest(F.lit(0.1), F.coalesce(       # a discount stays within its count
            i - (i + 1) * y * F.col(f"n{i + 1}") / F.nullif(F.col(f"n{i}"), F.lit(0)), F.lit(0.5 * i)))).alias(f"d{i}") for i in (1, 2, 3)]
        discounts = g.groupBy("lang").agg(*of).select("lang", *rate)
        g = g.join(F.broadcast(discounts), "lang")                    # three numbers per language
        g = g.withColumn("d", F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d3")))
        ctx = g.groupBy("lang", "ctx").agg(F.sum("c").alias("total"), F.sum("d").alias("cut")).withColumn("gamma", F.col("cut") / F.col("total"))
        p = g.join(ctx, ["lang", "ctx"]).withColumn("own", (F.col("c") - F.col("d")) / F.col("total"))
        if below is None:
            p = p.withColumn("lower", F.lit(1 / 256.0))
        else:
            low = below.select("lang", F.col("g").alias("rest"), F.col("p").alias("lower"))
            p = p.withColumn("rest", F.col("g").bitwiseAND((1 << 8 * (n - 1)) - 1)).join(low, ["lang", "rest"])
        below = C.checkpointed(p.select("lang", "g", (F.col("own") + F.col("gamma") * F.col("lower")).alias("p")))
        _shards(grams, n, below, "g", "p")
        _shards(backoff, n, ctx, "ctx", "gamma")
    return KneserNey(grams, backoff)


def _shards(into: dict, n: int, df: DataFrame, key: str, value: str) -> None:
    """Sorted arrays per language; their size is bounded by the distinct n-grams."""
    t = df.select("lang", key, value).toArrow().to_pandas()
    for lang, part in t.groupby("lang"):
        part = part.sort_values(key)
        into[lang, n] = part[key].to_numpy().astype(np.uint32), part[value].to_numpy().astype(np.float64)


def perplexities(model: KneserNey, texts: list[str | None], langs: list[str | None], block: int = 1 << 19) -> list[float | None]:
    """Per-character perplexity of whole texts, in blocks of about ``block`` bytes."""
    out: list[float | None] = [None] * len(texts)
    known = model.languages()
    pad = np.full(ORDER - 1, START, np.uint8)
    by: dict = {}

    def flush(lang):
        rows, parts, _ = by.pop(lang)
        sym = np.concatenate([x for p in parts for x in (pad, p)])
        lp = model.log_probs(lang, sym)
        at = 0
        for i, p in zip(rows, parts):
            at += len(pad)
            total[i] = total.get(i, 0.0) + float(lp[at:at + len(p)].sum())
            at += len(p)

    total: dict[int, float] = {}
    for i, (text, lang) in enumerate(zip(texts, langs)):
        if not text:
            continue
        name = lang if lang in known else POOL
        s = symbols(text)
        if len(s) > 4 * block:                            # a very long text alone, in overlapping pieces
            total[i] = 0.0
            for a in range(0, len(s), block):
                lead = s[max(0, a - ORDER + 1):a] if a else pad
                total[i] += float(model.log_probs(name, np.concatenate([lead, s[a:a + block]]))[len(lead):].sum())
            continue
        held = by.setdefault(name, [[], [], 0])
        held[0].append(i)
        held[1].append(s)
        held[2] += len(s)
        if held[2] >= block:
            flush(name)
    for lang in list(by):
        flush(lang)
    for i, t in total.items():
        out[i] = float(np.exp(-t / len(texts[i])))
    return out


def score(docs: DataFrame, model: KneserNey, out_col: str = "perplexity", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``docs`` with the perplexity of each whole text; all columns stay."""
    shared = docs.sparkSession.sparkContext.broadcast(model)       # distinct n-grams, no text

    def make():
        C.drop_caches()
        return lambda texts, langs: [perplexities(shared.value, texts.to_pylist(), langs.to_pylist())]
    return C.map_columns(docs, [text_col, lang_col], {out_col: T.DoubleType()}, make)


def classify(docs: DataFrame, trusted_ids: DataFrame, quantile: float = 0.99, slack: float = 1.25,
             prior_chars: int = 64, docs_per_lang: int | None = None,
             windows: int = 4, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             ppl_out: str = "perplexity", limit_out: str = "threshold", kept_out: str = "kept") -> DataFrame:
    """``docs`` with perplexity, threshold and decision; all columns and rows stay.

    ``trusted_ids`` (doc_id) names the trusted documents.
    """
    text = F.coalesce(F.length(C.col(text_col)), F.lit(0)) > 0
    texts = C.pick(docs, doc_id=id_col, text=text_col, lang=lang_col)
    trusted = trusted_ids.select(F.col("doc_id")).distinct()
    near = C.narrowed(texts, trusted)                              # the joins with the trusted ids move no other texts
    model = train(near, trusted, docs_per_lang, windows)
    if model is None:
        return docs.withColumns({ppl_out: F.lit(None).cast("double"), limit_out: F.lit(None).cast("double"), kept_out: text})
    measured = score(near, model, "ppl").where("ppl IS NOT NULL").select("doc_id", "lang", "ppl", F.length("text").alias("n"))
    seen = C.checkpointed(measured.join(trusted, "doc_id", "left_semi"))
    usual = _per_language(seen, F.exp(F.sum(F.col("n") * F.log("ppl")) / F.sum("n")))
    steady = seen.withColumn("ppl", _shrunk(F.col("ppl"), F.col("n"), F.col("lang"), usual, prior_chars))
    limits = _per_language(steady, F.percentile_approx("ppl", F.lit(quantile), F.lit(10000)) * slack)
    scored = score(docs, model, ppl_out, text_col, lang_col)
    ppl = _shrunk(F.col(ppl_out), F.length(C.col(text_col)), C.col(lang_col), usual, prior_chars)
    return (scored.withColumn(ppl_out, ppl).withColumn(limit_out, _pick(C.col(lang_col), limits))
                  .withColumn(kept_out, text & F.coalesce(F.col(ppl_out) <= F.col(limit_out), F.lit(False))))


def _per_language(rows: DataFrame, value) -> dict:
    """One number per language, and the pooled one: a few rows on the driver."""
    by = rows.where("lang IS NOT NULL").groupBy("lang").agg(value.alias("v")).collect()
    return {POOL: rows.agg(value.alias("v")).first().v} | {r.lang: r.v for r in by}


def _pick(lang, values: dict):
    table = F.create_map(*[F.lit(x) for k, v in values.items() for x in (k, float(v))])
    return F.coalesce(table[F.coalesce(lang, F.lit(POOL))], F.lit(float(values[POOL])))


def _shrunk(ppl, n, lang, usual: dict, prior_chars: int):
    """Perplexity with ``prior_chars`` more characters at the language's usual rate: a
    few characters are little evidence, so short texts are not rejected for one odd word."""
    return F.exp((n * F.log(ppl) + prior_chars * F.log(_pick(lang, usual))) / (n + prior_chars))
