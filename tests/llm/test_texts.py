"""SimHash, passage dedup, language ID, quality and LM scoring against brute force or held-out rows."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import xxhash
from pyspark.sql import functions as F

from postflow.llm import hpy, langid, quality, simhash, suffix_dedup
from postflow.llm.components import connected_components
from tests.llm.conftest import ROWS

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SF = "/root/testdata/sf0.001"


def plain_components(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def plain_fingerprint(text):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_components_against_union_find(spark):
    rnd = random.Random(5)
    links = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(220)] + [(400, 400), (7, 8), (8, 7)] + [(i, i + 1) for i in range(500, 560)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = plain_components(600, links)
    assert got == {x: want[x] for pair in links for x in pair if pair[0] != pair[1]} and len(got) > 100


@pytest.mark.parametrize("bits", [0, 1, 3, 5])
def test_multi_index_finds_every_link(spark, bits):
    rnd = random.Random(bits)
    fps = [rnd.getrandbits(64) for _ in range(40)]
    for f in list(fps):
        for _ in range(4):
            for b in rnd.sample(range(64), rnd.randint(0, 6)):
                f ^= 1 << b
            fps.append(f)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    sig = spark.createDataFrame(list(enumerate(signed)), "doc_id long, fp long")
    got = {r.fp: r.component_id for r in simhash.components(sig, bits).collect()}
    links = [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= bits]
    assert [got[s] for s in signed] == plain_components(len(fps), links)


def test_hot_buckets_are_cut_and_lose_no_link(spark, monkeypatch):
    rnd = random.Random(21)
    high = rnd.getrandbits(32) << 32                      # all share the upper segment
    fps = sorted({high | rnd.getrandbits(32) for _ in range(60)})
    fps += sorted({f ^ sum(1 << b for b in rnd.sample(range(64), 3)) for f in fps} - set(fps))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    sig = spark.createDataFrame(list(enumerate(signed)), "doc_id long, fp long")
    links = [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 3]
    monkeypatch.setattr(simhash, "HOT_ROWS", 10)
    assert simhash.hot_buckets(sig.select("fp"), 3)
    got = {r.fp: r.component_id for r in simhash.components(sig, 3).collect()}
    assert [got[s] for s in signed] == plain_components(len(fps), links) and len(links) >= 60


def test_simhash_documents(docs, no_docs):
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(ROWS)
    fp = [plain_fingerprint(r[1]) for r in ROWS]
    links = [(i, j) for i in range(len(ROWS)) for j in range(i) if (fp[i] ^ fp[j]).bit_count() <= 3]
    comp = plain_components(len(ROWS), links)
    want = []
    for i, r in enumerate(ROWS):
        ids = [ROWS[j][0] for j in range(len(ROWS)) if comp[j] == comp[i] and ROWS[j][0] is not None]
        want.append((r[0], fp[i], min(ids, default=None)))
    assert collections.Counter((r.doc_id, r.fingerprint % (1 << 64), r.component_id) for r in got) == collections.Counter(want)
    assert simhash.near_duplicates(no_docs).count() == 0
    kept = simhash.keep_representatives(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted({w[2] for w in want if w[2] is not None}) and ids.count(None) <= 1
    assert simhash.keep_representatives(no_docs).count() == 0


def plain_cut(rows):
    least = {}
    for doc, text in rows:
        for i in range(len(text) - 49):
            least[text[i:i + 50]] = min(doc, least.get(text[i:i + 50], doc))
    out = []
    for doc, text in rows:
        gone = np.zeros(len(text), bool)
        for i in range(len(text) - 49):
            if least[text[i:i + 50]] < doc:
                gone[i:i + 50] = True
        left = bytes(b for b, g in zip(text, gone) if not g)
        spans = int((gone & ~np.r_[False, gone[:-1]]).sum()) if len(text) else 0
        out.append((doc, len(text), int(gone.sum()), spans, hashlib.sha256(left).hexdigest()))
    return collections.Counter(out)


def cut(docs):
    found, at = suffix_dedup.remove_repeats(docs)
    rows = found.select(F.coalesce("doc_id", F.lit(suffix_dedup.NO_ID)).alias("doc_id"), *[F.col(at[k]).alias(k) for k in ("n_bytes", "n_removed", "n_spans", "kept")])
    return collections.Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest()) for r in rows.collect())


@pytest.mark.parametrize("alone", [20, 300, 12_500])
def test_hot_key_equals_one_sort(monkeypatch, alone):
    """Runs that share a passage amid their own surroundings, whole equal runs, ties of ids,
    and parts that one very common window fills."""
    monkeypatch.setattr(suffix_dedup, "ALONE", alone)
    for seed in range(5):
        rnd = np.random.default_rng(seed)
        passage = rnd.integers(97, 123, 200).astype(np.uint8)
        texts, windows = [], rnd.integers(1, 30, 150)
        for w in windows.tolist():
            own = rnd.integers(97, 123, int(rnd.integers(0, 60)) if rnd.random() < .7 else 0).astype(np.uint8)
            texts.append(np.concatenate([own, passage])[:w + suffix_dedup.LENGTH - 1])
        docs, at = np.sort(rnd.integers(0, 90, 150)), np.r_[0, np.cumsum([len(t) for t in texts])]
        text = np.concatenate(texts)
        want = suffix_dedup.repeated(text, at, windows, docs)
        got = suffix_dedup.repeated_in_hot_key(text, at[:-1], windows, docs)
        assert len(got[0]) == len(want[0]) and set(zip(*map(np.ndarray.tolist, got))) == set(zip(*map(np.ndarray.tolist, want)))


def test_suffix_dedup_edge_rows(docs, no_docs):
    assert cut(docs) == plain_cut([(suffix_dedup.NO_ID if r[0] is None else r[0], (r[1] or "").encode()) for r in ROWS])
    assert cut(no_docs) == collections.Counter()
    assert set(docs.columns) <= set(suffix_dedup.remove_repeats(docs)[0].columns)


@pytest.mark.parametrize("batch", [40, 400_000])
def test_suffix_dedup_random(spark, monkeypatch, batch):
    monkeypatch.setattr(suffix_dedup, "BATCH", batch)
    monkeypatch.setattr(suffix_dedup, "ALONE", max(20, batch // 12))
    rnd = random.Random(batch)
    shared = ["".join(rnd.choice("ab \né\x00") for _ in range(rnd.randint(30, 160))) for _ in range(12)]
    rows = []
    for i in range(120):
        text = "".join(rnd.choice([rnd.choice(shared), "".join(rnd.choice("abc d") for _ in range(rnd.randint(1, 80))), "z" * rnd.randint(0, 120)])
                       for _ in range(rnd.randint(0, 5)))
        rows.append((rnd.randrange(1000) if i % 10 else i, text))
    got = cut(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    assert got == plain_cut([(i, t.encode()) for i, t in rows])


def test_repeated_in_small_batches_equals_one(monkeypatch):
    rnd = random.Random(4)
    parts = [bytes(rnd.choice(b"ab") for _ in range(rnd.choice([50, 60, 84]))) for _ in range(30)]
    parts += [p[:55] if len(p) > 60 else p for p in parts]
    at = np.r_[0, np.cumsum([len(p) for p in parts])]
    docs, windows = np.array([i % 37 for i in range(len(parts))]), np.diff(at) - 49
    text, win = suffix_dedup.repeated(np.frombuffer(b"".join(parts), np.uint8), at, windows, docs)
    least = {}
    for d, p in zip(docs.tolist(), parts):
        for i in range(len(p) - 49):
            least[p[i:i + 50]] = min(d, least.get(p[i:i + 50], d))
    want = {(k, i) for k, (d, p) in enumerate(zip(docs.tolist(), parts)) for i in range(len(p) - 49) if least[p[i:i + 50]] < d}
    assert set(zip(text.tolist(), win.tolist())) == want and want


def test_two_stage_order_is_sorted():
    rnd = random.Random(9)
    parts = [bytes(rnd.choice(b"aab\x00") for _ in range(rnd.randint(50, 84))) for _ in range(60)]
    at = np.r_[0, np.cumsum([len(p) for p in parts])]
    t, starts, ends = suffix_dedup.layout(np.frombuffer(b"".join(parts), np.uint8), at)
    order = suffix_dedup.two_stage_order(t, starts, np.diff(at) - 49, ends)
    strings = [t[i:i + 50].tobytes() for i in order.tolist()]
    assert strings == sorted(strings) and len(strings) == sum(len(p) - 49 for p in parts)


def test_language_id_held_out(spark):
    docs = spark.read.parquet(f"/root/testdata/sf0.01/documents.parquet")
    net = langid.train(docs, langid.learns(F.col("doc_id")))
    got = langid.predict(docs, net).where(~langid.learns(F.col("doc_id"))).select("lang", "lang_pred", "score").collect()
    assert len(got) > 150 and sum(r.lang == r.lang_pred for r in got) >= 0.97 * len(got)
    assert all(0 <= r.score <= 1 for r in got)


def test_language_id_edge_rows(docs, no_docs):
    net = langid.train(docs, langid.learns(F.col("doc_id")))
    learned = {r[2] for r in ROWS if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 4 != 2 and r[1] and r[2] and langid.has_letter(r[1])}
    out = langid.predict(docs, net)
    rows = out.select("doc_id", "text", "lang_pred", "score").collect()
    assert len(rows) == len(ROWS) and out.columns.count("lang_pred") == 1
    for r in rows:
        if not r.text or not langid.has_letter(r.text):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            assert r.lang_pred in learned and 0 < r.score <= 1
    assert langid.train(no_docs, langid.learns(F.col("doc_id"))) is None
    assert {r.lang_pred for r in langid.predict(docs, None).collect()} == {"und"}
    assert langid.predict(no_docs, net).count() == 0


def plain_kneser_ney(parts, order):
    """Textbook interpolated modified Kneser-Ney over symbol tuples."""
    counts = {order: collections.Counter(tuple(p[i:i + order]) for p in parts for i in range(len(p) - order + 1))}
    for n in range(order - 1, 0, -1):
        counts[n] = collections.Counter(g[1:] for g in counts[n + 1])

    disc, ctx = {}, {}
    for n, c in counts.items():
        of = collections.Counter(c.values())
        n1, n2 = of[1], of[2]
        disc[n] = [min(float(i), max(0.1, i - (i + 1) * n1 / (n1 + 2 * n2) * of[i + 1] / of[i] if of[i] and n1 + n2 else 0.5 * i)) for i in (1, 2, 3)]
        for g, k in c.items():
            total = ctx.setdefault((n, g[:-1]), [0, 0.0])
            total[0] += k
            total[1] += disc[n][min(k, 3) - 1]

    def prob(g):
        if not g:
            return 1 / 256
        n = len(g)
        low = prob(g[1:])
        if (n, g[:-1]) not in ctx:
            return low
        total, cut = ctx[n, g[:-1]]
        k = counts[n].get(g, 0)
        return ((k - disc[n][min(k, 3) - 1]) / total if k else 0.0) + cut / total * low
    return prob


def test_kneser_ney_equals_plain(spark):
    rnd = random.Random(8)
    texts = ["".join(rnd.choice("abcdeé .") for _ in range(rnd.randint(1, 300))) for _ in range(30)]
    model = quality.train(spark.createDataFrame([(i, t, "xx") for i, t in enumerate(texts)], "doc_id long, text string, lang string"))
    pad = [0] * (quality.ORDER - 1)
    prob = plain_kneser_ney([pad + model.symbols(t).tolist() for t in texts], quality.ORDER)
    for t in ["abc", "zzz a", texts[3], "é" * 40, "Q"]:
        s = pad + model.symbols(t).tolist()
        want = math.exp(-sum(math.log(prob(tuple(s[i - quality.ORDER + 1:i + 1]))) for i in range(len(pad), len(s))) / len(t))
        assert math.isclose(quality.perplexities(model, [t], ["xx"])[0], want, rel_tol=1e-9)
        assert math.isclose(quality.perplexities(model, [t], [None], block=7)[0], want, rel_tol=1e-9)     # pooled, in pieces
    ctx = tuple(model.symbols("abc").tolist())
    assert math.isclose(sum(prob((*ctx, s)) for s in range(256)), 1, rel_tol=1e-9)


def test_model_counts_every_trusted_text_whole(spark, monkeypatch):
    """More documents than any sample would hold, and a long one whose middle stands nowhere else."""
    rnd = random.Random(12)
    monkeypatch.setattr(quality, "BLOCK", 5000)                       # a text longer than a block
    texts = ["".join(rnd.choice("abc d") for _ in range(20)) for _ in range(900)]
    texts.append("".join(rnd.choice("efg ") for _ in range(1500)) + "hij" * 4000 + "".join(rnd.choice("efg ") for _ in range(1500)))
    rows = [(i, t, "xx" if i % 3 else None) for i, t in enumerate(texts)] + [(0, texts[0], None)] * 50
    model = quality.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    pad = [0] * (quality.ORDER - 1)
    for lang, mine in (("xx", [t for i, t in enumerate(texts) if i % 3]), (None, texts)):
        prob = plain_kneser_ney([pad + model.symbols(t).tolist() for t in mine], quality.ORDER)
        for t in ["hijhij", "abd cab", "efgij"]:
            s = pad + model.symbols(t).tolist()
            want = math.exp(-sum(math.log(prob(tuple(s[i - quality.ORDER + 1:i + 1]))) for i in range(len(pad), len(s))) / len(t))
            assert math.isclose(quality.perplexities(model, [t], [lang])[0], want, rel_tol=1e-9)


def test_symbols_keep_every_character():
    text = "漢字かなカナ한글" + "".join(map(chr, range(0, 0x3000))) + "\ud800"
    coded = {c: quality.symbols(c).tobytes() for c in text}
    assert len(set(coded.values())) == len(set(text)) and not any(quality.START in v for v in coded.values())
    assert quality.symbols(text).tobytes() == b"".join(coded[c] for c in text)


def test_scripts_are_told_apart(spark):
    """Junk in one script against trusted text in it: merged characters would make both alike."""
    rnd = random.Random(3)
    words = ["日本語", "文章", "学習", "東京都", "情報処理", "です", "ひらがな", "カタカナ"]
    good = ["".join(rnd.choice(words) for _ in range(60)) for _ in range(60)]
    junk = ["".join(chr(rnd.randint(0x4E00, 0x9FA5)) for _ in range(200)) for _ in range(20)]
    docs = spark.createDataFrame([(i, t, "ja") for i, t in enumerate(good + junk)], "doc_id long, text string, lang string")
    out = quality.classify(docs, docs.where("doc_id < 50").select("doc_id")).collect()
    assert all(r.kept == (r.doc_id < 60) for r in out)


def test_threshold_and_decision_equal_plain(spark):
    rnd = random.Random(21)
    pools = {"aa": "abcde ", "bb": "vwxyzé ", None: "abxy "}
    rows = [(i, "".join(rnd.choice(pools[lang]) for _ in range(rnd.randint(1, 120))), lang)
            for i, lang in enumerate(rnd.choice(list(pools)) for _ in range(150))]
    rows += [(150, "qqqqqqqqqq ZZZZ", "aa"), (151, "", "aa"), (152, "abc abd", "cc"), (None, "abc", "aa")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    ids = spark.createDataFrame([(i,) for i in range(0, 150, 2)], "doc_id long")
    model = quality.train(docs, ids)
    quantile, slack, prior = 0.9, 1.1, 16
    trusted = [(t, lang, quality.perplexities(model, [t], [lang])[0]) for i, t, lang in rows if i is not None and i % 2 == 0 and i < 150 and t]

    def limits(lang):
        mine = [r for r in trusted if r[1] == lang] if lang in ("aa", "bb") else trusted
        pooled = sum(len(t) * math.log(p) for t, _, p in mine) / sum(len(t) for t, _, _ in mine)

        def shrunk(t, p, rate):
            return math.exp((len(t) * math.log(p) + prior * rate) / (len(t) + prior))
        rate = {k: sum(len(t) * math.log(p) for t, g, p in trusted if g == k or k is None) / sum(len(t) for t, g, _ in trusted if g == k or k is None) for k in ("aa", "bb", None)}
        steady = sorted(shrunk(t, p, rate[g if g in ("aa", "bb") else None]) for t, g, p in mine)
        return steady[max(0, math.ceil(quantile * len(steady)) - 1)] * slack, lambda t, p: shrunk(t, p, pooled)

    got = quality.classify(docs, ids, quantile=quantile, slack=slack, prior_chars=prior).collect()
    assert len(got) == len(rows)
    for r in got:
        limit, steady = limits(r.lang)
        assert math.isclose(r.threshold, limit, rel_tol=1e-9)
        if not r.text:
            assert r.perplexity is None and not r.kept
            continue
        want = steady(r.text, quality.perplexities(model, [r.text], [r.lang])[0])
        assert math.isclose(r.perplexity, want, rel_tol=1e-9) and r.kept == (want <= limit * (1 + 1e-12))


def test_samples_are_bounded_by_rows(spark):
    """An id that holds a third of the rows, with many texts, enters the samples once a language."""
    rows = [(1, f"hot text number {i} of one id", "en") for i in range(400)] + [(i, f"plain text {i}", "en") for i in range(2, 300)]
    rows += [(None, "no id", "en")] * 50
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    sample = quality._sample(docs, docs.select("doc_id").distinct(), 1000, 1).where("lang = 'en'").collect()
    assert len(sample) == 299 and sum("hot" in r.part for r in sample) == 1
    assert quality.C.sampled_ids(docs, 20, 19).count() == 20


def test_null_id_is_not_held_out(spark):
    ids = spark.createDataFrame([(None,)] + [(i,) for i in range(60)], "doc_id long")
    for r in ids.select("doc_id", langid.held_out(F.col("doc_id")).alias("h"), langid.learns(F.col("doc_id")).alias("l")).collect():
        assert (r.h, r.l) == ((False, False) if r.doc_id is None else ((zlib.crc32(str(r.doc_id).encode()) % 4 == 2), zlib.crc32(str(r.doc_id).encode()) % 4 != 2))


def test_quality_edge_rows(spark, docs, no_docs):
    ids = spark.createDataFrame([(r[0],) for r in ROWS if r[0] is not None and r[0] != 8], "doc_id long")
    out = quality.classify(docs, ids)
    rows = out.collect()
    assert len(rows) == len(ROWS) and out.columns.count("perplexity") == 1
    for r in rows:
        assert (r.perplexity is None) == (not r.text) and r.threshold > 0
        assert r.kept == (bool(r.text) and r.perplexity <= r.threshold)
    untrained = quality.classify(docs, ids.where("false")).collect()
    assert all(r.perplexity is None and r.kept == bool(r.text) for r in untrained)
    assert quality.classify(no_docs, ids).count() == 0


def test_narrowed_keeps_marked_rows(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("x").alias("bits"), F.lit(1).alias("Part"))
    ids = docs.where("doc_id % 4 = 1").select("doc_id").unionByName(spark.createDataFrame([(1,), (None,)], "doc_id long"))
    near = quality.C.narrowed(docs, ids)
    assert near.columns == docs.columns
    assert near.join(ids.distinct(), "doc_id", "left_semi").count() == 5000 and near.count() < 6500
    tight = quality.C.narrowed(docs, ids, most_bits=1 << 12)             # more ids than bits: nothing is lost
    assert tight.join(ids.distinct(), "doc_id", "left_semi").count() == 5000
    text, other = (x.select(F.col("doc_id").cast("string").alias("doc_id")) for x in (docs, ids))
    assert quality.C.narrowed(text, other).join(other.distinct(), "doc_id", "left_semi").count() == 5000
    assert quality.C.narrowed(docs, other).count() == 20_000                # other types: no look-up
    assert quality.C.narrowed(docs, ids.where("false")).count() == 0


def test_quality_shuffles_trusted_texts_only(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(quality, "train", lambda texts, *a: seen.append(texts.count()))
    docs = spark.createDataFrame([(i, f"text {i}", "en") for i in range(2000)], "doc_id long, text string, lang string")
    quality.classify(docs, docs.where("doc_id % 10 = 0").select("doc_id")).count()
    assert 200 <= seen[0] < 400                                           # all 2,000 met the labels by a shuffle


def test_quality_separates_labels(spark):
    sf = f"/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    out = quality.classify(spark.read.parquet(f"{sf}/documents.parquet"), labels.where("quality = 1 AND toxic = 0").select("doc_id"))
    rate = {r.quality: r.m for r in out.join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("double")).alias("m")).collect()}
    assert rate[1] >= 0.97 and rate[0] <= 0.35


def test_seating_sampler_matches_exact_mean():
    rng, c, strength, d = np.random.default_rng(0), 25, 0.7, 0.6
    got = hpy.seat(np.full(40_000, c), np.full(40_000, strength), d, rng).mean()
    state = {1: 1.0}
    for n in range(1, c):
        new = collections.defaultdict(float)
        for t, p in state.items():
            q = strength / (n - d * t + strength)
            new[t + 1] += p * q
            new[t] += p * (1 - q)
        state = new
    assert abs(got - sum(t * p for t, p in state.items())) < 0.03
    big = hpy.seat(np.array([1, 100_000, 0]), np.array([0.5, 0.5, 0.5]), 0.5, rng)
    assert big[0] == 1 and big[2] == 0 and 1 < big[1] < 100_000


@pytest.mark.parametrize("source", ["edge", "table"])
def test_hpy_counts_and_scores(spark, docs, source):
    if source == "edge":
        rows, df = [(r[0], r[1]) for r in ROWS], docs
    else:
        t = pq.read_table(f"{SF}/documents.parquet").to_pandas()
        rows, df = list(zip(t.doc_id, t.text)), spark.read.parquet(f"{SF}/documents.parquet")
    count, tokens = collections.Counter(), []
    for i, text in rows:
        w = [x.encode() for x in WORD.findall((text or "").translate(LOWER))] + [hpy.END]
        part = None if i is None else zlib.crc32(str(i).encode()) % 7
        tokens.append((i, part == 2, w))
        if part is not None and part != 2:
            count.update(w)
    n, v = sum(count.values()), len(count)
    got = hpy.score_documents(df).collect()
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2], r[3])
    want = sorted(((i, h, len(w), sum(count[x] > 0 for x in w), sum(math.log10((count[x] + 1) / (n + v + 1)) for x in w)) for i, h, w in tokens), key=key)
    have = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.base_score) for r in got), key=key)
    assert {r.train_tokens for r in got} == {n}
    for a, b in zip(have, want, strict=True):
        assert a[:4] == b[:4] and math.isclose(a[4], b[4], rel_tol=1e-9)
    assert all(r.score < 0 for r in got)
    if source == "table":
        held = [r for r in got if r.held_out]
        assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert hpy.score_documents(df.where("false")).count() == 0


def test_hpy_messages_are_whole_and_small():
    rng = np.random.default_rng(4)
    key = np.sort(rng.integers(0, 1 << 64, 5000, np.uint64))
    parts = {"key": key, "odd": key[::-1].copy(), "step": rng.integers(0, 3, 5000).astype(np.uint32), "p": rng.normal(-4, 1, 5000).astype(np.float32),
             "total": np.arange(34).reshape(17, 2), "klass": np.arange(7, dtype=np.uint8), "none": np.empty(0, np.int64), "one": np.array([1 << 63], np.uint64)}
    got = hpy._unpack(pa.py_buffer(hpy._pack(**parts)))
    assert list(got) == list(parts)
    for k, a in parts.items():
        assert got[k].dtype == a.dtype and np.array_equal(got[k], a.ravel()), k
    assert len(hpy._pack(t=np.arange(5, dtype=np.uint32))) < 40          # messages grow with the square of the buckets
    assert len(hpy._pack(key=key)) < 0.92 * key.nbytes
    assert len(hpy._pack(p=parts["p"])) < 0.92 * parts["p"].nbytes


def test_hpy_predictive_sums_to_one():
    rng = np.random.default_rng(1)
    code = np.unique(rng.integers(0, 200 * hpy.CONTEXTS, 900))
    word = np.unique(code // hpy.CONTEXTS, return_inverse=True)[1]
    data = {"word_step": hpy._steps(word), "context": (code % hpy.CONTEXTS).astype(np.uint8), "c": rng.integers(1, 9, len(code))}
    v = int(word[-1]) + 1
    b = hpy.Bucket(0, data, {"seed": 1, "theta": 1.0, "d": 0.6, "d_top": 0.5, "base": 1 / (v + 1)})
    total = b.totals().astype(float)
    for turn in (1, 2):
        b.sweep(turn, total)
        total = b.totals().astype(float)
    d, theta = 0.6, 1.0
    top = b.top_prob(total)
    unknown = (theta + 0.5 * total[-1, 1]) / (v + 1) / (theta + total[-1, 0])
    assert math.isclose(top.sum() + unknown, 1, rel_tol=1e-9)
    ctx = 3
    back = (theta + d * total[ctx, 1]) / (theta + total[ctx, 0])
    mine = b.context == ctx
    rest = 1 - top[b.word[mine]].sum()                   # words not seen here, and the unknown one
    assert math.isclose(b.predictive(total)[mine].sum() + back * rest, 1, rel_tol=1e-9)


def test_hpy_contexts_are_words(spark):
    """The two words before share a class, but not a restaurant."""
    rows = [(i, " ".join(["aaing one", "bbing two"] * 5)) for i in range(60)] + [(1000 + i, t) for i, t in enumerate(
        ["aaing one", "aaing two", "bbing one", "bbing two"])]
    got = {r.doc_id: r.score for r in hpy.score_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1000] + got[1003] > got[1001] + got[1002] + 1         # what follows cancels out


def test_hpy_word_contexts_sum_to_one():
    rng = np.random.default_rng(1)
    code = np.unique(rng.integers(0, 200 * 50, 900))
    word = np.unique(code // 50, return_inverse=True)[1]
    data = {"word_step": hpy._steps(word), "context": (code % 50).astype(np.uint32), "klass": np.arange(50, dtype=np.uint8) % hpy.CONTEXTS,
            "c": rng.integers(1, 9, len(code))}
    v = int(word[-1]) + 1
    b = hpy.Seating(0, data, {"seed": 1, "theta": 1.0, "d_word": 0.7, "d": 0.6, "d_top": 0.5, "base": 1 / (v + 1)})
    customers = b.per_context(b.c)
    for turn in (1, 2):
        b.sweep(turn, b.classes.totals().astype(float), b.per_context(b.t))
    assert (b.t >= 1).all() and (b.t <= b.c).all() and b.classes.c.sum() == b.t.sum()
    total, tables = b.classes.totals().astype(float), b.per_context(b.t)
    c = b.classes
    top = c.top_prob(total)
    for ctx in range(50):
        k = ctx % hpy.CONTEXTS
        klass = (1.0 + 0.6 * total[k, 1]) / (1.0 + total[k, 0]) * top       # every word's probability in the class
        seen = c.context == k
        klass[c.word[seen]] = c.predictive(total)[seen]
        unknown = (1.0 + 0.6 * total[k, 1]) / (1.0 + total[k, 0]) * (1 - top.sum())
        assert math.isclose(klass.sum() + unknown, 1, rel_tol=1e-9)
        back = (1.0 + 0.7 * tables[ctx]) / (1.0 + customers[ctx])
        mine = b.context == ctx
        rest = 1 - klass[b.word[mine]].sum()
        assert math.isclose(b.predictive(total, tables, customers)[mine].sum() + back * rest, 1, rel_tol=1e-9)
