"""Conversation repair, cross-tokenizer alignment and sharding against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from pyspark.sql import types as T
from tokenizers import Tokenizer

from postflow.llm import alignment, conversations, queries, sharding
from tests.llm.conftest import ROWS

SF = "/root/testdata/sf0.001"
LEGAL = re.compile(r"(s?(ua)+)?")
PREFIX = re.compile(r"s?(ua)*u?")


# ------------------------------------------------------------------ 11: conversation repair
def cheapest(rows):
    """(cost, audit, repaired rows) over all edits of ``rows`` (role, text, fault); of the ways to
    the same initials after the same row only the least is kept."""
    def least(held, key, value):
        if key not in held or value[:2] < held[key][:2]:
            held[key] = value

    living = {"": (0, "", ())}            # initials -> (cost, audit, rows)
    for role, text, fault in rows:
        grown = dict(living)
        for ini, (cost, audit, out) in living.items():
            for inserts in (("user",), ("assistant",), ("user", "assistant"), ("assistant", "user")):
                to = ini + "".join(x[0] for x in inserts)
                if PREFIX.fullmatch(to):
                    least(grown, to, (cost + 3 * len(inserts), audit + "I" * len(inserts), (*out, *((x, "") for x in inserts))))
        living = {}
        for ini, (cost, audit, out) in grown.items():
            least(living, ini, (cost + 4, audit + "D", out))
            more = 3 if fault == "truncated" else 0
            if fault != "drop" and PREFIX.fullmatch(ini + (role[:1] or "?")):
                least(living, ini + role[:1], (cost + more, audit + "K", (*out, (role, text))))
            for letter, name in (("u", "user"), ("a", "assistant")):
                if fault != "drop" and PREFIX.fullmatch(ini + letter):
                    least(living, ini + letter, (cost + 3 + more, audit + "R", (*out, (name, text))))
    ends = []
    for ini, (cost, audit, out) in living.items():
        for tail in ((), ("user",), ("assistant",), ("user", "assistant"), ("assistant", "user")):
            if LEGAL.fullmatch(ini + "".join(t[0] for t in tail)):
                ends.append((cost + 3 * len(tail), audit + "I" * len(tail), (*out, *((t, "") for t in tail))))
    return min(ends, key=lambda e: e[:2])


def expected_reports(rows):
    """Contract by plain Python: rows (conv_id, turn, role, text) -> {conv_id: report}."""
    left = defaultdict(list)
    for conv, turn, role, text in rows:
        left[conv]
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if k == 0:
            continue
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        left[conv] += [(turn, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)
    out = {}
    for conv, held in left.items():
        held.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        turns = {t for t, _, _ in held if t is not None}
        seen, faults, kinds = set(), Counter(), []
        for _, role, text in held:
            core = re.findall(r"[^\x20\x09-\x0D]", text)
            kind = "blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else ""
            seen.add((role, text))
            faults[kind] += 1
            kinds.append((role, text, "drop" if kind in ("blank", "duplicate") else kind))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(held, held[1:]))
        cost, audit, rows_out = cheapest(kinds)
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in rows_out).encode()).hexdigest()
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults["blank"], faults["duplicate"],
                     faults["truncated"], illegal, cost, audit, sha)
    return out


def conversation_rows(seed, n, rows):
    rnd = random.Random(seed)
    return [(c, rnd.choice([None, 0, 1, 2, 3, 5, 9]), rnd.choice(["user", "assistant", "system", "tool", "", None]),
             rnd.choice(["a b.", "c d", "", "  ", "Was?", "x!\n", None, "a b."])) for c in range(n) for _ in range(rnd.randint(1, rows))]


SCHEMA = "conv_id long, turn long, role string, text string"


def reports(spark, rows, schema=SCHEMA):
    df = spark.createDataFrame(rows, schema).repartition(3)
    out = conversations.all_conversations(df, conversations.repair_report(conversations.damage(df)))
    return {r.conv_id: tuple(r)[1:] for r in out.collect()}


def test_repair_equals_brute_force(spark):
    rows = conversation_rows(3, 250, 5) + [(None, 1, "user", "no id."), (None, None, None, None), (-4, 7, "user", "one way?")]
    assert reports(spark, rows) == expected_reports(rows)


def test_repair_of_long_conversation_folds(spark, monkeypatch):
    rnd = random.Random(4)
    rows = [(r, t, {"": "drop", "a": "truncated"}.get(t, "")) for r, t in
            ((rnd.choice(["user", "assistant", "x", "system"]), rnd.choice(["", "a", "b."])) for _ in range(60))]

    def report():
        c = conversations.Conversation(conversations.RepairParser())
        for i, (role, text, _) in enumerate(rows):
            c.read(i, role, text + " " * i, (True, i))
        return c.report()

    whole = report()
    monkeypatch.setattr(conversations, "FOLD_BYTES", 500)
    assert report() == whole


def test_repaired_rows_follow_the_grammar(spark):
    rows = conversation_rows(5, 80, 6)
    df = spark.createDataFrame(rows, SCHEMA)
    made = defaultdict(list)
    for r in conversations.repaired_rows(df).orderBy("conv_id", "position").collect():
        made[r.conv_id].append((r.position, r.edit, r.role, r.text))
    digest = {r.conv_id: r.repaired_sha256 for r in conversations.repair_report(df).collect()}
    assert len(digest) == 80 and made
    for conv, sha in digest.items():
        out = made[conv]
        assert LEGAL.fullmatch("".join(r[:1] for _, _, r, _ in out)) and [p for p, *_ in out] == list(range(len(out)))
        assert hashlib.sha256("\n".join(f"{r}:{t}" for *_, r, t in out).encode()).hexdigest() == sha


def test_repair_edge_tables(spark):
    assert reports(spark, []) == {}
    clash = "conv_id long, turn long, role string, text string, place string, print string, cost string"
    rows = [(1, 0, "user", "Q?", "x", "y", "z"), (1, 1, "assistant", "A.", "x", "y", "z")]
    assert reports(spark, rows, clash) == expected_reports([r[:4] for r in rows])
    hot = [(7, i, "user", "same words.") for i in range(3000)]
    got = reports(spark, hot)[7]
    kept = sum(zlib.crc32(f"7:{i}".encode()) % 20 != 0 for i in range(3000))
    assert got[1] > 0 and got[6].count("D") >= kept - 2


def test_grammar_tables():
    g = conversations.RoleGrammar()
    g.check_tops()
    for text in ("", "ua", "sua", "suaua", "s", "u", "uau", "sau", "au", "ss"):
        at = g.start
        for x in text:
            at = at and g.shift(at, x)
        assert bool(at and g.shift(at, "$") is not None) == bool(LEGAL.fullmatch(text)), text
    with pytest.raises(ValueError):
        conversations.RoleGrammar((("C", ("P",)), ("P", ("u", "P", "a")), ("P", ()))).check_tops()


def test_op11_contract(spark):
    got = {r.conv_id: tuple(r)[1:] for r in queries.op11_role_repair(spark, SF).collect()}
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got == expected_reports(rows)


# ------------------------------------------------------------------ 12: alignment
A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


def expected_alignment(rows):
    """[(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, sha)] from the libraries alone, whole texts."""
    tok, sp = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    tok.encode_special_tokens = True
    of = alignment.byte_alphabet()
    name = {i: t for t, i in tok.get_vocab().items()}
    docs, count = [], Counter()
    for doc, text in rows:
        raw = (" " + (text or "")).encode()
        a = tok.encode(" " + text, add_special_tokens=False).ids if text else []
        b = sp.encode(text) if text else []
        ab = [bytes(of[c] for c in name[i]) for i in a]
        bb = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode() for p in map(sp.id_to_piece, b)]
        if not text or b"".join(ab) != raw or b"".join(bb) != raw:
            docs.append((doc, 0, 0, [], ""))
            continue
        ends_a = {int(e): i for i, e in enumerate(np.cumsum([len(x) for x in ab]))}
        ends_b = {int(e): i for i, e in enumerate(np.cumsum([len(x) for x in bb]))}
        links, groups, i0, j0 = [], [], 0, 0
        for e in sorted(set(ends_a) & set(ends_b)):
            i, j = ends_a[e] + 1, ends_b[e] + 1
            links.append((a[i - 1], b[j - 1]))
            groups.append(",".join(map(str, a[i0:i])) + "|" + ",".join(map(str, b[j0:j])))
            i0, j0 = i, j
        count.update(links)
        docs.append((doc, len(a), len(b), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    top = defaultdict(int)
    for (_, y), n in count.items():
        top[y] = max(top[y], n)
    return sorted(((d, na, nb, len(ls), len(ls), sum(count[x] == top[x[1]] for x in ls), sum(count[x] for x in ls), s)
                   for d, na, nb, ls, s in docs), key=repr), count


COLS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
ODD = ["two  blanks", " lead", "trail ", "a\n b", "\n\n x", "literal ▁ mark", "<|endoftext|> <s> x", "　wide", "tab\tin", "é ﬁ Ⅳ 🙂🙂", "\x1c y", "\x85 z", "a  b"]


def test_alignment_equals_libraries(spark, docs):
    want, count = expected_alignment([r[:2] for r in ROWS])
    made, pairs = alignment.align_documents(docs, A, B, chunk_bytes=20_000)
    assert sorted((tuple(r) for r in made.select(COLS).collect()), key=repr) == want
    assert {(r.a, r.b): r.links for r in pairs.collect()} == count


def test_alignment_of_odd_spacing(spark):
    rows = [(i, t) for i, t in enumerate(ODD * 3)]
    want, count = expected_alignment(rows)
    made, pairs = alignment.align_documents(spark.createDataFrame(rows, "doc_id long, text string"), A, B, keep_groups=True)
    got = made.collect()
    assert sorted((tuple(r[c] for c in COLS) for r in got), key=repr) == want
    assert all(hashlib.sha256(r.groups.encode()).hexdigest() == r.groups_sha256 if r.groups else r.groups_sha256 == "" for r in got)
    assert sum(count.values()) == sum(r.links for r in pairs.collect())


def test_alignment_of_no_documents(no_docs):
    made, pairs = alignment.align_documents(no_docs, A, B)
    assert made.collect() == [] and pairs.collect() == []


def test_pair_index_bitmaps():
    rnd = np.random.default_rng(1)
    pair = np.concatenate([np.zeros(900, np.int64), rnd.integers(1, 40, 3000), np.full(7, 99)])
    doc = np.concatenate([np.arange(900), rnd.integers(0, 1000, 3000), np.full(7, 5)])
    index = alignment.PairIndex.unpack(alignment.PairIndex.of_links(pair, doc, 1000).pack(), 1000)
    pairs, documents, links = index.counts()
    for p, d, n in zip(pairs.tolist(), documents.tolist(), links.tolist()):
        assert (d, n) == (len(set(doc[pair == p].tolist())), int((pair == p).sum()))
    best = pairs % 2 == 0
    n_best, total = index.scores(pairs, links, best)
    of = dict(zip(pairs.tolist(), links.tolist()))
    for d in range(1000):
        own = pair[doc == d].tolist()
        assert (n_best[d], total[d]) == (sum(p % 2 == 0 for p in own), sum(of[p] for p in own))
    empty = alignment.PairIndex.unpack(alignment.PairIndex.of_links(pair[:0], doc[:0], 3).pack(), 3)
    assert empty.counts()[0].size == 0 and empty.scores(pairs, links, best)[1].tolist() == [0, 0, 0]


def test_aligner_cache_is_bounded(monkeypatch):
    monkeypatch.setattr(alignment, "MAX_WORDS", 20)
    tool = alignment.PairAligner(A, B)
    for i in range(20):
        words = [f"w{i}x{j}" for j in range(15)]
        assert tool.look_up(words) == [tool.learn([w])[0] for w in words]
    assert len(tool.words) <= 35


def test_op12_contract(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in queries.op12_alignment(spark, SF).select(COLS).collect()), key=repr)
    assert got == expected_alignment(rows)[0]


# ------------------------------------------------------------------ 13: sharding
def check_shards(rows, texts, shards):
    assert sorted((r.doc_id is None, r.doc_id, r.size, r.text_crc32) for r in rows) == sorted(
        (d is None, d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in texts)
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(shards))
    return [sum(r.size for r in rows if r.shard == s) for s in range(shards)]


def sharded(spark, texts, **options):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    return sharding.balanced_shards(df, **options).collect()


def test_shards_are_balanced_jointly(spark):
    rnd = random.Random(6)
    texts = [" ".join(rnd.choice(["a", "word", "longerword"]) for _ in range(int(rnd.expovariate(1 / 60)) + 1)) for _ in range(4000)]
    texts += ["copy " * 30] * 200 + [None] * 20 + [""] * 20 + ["x" * 9000]
    rows = sharded(spark, texts, shards=4, block_groups=500)
    sizes = check_shards(rows, list(enumerate(texts)), 4)
    assert max(sizes) - min(sizes) <= 0.005 * sum(sizes) / 4
    for value in (lambda r: r.n_tokens, lambda r: 1):
        load = [sum(value(r) for r in rows if r.shard == s) for s in range(4)]
        assert max(load) - min(load) <= 0.03 * sum(load) / 4
    held = defaultdict(set)
    for r in rows:
        held[texts[r.doc_id]].add(r.shard)
    assert all(len(s) == 1 for s in held.values())


def test_group_of_a_third_is_cut(spark):
    texts = ["the same text again"] * 1000 + [f"text {i} " * (i % 9 + 1) for i in range(2000)]
    rows = sharded(spark, texts, shards=8, block_groups=300)
    sizes = check_shards(rows, list(enumerate(texts)), 8)
    assert max(sizes) - min(sizes) <= 0.01 * sum(sizes) / 8
    held = defaultdict(set)
    for r in rows:
        held[texts[r.doc_id]].add(r.shard)
    assert len(held[texts[0]]) > 1 and all(len(s) == 1 for t, s in held.items() if t != texts[0])


def test_shards_of_edge_tables(spark, docs, no_docs):
    rows = sharding.balanced_shards(docs, shards=3).collect()
    check_shards(rows, [r[:2] for r in ROWS], 3)
    assert sharding.balanced_shards(no_docs).collect() == []
    check_shards(sharded(spark, ["same"] * 40, shards=16), [(i, "same") for i in range(40)], 16)
    by_tokens = sharding.balanced_shards(docs, shards=2, tokens=docs["n_chars"]).collect()
    assert sum(r.n_tokens for r in by_tokens) == sum(len(r[1] or "") for r in ROWS)


def test_op13_contract(spark):
    rows = queries.op13_sharding(spark, SF).collect()
    texts = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    sizes = check_shards(rows, texts, 16)
    largest = max(r.size for r in rows)                # in so small a table one text may be more than a shard's share
    assert max(sizes) - min(sizes) <= max(0.02 * sum(sizes) / 16, largest - sum(sizes) / 16)
    assert {(r.law, r.grown_shard) for r in rows} == {("bytes", None)}
