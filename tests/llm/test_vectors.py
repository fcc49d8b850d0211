"""Exact top-k and NN-descent against brute force."""

import numpy as np
import pytest

from postflow.llm import nn_descent, topk

NAN, INF = float("nan"), float("inf")
SCHEMA = "vec_id long, embedding array<float>, label int, score double, node long, unit string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 0.0, 0, "x") for r in rows], SCHEMA).repartition(3)


def clustered(n=300, dim=16, seed=1):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(n // 6, dim))
    rows = []
    for i in range(n):
        v = centre[rng.integers(len(centre))] + rng.normal(size=dim) * rng.choice([0.0, 0.02, 0.05, 0.5])
        rows.append((i, [float(np.float32(x)) for x in v], int(rng.integers(3))))
    return rows + [(n, None, 1), (n + 1, [0.0] * dim, 1), (n + 2, [NAN] + [1.0] * (dim - 1), 1), (n + 3, [INF] * dim, 0),
                   (n + 4, [None] + [1.0] * (dim - 1), 0), (n + 5, [], 0), (n + 6, [1.0] * 3, 0), (n + 7, [1.0] * dim, None),
                   (n + 8, [2.0] * dim, None), (n + 50, rows[4][1], rows[4][2]), (n + 50, rows[4][1], rows[4][2])]


@pytest.mark.parametrize("block", [7, 1024])
def test_top_k(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "BLOCK_ROWS", block)
    monkeypatch.setattr(topk, "SHARD_BLOCKS", 4)
    monkeypatch.setattr(topk, "QUERY_BLOCKS", 3)
    rows = clustered()
    use = [(i, v) for i, v, _ in rows if v and all(x is not None and np.isfinite(x) for x in v)]
    q = [(i, np.floor(256 * np.array(v, np.float64)).astype(int)) for i, v in use]
    want = []
    for k, (i, v) in enumerate(q):
        if i % 50 == 0:
            s = sorted((-int(v @ w), j) for m, (j, w) in enumerate(q) if m != k and len(w) == len(v))[:5]
            want += [(i, r + 1, j, -x) for r, (x, j) in enumerate(s)]
    got = topk.top_k(topk.make_blocks(frame(spark, rows)), k=5, query_every=50).collect()
    assert sorted(map(tuple, got)) == sorted(want) and len(want) >= 40


def test_top_k_prunes_and_is_empty_on_empty(spark):
    rng = np.random.default_rng(2)
    blocks = []
    for b in range(20):
        m = rng.integers(0, 10, (50, 4)) + (1000 if b == 3 else 0)
        blocks.append({"block": b, "ids": np.arange(b * 50, b * 50 + 50), "matrix": m, "high": m.max(0), "low": m.min(0)})
    found, visits = topk.best_of_blocks(np.ones((4, 4), np.int64), np.full((4, 2), -1), blocks, 5)
    assert visits == 4 and all((ids // 50 == 3).all() for _, ids in found)
    assert topk.top_k(topk.make_blocks(frame(spark, clustered()).where("false"))).count() == 0


def test_wide_integers_stay_exact():
    q = np.array([[2 ** 40, 1]])
    assert topk._products(q, np.array([[2 ** 20, 1], [2 ** 20, 2]])).tolist() == [[2 ** 60 + 1, 2 ** 60 + 2]]


def brute(rows, threshold=0.98):
    units = [None if lab is None else nn_descent.unit(v) for _, v, lab in rows]
    n, root = [0] * len(rows), list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            a, b = units[i], units[j]
            if a is not None and b is not None and rows[i][2] == rows[j][2] and len(a) == len(b) and a @ b >= threshold:
                n[i] += 1
                n[j] += 1
                root[max(find(i), find(j))] = min(find(i), find(j))
    first = {}
    for i, r in enumerate(rows):
        first[find(i)] = min(first.get(find(i), r[0]), r[0])
    return sorted((r[0], n[i], first[find(i)]) for i, r in enumerate(rows))


def test_nn_descent(spark):
    rows, report = clustered(), {}
    got = nn_descent.near_duplicates(frame(spark, rows), report=report).collect()
    assert report["recall"][-1] >= 0.98
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == brute(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_nn_descent_dense_group_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(nn_descent, "BLOCK", 16)
    rng = np.random.default_rng(6)
    rows = [(i, [float(np.float32(x)) for x in np.ones(12) + rng.normal(size=12) * 0.05], 1) for i in range(90)]
    got = nn_descent.near_duplicates(frame(spark, rows)).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == brute(rows)


def test_nn_descent_empty(spark):
    assert nn_descent.near_duplicates(frame(spark, clustered()).where("false")).count() == 0


def test_nn_descent_audit_needs_evidence(spark):
    rng = np.random.default_rng(3)
    far = [(i, [float(np.float32(x)) for x in rng.normal(size=32)], 1) for i in range(120)]
    report = {}
    nn_descent.near_duplicates(frame(spark, far), report=report).count()
    assert report["true_links"] == 0 and set(report["recall"]) == {None}
    rows = far + [(1000, far[7][1][:31] + [far[7][1][31] + 0.01], 1)]
    report = {}
    got = nn_descent.near_duplicates(frame(spark, rows), audit=1, report=report).collect()
    assert report["true_links"] == 2 and report["recall"][-1] == 1.0
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == brute(rows)


def test_nn_descent_joins_own_list_length(spark):
    """A node with a list of 12 meets 36 members; those left out come first in the next round."""
    graph = spark.createDataFrame([(0, i, 1.0 - i / 1000, 1, 12) for i in range(1, 61)], "a long, b long, sim double, fresh int, k int")
    lists = nn_descent._lists(graph).where("node = 0").withColumn("joined", nn_descent.F.expr("rank <= 3 * k"))
    assert sorted(r.member for r in lists.where("joined").collect()) == list(range(1, 37))
    units = np.eye(61)
    nodes = spark.createDataFrame([(i, u.tobytes()) for i, u in enumerate(units)], "node long, unit binary")
    met = {(r.a, r.b) for r in nn_descent._join_lists(graph, lists, nodes).collect()}
    assert {(a, b) for a in range(1, 37) for b in range(1, 37) if a != b} == met
    aged = graph.withColumn("fresh", nn_descent.F.expr("IF(b <= 36, 0, 1)"))
    first = nn_descent._lists(aged).where("node = 0 AND rank <= 24").collect()
    assert sorted(r.member for r in first) == list(range(37, 61))
