"""Embedding near-duplicates by NN-descent.

1. Equal vectors of a label are one node with a multiplicity; nodes carry the
   unit vector in double precision.
2. A neighbour graph starts from neighbours in the order of random projections
   (several orders, per label) and is refined: each node's list, its own
   neighbours plus the nodes that list it, is joined with itself, so neighbours
   of neighbours meet; every list keeps its best ``k``. Only lists with a new
   member are joined again, and of those only pairs with a new member. A join takes
   three times the node's own ``k`` members, new ones first; those it leaves out
   stay new for the next round.
3. A list whose last neighbour still reaches the threshold is saturated: its
   ``k`` doubles, so dense groups keep growing lists.
4. Edges at or above the threshold form components. Inside a component all pairs
   are counted exactly, block against block, so a full list never hides a link
   and no pair is emitted.
5. Recall is audited against brute force after ``least_rounds`` rounds: a sample
   of nodes meets all rows of its label in blocks, and a true link is found if step
   4 counts it. The sample grows fourfold until it holds ``evidence`` true links or
   ``audit_most`` nodes; without any true link the recall is unknown (None).
   Refinement ends when the components stop growing and the recall is on target or
   unknown. A recall below the target after ``rounds`` rounds is an error.

Defined results: vectors with a null label, null or zero vectors, vectors with
null or non-finite components, and null ids link with nothing (0 links, own
component, kept); different lengths do not compare; repeated rows are copies of
each other; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postflow.llm import common as C
from postflow.llm.components import connected_components

BLOCK = 512       # nodes of a counting block


def unit(vector: list | None) -> np.ndarray | None:
    """Unit vector in double precision; None if it links with nothing."""
    if not vector or any(x is None for x in vector):
        return None
    v = np.asarray(vector, np.float64)
    if not np.isfinite(v).all():
        return None
    big = np.abs(v).max()
    if big == 0:
        return None
    v = v / big                                          # no overflow, no underflow
    return v / np.sqrt(v @ v)


def _nodes(rows: DataFrame) -> DataFrame:
    """rows (vec_id, label, v) -> vec_id, label, unit (binary; null if it links with nothing)."""
    def run(batches):
        for b in batches:
            made = [None if lab is None or i is None or (u := unit(v)) is None else u.astype("<f8").tobytes()
                    for i, lab, v in zip(*(c.to_pylist() for c in b.columns))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(made, pa.binary())], names=["vec_id", "label", "unit"])
    kind = rows.schema["label"].dataType.simpleString()
    return rows.mapInArrow(run, f"vec_id long, label {kind}, unit binary")


def _start(nodes: DataFrame, n_nodes: int, orders: int, reach: int) -> DataFrame:
    """Directed edges (a, b) between neighbours in random-projection orders of each label.

    The sign bits of random hyperplanes are the leading key, one more projection
    orders within equal bits; windows deal each label's rows by the first bits,
    as many as keep a window to some 65,536 nodes.
    """
    first = max(0, (n_nodes // 65536).bit_length())
    n_bits = first + 12

    def run(batches):
        for b in batches:
            ids, units = b.column(0).to_pylist(), b.column(2).to_pylist()
            for dim in {len(u) for u in units}:
                at = [i for i, u in enumerate(units) if len(u) == dim]
                m = np.stack([np.frombuffer(units[i], "<f8") for i in at])
                for o in range(orders):
                    rng = np.random.default_rng([o, dim])
                    planes = rng.normal(size=(n_bits + 1, dim // 8))
                    bits = (m @ planes[:n_bits].T > 0).astype(np.int64) @ (1 << np.arange(n_bits))
                    yield pa.RecordBatch.from_arrays([
                        pa.array([ids[i] for i in at], pa.int64()), b.column(1).take(pa.array(at, pa.int64())),
                        pa.array(np.full(len(at), o * 1000003 + dim)), pa.array(bits), pa.array(m @ planes[n_bits])],
                        names=["a", "label", "order", "bits", "proj"])
    kind = nodes.schema["label"].dataType.simpleString()
    rows = nodes.select("node", "label", "unit").mapInArrow(run, f"a long, label {kind}, order long, bits long, proj double")
    w = Window.partitionBy("label", "order", F.shiftright("bits", 12)).orderBy("bits", "proj", "a")
    ahead = rows.select("a", *[F.lead("a", s).over(w).alias(f"b{s}") for s in range(1, reach + 1)])
    near = F.explode(F.array(*[f"b{s}" for s in range(1, reach + 1)]))
    return ahead.select("a", near.alias("b")).where("b IS NOT NULL").distinct()


def _audit(nodes: DataFrame, sample: int, threshold: float, evidence: int, most: int) -> tuple[DataFrame, int]:
    """All links (a, b) of a sample of nodes that holds ``evidence`` links, or ``most`` nodes, and their number."""
    truth, n_true, done = None, 0, 0
    while True:
        probe = (nodes.orderBy(F.xxhash64("node", F.lit(23)), "node").limit(sample).select("node", "label", "unit").collect())[done:]
        if truth is None or probe:
            more = _links_of(nodes, probe, threshold)
            truth, n_true, done = more if truth is None else truth.union(more), n_true + more.count(), done + len(probe)
        if n_true >= evidence or sample >= most or done < sample:
            return truth, n_true
        sample = min(4 * sample, most)


def _links_of(nodes: DataFrame, probe: list, threshold: float) -> DataFrame:
    """All links (a, b) of the nodes ``probe``, by brute force in blocks."""
    shared = nodes.sparkSession.sparkContext.broadcast(
        [(r.node, r.label, np.frombuffer(bytes(r.unit), "<f8")) for r in probe])            # ``audit_most`` vectors at most

    def run(batches):
        by: dict = {}
        for node, label, u in shared.value:
            by.setdefault((label, len(u)), []).append((node, u))
        for b in batches:
            a, c = [], []
            ids, labels = np.array(b.column(0).to_pylist(), np.int64), b.column(1).to_pylist()
            units = [np.frombuffer(u, "<f8") for u in b.column(2).to_pylist()]
            for key, mine in by.items():
                at = [i for i, u in enumerate(units) if (labels[i], len(u)) == key]
                there = np.stack([units[i] for i in at]).T if at else None
                for lo in range(0, len(mine) if at else 0, BLOCK):
                    sims = np.stack([u for _, u in mine[lo:lo + BLOCK]]) @ there
                    for r, s in zip(*np.nonzero(sims >= threshold)):
                        if mine[lo + r][0] != ids[at[s]]:
                            a.append(mine[lo + r][0])
                            c.append(int(ids[at[s]]))
            yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(c, pa.int64())})
    return C.checkpointed(nodes.select("node", "label", "unit").mapInArrow(run, "a long, b long"))


def _scored(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Directed edges (a, b) with their similarity, both ways; units meet by two joins."""
    u = nodes.select("node", "unit")
    both = (edges.join(u.withColumnsRenamed({"node": "a", "unit": "ua"}), "a")
                 .join(u.withColumnsRenamed({"node": "b", "unit": "ub"}), "b"))

    def run(batches):
        for t in batches:
            a, b = t.column(0).to_numpy(), t.column(1).to_numpy()
            sim = np.array([float(np.frombuffer(x, "<f8") @ np.frombuffer(y, "<f8")) if len(x) == len(y) else -2.0
                            for x, y in zip(t.column(2).to_pylist(), t.column(3).to_pylist())])
            ok = sim > -2
            a, b, sim = a[ok], b[ok], sim[ok]
            yield pa.RecordBatch.from_arrays([pa.array(np.r_[a, b]), pa.array(np.r_[b, a]), pa.array(np.r_[sim, sim])], names=["a", "b", "sim"])
    return both.select("a", "b", "ua", "ub").mapInArrow(run, "a long, b long, sim double")


def _best(edges: DataFrame, limits: DataFrame, k: int) -> DataFrame:
    """The best neighbours of each node, up to its list length; ``fresh`` survives if every copy of the edge is fresh."""
    one = edges.groupBy("a", "b").agg(F.max("sim").alias("sim"), F.min("fresh").alias("fresh"))
    w = Window.partitionBy("a").orderBy(F.desc("sim"), "b")
    ranked = one.withColumn("rank", F.row_number().over(w))
    return (ranked.join(limits, "a", "left").where(F.col("rank") <= F.coalesce("k", F.lit(k)))
                  .select("a", "b", "sim", "fresh", "rank", F.coalesce("k", F.lit(k)).alias("k")))


def _lists(graph: DataFrame) -> DataFrame:
    """(node, member, sim, fresh, rank, joined): a node's neighbours and the nodes that list it, new ones and nearest first."""
    w = Window.partitionBy("node").orderBy(F.desc("fresh"), F.desc("sim"), "member")
    forth = graph.select(F.col("a").alias("node"), F.col("b").alias("member"), "sim", "fresh", F.col("k"))
    back = graph.select(F.col("b").alias("node"), F.col("a").alias("member"), "sim", "fresh", F.lit(None).cast("int").alias("k"))
    own = Window.partitionBy("node")
    return (forth.union(back).groupBy("node", "member").agg(*[F.max(c).alias(c) for c in ("sim", "fresh", "k")])
                 .withColumn("k", F.max("k").over(own)).withColumn("rank", F.row_number().over(w)))


def _join_lists(graph: DataFrame, all_lists: DataFrame, nodes: DataFrame) -> DataFrame:
    """One refinement: pairs that meet in some node's list and include a fresh member."""
    lists = all_lists.where("joined")
    live = lists.groupBy("node").agg(F.max("fresh").alias("any")).where("any = 1").select("node")
    worst = graph.groupBy("a").agg(F.min("sim").alias("worst"), F.count("*").alias("n"), F.max("k").alias("k"))
    worst = worst.select(F.col("a").alias("member"), F.when(F.col("n") < F.col("k"), F.lit(-2.0)).otherwise(F.col("worst")).alias("worst"))
    member = (lists.join(live, "node").join(worst, "member", "left")
                   .join(nodes.select(F.col("node").alias("member"), "unit"), "member")
                   .select("node", "member", "fresh", F.coalesce("worst", F.lit(-2.0)).alias("worst"), "unit"))

    def meet(key, t):
        ids, fresh, worst = (t.column(c).to_numpy() for c in ("member", "fresh", "worst"))
        m = np.stack([np.frombuffer(u, "<f8") for u in t.column("unit").to_pylist()])
        out = []
        for lo in range(0, len(ids), BLOCK):             # a long list meets itself block against block
            for at in range(lo, len(ids), BLOCK):
                s = m[lo:lo + BLOCK] @ m[at:at + BLOCK].T
                i, j = np.triu_indices(len(s), 1) if at == lo else (x.ravel() for x in np.indices(s.shape))
                s, i, j = s[i, j], i + lo, j + at
                use = ((fresh[i] | fresh[j]) > 0) & ((s > worst[i]) | (s > worst[j]))
                out.append((ids[i[use]], ids[j[use]], s[use]))
        a, b, s = (np.concatenate(x) for x in zip(*out))
        return pa.table({"a": a, "b": b, "sim": s})

    pairs = member.groupBy("node").applyInArrow(meet, "a long, b long, sim double").groupBy("a", "b").agg(F.max("sim").alias("sim"))
    return pairs.union(pairs.select("b", "a", "sim")).groupBy("a", "b").agg(F.max("sim").alias("sim"))


def _counts(nodes: DataFrame, label_of: DataFrame, threshold: float) -> DataFrame:
    """(node, n): weight of the other nodes linked, counted exactly inside each component, block by block."""
    members = (label_of.join(nodes.select("node", "unit", "copies"), "node"))
    sizes = members.groupBy("component").agg(F.count("*").alias("size"))
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    placed = (members.join(sizes, "component").withColumn("blocks", blocks)
                     .withColumn("block", F.pmod(F.xxhash64("node", F.lit(29)), F.col("blocks")).cast("int")))
    many = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    cols = [F.col(c) for c in ("component", "block", "node", "unit", "copies")]
    left = placed.select(*cols, many.alias("other"))
    right = placed.select(*[c.alias(n) for c, n in zip(cols, ("r_component", "r_other", "r_node", "r_unit", "r_copies"))], many.alias("r_block"))

    def count(a, b):
        x = np.stack([np.frombuffer(u, "<f8") for u in a.column("unit").to_pylist()])
        ids, n = a.column("node").to_numpy(), np.zeros(len(x), np.int64)
        if b.num_rows:
            y = np.stack([np.frombuffer(u, "<f8") for u in b.column("r_unit").to_pylist()])
            other, weight = b.column("r_node").to_numpy(), b.column("r_copies").to_numpy()
            n = ((x @ y.T >= threshold) & (ids[:, None] != other[None])) @ weight
        return pa.table({"node": ids, "n": n})

    return (left.groupBy("component", "block", "other").cogroup(right.groupBy("r_component", "r_block", "r_other"))
                .applyInArrow(count, "node long, n long")
                .groupBy("node").agg(F.sum("n").alias("n")))


def near_duplicates(vectors: DataFrame, threshold: float = 0.98, k: int = 6, rounds: int = 8, least_rounds: int = 2, orders: int = 6, reach: int = 2,
                    target: float = 0.98, audit: int = 256, evidence: int = 50, audit_most: int = 16384, id_col: str = "vec_id", vector_col: str = "embedding",
                    label_col: str = "label", report: dict | None = None) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept. ``report`` receives the audited recall per round, and the true links it rests on."""
    rows = C.checkpointed(_nodes(C.pick(vectors, vec_id=id_col, label=label_col, v=vector_col)
                                 .select(F.col("vec_id").cast("long").alias("vec_id"), "label", "v")))
    linked = rows.where("unit IS NOT NULL").withColumn("node", F.xxhash64("label", "unit"))
    nodes = C.checkpointed(linked.groupBy("node", "label", "unit").agg(F.min("vec_id").alias("first"), F.count("*").alias("copies")))
    truth, n_true = _audit(nodes, audit, threshold, evidence, audit_most)

    limits = nodes.where("false").select(F.col("node").alias("a"), F.lit(k).alias("k"))
    start = _scored(_start(nodes, nodes.count(), orders, reach), nodes).withColumn("fresh", F.lit(1))
    graph = C.checkpointed(_best(start, limits, k))
    history, label_of, grown = [], None, None
    for turn in range(rounds):
        full = graph.groupBy("a").agg(F.min("sim").alias("worst"), F.count("*").alias("n"), F.max("k").alias("k"))
        limits = full.select("a", F.when((F.col("n") >= F.col("k")) & (F.col("worst") >= threshold), 2 * F.col("k"))
                                   .otherwise(F.col("k")).alias("k"))
        lists = C.checkpointed(_lists(graph).withColumn("joined", F.col("rank") <= 3 * F.coalesce("k", F.lit(k))))
        better = _join_lists(graph, lists, nodes).withColumn("fresh", F.lit(1))
        # an edge is old once both its ends have met the other's list; what a cut left out stays fresh
        left = lists.where("fresh = 1 AND NOT joined").select("node", "member")
        left = left.union(left.select("member", "node")).distinct().select(F.col("node").alias("a"), F.col("member").alias("b"), F.lit(1).alias("left"))
        old = graph.join(left, ["a", "b"], "left").select("a", "b", "sim", F.coalesce("left", F.lit(0)).alias("fresh"))
        graph = C.checkpointed(_best(better.union(old), limits, k))
        if turn + 2 < least_rounds:
            continue
        # a link counts as found if its ends share a component: there all pairs are counted below
        label_of = C.checkpointed(connected_components(graph.where(F.col("sim") >= threshold).select("a", "b")))
        before, grown = grown, (label_of.count(), label_of.select("component").distinct().count())
        if turn + 1 < least_rounds:
            continue
        ends = truth.join(label_of.withColumnsRenamed({"node": "a", "component": "ca"}), "a").join(
            label_of.withColumnsRenamed({"node": "b", "component": "cb"}), "b")
        history.append(ends.where("ca = cb").count() / n_true if n_true else None)
        if grown == before and (history[-1] is None or history[-1] >= target):
            break
    if report is not None:
        report |= {"recall": history, "true_links": n_true}
    if history[-1] is not None and history[-1] < target:
        raise RuntimeError(f"audited recall {history[-1]:.4f} of {n_true} links is below {target} after {rounds} rounds")

    counts = _counts(nodes, label_of, threshold)
    rooted = (nodes.join(label_of, "node", "left").join(counts, "node", "left")
                   .select("node", "first", F.coalesce("component", "node").alias("root"),
                           (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    found = rooted.join(smallest, "root").select("node", "n_links", "component_id")
    known = linked.select("vec_id", "node").join(found, "node").select("vec_id", "n_links", "component_id")
    alone = rows.where("unit IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return known.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
