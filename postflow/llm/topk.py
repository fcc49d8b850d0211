"""Exact top-k inner products with block-at-a-time pruning.

Vectors of small integers are sorted by id and cut into document-range blocks.
A block keeps its vectors as one matrix (its forward index) and, per term
(dimension), the largest and smallest value. For a query the sum over terms of
its weight times the fitting extreme bounds every score of the block. Blocks are
visited in decreasing bound; scoring stops when the bound falls below the k-th
score so far (equal bounds are still visited: ties go to the smaller id).

The query set meets all rows in blocks: groups of query blocks x shards of
candidate blocks, each pair one bounded task, then the k best of the shards'
best per query. Queries and candidates are the same checkpointed block table.

Defined results: vectors that are null, empty, or hold null or non-finite
components, and rows with a null id, take no part; only vectors of a query's
length are its candidates; a repeated row is a candidate of its twin, and each
asks on its own; fewer than k candidates give fewer rows. Scores are exact while
they fit in 64 bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postflow.llm import common as C

BLOCK_ROWS = 1024
SHARD_BLOCKS = 32        # candidate blocks of one task
QUERY_BLOCKS = 32        # blocks whose queries one task asks


def quantise(vector: list | None, scale: int = 256) -> np.ndarray | None:
    """floor(scale * x) of each component in double precision; None if it takes no part."""
    if not vector or any(x is None for x in vector):
        return None
    v = np.asarray(vector, np.float64)
    return np.floor(scale * v).astype(np.int64) if np.isfinite(v).all() else None


def make_blocks(vectors: DataFrame, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Block table: block, dim, ids, matrix, high, low (64-bit integers as bytes)."""
    rows = C.pick(vectors, vec_id=id_col, v=vector_col).select(F.col("vec_id").cast("long").alias("vec_id"), "v").where("vec_id IS NOT NULL")
    ranged = rows.repartitionByRange(C.shuffle_parts(rows.sparkSession), "vec_id").sortWithinPartitions("vec_id", "v")

    def run(batches):
        part, seq = TaskContext.get().partitionId(), 0
        held: dict[int, tuple[list, list]] = {}

        def emit(dim):
            nonlocal seq
            ids, vecs = held.pop(dim)
            m = np.stack(vecs)
            seq += 1
            return pa.RecordBatch.from_pydict({
                "block": pa.array([(part << 32) | seq], pa.int64()), "dim": pa.array([dim], pa.int32()),
                **{k: pa.array([x.astype("<i8").tobytes()], pa.binary()) for k, x in (
                    ("ids", np.array(ids, np.int64)), ("matrix", m), ("high", m.max(0)), ("low", m.min(0)))}})

        for b in batches:
            for vec_id, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                q = quantise(v, scale)
                if q is None:
                    continue
                ids, vecs = held.setdefault(len(q), ([], []))
                ids.append(vec_id)
                vecs.append(q)
                if len(ids) == BLOCK_ROWS:
                    yield emit(len(q))
        for dim in list(held):
            yield emit(dim)

    made = ranged.mapInArrow(run, "block long, dim int, ids binary, matrix binary, high binary, low binary")
    return C.checkpointed(made)


def _products(q: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Exact q @ m.T: in doubles while every sum stays below 2**53."""
    top = float(np.abs(q).max(initial=0)) * float(np.abs(m).max(initial=0)) * q.shape[1]
    if top < 2.0 ** 53:
        return np.rint(q.astype(np.float64) @ m.T.astype(np.float64)).astype(np.int64)
    return q @ m.T


def best_of_blocks(q: np.ndarray, q_keys: np.ndarray, blocks: list[dict], k: int) -> tuple[list, int]:
    """Per query the k best (score, id) over ``blocks``; also the number of block visits."""
    high, low = np.stack([b["high"] for b in blocks]), np.stack([b["low"] for b in blocks])
    bound = _products(np.maximum(q, 0), high) + _products(np.minimum(q, 0), low)
    order = np.argsort(-bound, axis=1, kind="stable")
    best_s = [np.empty(0, np.int64)] * len(q)
    best_i = [np.empty(0, np.int64)] * len(q)
    kth = np.full(len(q), np.iinfo(np.int64).min)
    visits = 0
    active = np.arange(len(q))
    for r in range(len(blocks)):
        mine = order[active, r]
        go = bound[active, mine] >= kth[active]          # bounds only fall from here on
        active, mine = active[go], mine[go]
        if not len(active):
            break
        for b in np.unique(mine):
            rows = active[mine == b]
            block = blocks[b]
            scores = _products(q[rows], block["matrix"])
            visits += len(rows)
            own = q_keys[rows, 0] == block["block"]
            for j, row in enumerate(rows):
                s, ids = scores[j], block["ids"]
                if own[j]:
                    s, ids = np.delete(s, q_keys[row, 1]), np.delete(ids, q_keys[row, 1])
                if len(s) > k:
                    cut = np.partition(s, len(s) - k)[len(s) - k]
                    use = s >= max(cut, kth[row])
                    s, ids = s[use], ids[use]
                s, ids = np.concatenate([best_s[row], s]), np.concatenate([best_i[row], ids])
                top = np.lexsort((ids, -s))[:k]
                best_s[row], best_i[row] = s[top], ids[top]
                if len(top) == k:
                    kth[row] = s[top[-1]]
    return list(zip(best_s, best_i)), visits


def _ints(raw, dim: int | None = None) -> np.ndarray:
    a = np.frombuffer(raw, "<i8")
    return a if dim is None else a.reshape(-1, dim)


def top_k(blocks: DataFrame, k: int = 5, query_every: int = 50) -> DataFrame:
    """query_id, rank, vec_id, score: the queries are the rows whose id is divisible by ``query_every``."""
    n_blocks = blocks.count()
    numbered = blocks.withColumn("no", F.row_number().over(Window.orderBy("block")) - 1)      # one row per block
    place = C.checkpointed(numbered.select("block", (F.col("no") / SHARD_BLOCKS).cast("int").alias("shard"),
                                           (F.col("no") / QUERY_BLOCKS).cast("int").alias("team")))
    shards, teams = -(-n_blocks // SHARD_BLOCKS), -(-n_blocks // QUERY_BLOCKS)

    def ask(batches):
        for b in batches:
            for block, dim, ids, matrix, team in zip(*(c.to_pylist() for c in b.columns)):
                ids, m = _ints(ids), _ints(matrix, dim)
                at = np.flatnonzero(ids % query_every == 0)
                if len(at):
                    yield pa.RecordBatch.from_pydict({
                        "team": pa.array([team], pa.int32()), "dim": pa.array([dim], pa.int32()), "block": pa.array([block], pa.int64()),
                        "at": pa.array([at.astype("<i8").tobytes()], pa.binary()), "ids": pa.array([ids[at].tobytes()], pa.binary()),
                        "matrix": pa.array([m[at].tobytes()], pa.binary())})

    asked = (blocks.join(place, "block").select("block", "dim", "ids", "matrix", "team")
                   .mapInArrow(ask, "team int, dim int, block long, at binary, ids binary, matrix binary")
                   .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(max(0, shards - 1))))))
    given = (blocks.join(place.drop("team"), "block")
                   .withColumn("team", F.explode(F.sequence(F.lit(0), F.lit(max(0, teams - 1))))))

    def meet(queries, candidates):
        out = {"q_block": [], "q_at": [], "query_id": [], "vec_id": [], "score": []}
        cand = candidates.to_pylist()
        for dim in {c["dim"] for c in cand}:
            own = [{"block": c["block"], "ids": _ints(c["ids"]), "matrix": _ints(c["matrix"], dim), "high": _ints(c["high"]),
                    "low": _ints(c["low"])} for c in cand if c["dim"] == dim]
            mine = [x for x in queries.to_pylist() if x["dim"] == dim]
            if not mine:
                continue
            q = np.concatenate([_ints(x["matrix"], dim) for x in mine])
            keys = np.concatenate([np.stack([np.full(len(x["at"]) // 8, x["block"]), _ints(x["at"])], axis=1) for x in mine])
            ids = np.concatenate([_ints(x["ids"]) for x in mine])
            for key, qid, (s, i) in zip(keys.tolist(), ids.tolist(), best_of_blocks(q, keys, own, k)[0]):
                out["q_block"] += [key[0]] * len(s)
                out["q_at"] += [key[1]] * len(s)
                out["query_id"] += [qid] * len(s)
                out["vec_id"] += i.tolist()
                out["score"] += s.tolist()
        return pa.table({n: pa.array(v, pa.int64()) for n, v in out.items()})

    part = (asked.groupBy("team", "shard").cogroup(given.groupBy("team", "shard"))
                 .applyInArrow(meet, "q_block long, q_at long, query_id long, vec_id long, score long"))
    best = Window.partitionBy("q_block", "q_at").orderBy(F.desc("score"), "vec_id")
    return (part.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
                .select("query_id", "rank", "vec_id", "score"))
