"""SimHash near-duplicates by multi-index hashing.

1. Each whole text gets a 64-bit fingerprint: the majority bit over the XXH64
   values of its word shingles (repeats included).
2. Equal fingerprints are one node, whatever the number of copies.
3. A fingerprint is cut into m = max_bits // 2 + 1 segments, so two within
   ``max_bits`` differ by at most ``max_bits // m`` bits (0 or 1) in one of them.
   Every fingerprint is a table row under each segment value and probes the
   values in the Hamming ball around it. Of two that differ in one bit of a
   segment, the one with a 0 there probes the other.
4. Rows are dealt by (segment, value); a value that very many fingerprints share
   is cut into a grid of parts in which each pair still meets once. Where table rows meet probes, complete
   distances are verified block by block, and a spanning forest of the links is
   emitted: every link between fingerprints counts, but a group of k gives at
   most k - 1 edges.
5. Connected components over the forests; a document's component is the smallest
   document id in it.

Defined results: null or wordless text has fingerprint zero and links like any
other; null ids get their component's smallest id, or null if it holds none;
repeated rows are copies; an empty table gives no rows.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postflow.llm import common as C
from postflow.llm.components import connected_components

BLOCK = 16384         # rows of a verification block
HOT_ROWS = 1 << 16    # table rows of a bucket from which it is cut into parts


def fingerprint(text: str | None, shingle: int = 3) -> bytes:
    """Big-endian 64-bit fingerprint of a whole text."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()     # ASCII case and white space only
    if not words:
        return bytes(8)
    if len(words) <= shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    digest = xxhash.xxh64_digest
    votes, n, held = np.zeros(64, np.int64), 0, []
    for g in grams:
        held.append(digest(g, 42))
        if len(held) == 1 << 15:
            votes, n, held = votes + _bits(held), n + len(held), []
    votes, n = votes + _bits(held), n + len(held)
    return np.packbits(2 * votes > n).tobytes()


def _bits(digests: list[bytes]) -> np.ndarray:
    raw = np.frombuffer(b"".join(digests), np.uint8).reshape(-1, 8)
    return np.unpackbits(raw, axis=1).sum(axis=0, dtype=np.int64)


def with_fingerprint(df: DataFrame, text_col: str, out_col: str, shingle: int = 3) -> DataFrame:
    """``df`` with the fingerprint as a signed 64-bit integer."""
    def make():
        return lambda texts: [pa.array([int.from_bytes(fingerprint(t, shingle), "big", signed=True)
                                        for t in texts.to_pylist()], pa.int64())]
    return C.map_columns(df, [text_col], {out_col: T.LongType()}, make)


def segments(max_bits: int) -> tuple[list[tuple[int, int]], int]:
    """(shift, width) of each segment, and the ball radius."""
    m = max_bits // 2 + 1
    cuts = [64 * i // m for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])], max_bits // m


def hot_buckets(fps: DataFrame, max_bits: int) -> dict[int, int]:
    """Buckets with over HOT_ROWS table rows, and into how many parts to cut them:
    at most segments x fingerprints / HOT_ROWS entries."""
    segs, _ = segments(max_bits)
    if len(segs) == 1:                                   # a bucket is one fingerprint
        return {}
    keys = [F.shiftrightunsigned("fp", shift).bitwiseAND((1 << width) - 1).bitwiseOR(s << 32) for s, (shift, width) in enumerate(segs)]
    found = fps.select(F.explode(F.array(*keys)).alias("bucket")).groupBy("bucket").count().where(F.col("count") > HOT_ROWS).collect()
    return {r["bucket"]: min(2048, -(-r["count"] // HOT_ROWS)) for r in found}


def _spread(bucket: np.ndarray, fp: np.ndarray, probe: int, hot: dict[int, int]):
    """Rows of hot buckets go to a grid of parts (i, j): a table row is in one line i,
    a row to compare with it in one column j, so each pair meets in one part."""
    is_hot = np.isin(bucket, np.fromiter(hot, np.uint64, len(hot)))
    yield _rows(bucket[~is_hot], fp[~is_hot], probe)
    for b in np.unique(bucket[is_hot]).tolist():
        mine, n = fp[bucket == b], hot[b]
        mixed = mine * np.uint64(0x9E3779B97F4A7C15)
        line, column = (mixed >> np.uint64(33)) % np.uint64(n), (mixed >> np.uint64(12)) % np.uint64(n)
        for k in range(n):
            part = np.uint64(b) | np.uint64(k << 51) | (line << np.uint64(40))
            if probe == 0:
                yield _rows(part, mine, 0)
            yield _rows(np.uint64(b) | np.uint64(k << 40) | (column << np.uint64(51)), mine, 1)


def _table_and_probes(fps: DataFrame, max_bits: int) -> DataFrame:
    """Rows (bucket, probe, fp): each fingerprint under its own and its ball's segment values."""
    segs, radius = segments(max_bits)
    hot = hot_buckets(fps, max_bits)
    made = (lambda b, f, p: _spread(b, f, p, hot)) if hot else (lambda b, f, p: [_rows(b, f, p)])

    def run(batches):
        for whole in batches:
            for i in range(0, whole.num_rows, 20_000):
                fp = whole.slice(i, 20_000).column(0).to_numpy().view(np.uint64)
                for s, (shift, width) in enumerate(segs):
                    tag = np.uint64((s << 32) if len(segs) > 1 else 0)
                    key = (fp >> np.uint64(shift)) & np.uint64((1 << width) - 1)
                    yield from made(key | tag, fp, 0)
                    for k in range(1, radius + 1):
                        for bits in combinations(range(width), k):
                            mask = np.uint64(sum(1 << b for b in bits))
                            use = (key & mask) == 0 if k == 1 else np.ones(len(key), bool)
                            if use.any():
                                yield from made((key[use] ^ mask) | tag, fp[use], 1)
    return fps.mapInArrow(run, "bucket long, probe byte, fp long")


def _rows(bucket: np.ndarray, fp: np.ndarray, probe: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"bucket": pa.array(bucket.view(np.int64)),
                                       "probe": pa.array(np.full(len(fp), probe, np.int8)),
                                       "fp": pa.array(fp.view(np.int64))})


def forest(table: np.ndarray, probes: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of all links table x (table + probes)."""
    every = np.concatenate([table, probes])
    root = np.arange(len(every))
    edges = []
    for i, fp in enumerate(table):
        for a in range(i + 1, len(every), BLOCK):
            block = every[a:a + BLOCK]
            near = a + np.flatnonzero(np.bitwise_count(block ^ fp) <= max_bits)
            near = near[root[near] != root[i]]
            while len(near):
                j = int(near[0])
                edges.append((int(fp), int(every[j])))
                root[root == root[j]] = root[i]
                near = near[root[near] != root[i]]
    return edges


def _verified(rows: DataFrame, max_bits: int) -> DataFrame:
    def run(batches):
        held: list[np.ndarray] = []

        def done(bucket, probe, fp):
            at = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
            size = np.diff(np.r_[at, len(bucket)])
            tables = np.add.reduceat((probe == 0).astype(np.int64), at)
            edges = []
            for a, n, t in zip(*(x[(tables > 0) & (size > 1)].tolist() for x in (at, size, tables))):
                edges += forest(fp[a:a + t], fp[a + t:a + n], max_bits)
            ends = np.array(edges, np.uint64).reshape(-1, 2).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], names=["a", "b"])

        for b in batches:
            now = [b.column(0).to_numpy(), b.column(1).to_numpy(), b.column(2).to_numpy().view(np.uint64)]
            if not len(now[0]):
                continue
            if held:
                now = [np.concatenate(x) for x in zip(held, now)]
            cut = int(np.searchsorted(now[0], now[0][-1]))      # the last bucket may go on in the next batch
            if cut:
                yield done(*(x[:cut] for x in now))
            held = [x[cut:].copy() for x in now]
        if held:
            yield done(*held)

    dealt = rows.repartition(C.shuffle_parts(rows.sparkSession), "bucket").sortWithinPartitions("bucket", "probe")
    return dealt.mapInArrow(run, "a long, b long")


def components(signatures: DataFrame, max_bits: int = 3) -> DataFrame:
    """(fp, component_id) of every distinct fingerprint in ``signatures`` (doc_id, fp)."""
    nodes = C.checkpointed(signatures.groupBy("fp").agg(F.min("doc_id").alias("doc")))
    links = _verified(_table_and_probes(nodes.select("fp"), max_bits), max_bits)
    label = connected_components(links)
    rooted = nodes.join(label, nodes.fp == label.node, "left").select(
        "fp", "doc", F.coalesce("component", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("doc").alias("component_id"))
    return rooted.join(smallest, "root").select("fp", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 3,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, fingerprint (signed), component_id."""
    sig = C.checkpointed(with_fingerprint(C.pick(docs, doc_id=id_col, text=text_col), "text", "fp", shingle).drop("text"))
    return sig.join(components(sig, max_bits), "fp").select("doc_id", F.col("fp").alias("fingerprint"), "component_id")


def keep_representatives(docs: DataFrame, shingle: int = 3, max_bits: int = 3,
                         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component, that of its smallest id; all columns stay.

    A component without any id keeps one row of each fingerprint.
    """
    fp, comp = C.fresh_name(docs, "simhash_fp"), C.fresh_name(docs, "simhash_component")
    marked = with_fingerprint(docs, text_col, fp, shingle)
    sig = C.checkpointed(marked.select(C.col(id_col).alias("doc_id"), F.col(fp).alias("fp")))
    found = components(sig, max_bits).select(F.col("fp").alias(fp), F.col("component_id").alias(comp))
    mine = marked.join(found, fp).where(C.col(id_col).eqNullSafe(F.col(comp)))
    with_id = mine.where(F.col(comp).isNotNull()).dropDuplicates([comp])
    without = mine.where(F.col(comp).isNull()).dropDuplicates([fp])
    return with_id.unionByName(without).select(*[C.col(c) for c in docs.columns])
