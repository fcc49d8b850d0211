"""Sharding by vector bin packing: bytes, tokens and rows balanced jointly.

Documents of equal text form a group, and a group goes to one shard unless it is more
than a shard's share or no shard has room for it. Groups are placed in decreasing order
of their largest component; each goes, among the shards that still have room for its
bytes, to the one where the dot product of its vector (bytes, tokens, rows) with the
shard's residual capacity is highest. The vectors are in units of a shard's share, so
the three count alike. A few small moves then even out the bytes.

* Heavy groups, over 1/``HEAVY`` of a shard's share in bytes, tokens or rows, are at
  most 3 x ``HEAVY`` x shards, whatever the table's size. They are placed first, on the
  driver, from (digest, sums) alone. One that fits nowhere whole is cut: its rows
  fill shards in turn, so a text that is a third of the table spreads over many.
* All other groups are dealt by hash into blocks of about ``BLOCK_GROUPS`` groups.
  A block packs its own groups against its part of the capacity left by the heavy
  ones, so blocks are independent and bounded.

Rows are numbered where they lie: a narrow table (no texts) is written once, its
files' parts count rows by shard, prefix sums over the parts give each part's first
number, and a window inside (shard, part) gives the rest. No key holds more rows than
a part, and the same numbering deals the rows of a cut group.

Defined results: a null text has size 1 and its own group; an empty text too. Null
ids and repeated rows are rows like any other; an empty table gives no rows; other
columns are not read. A shard may stay empty where there are fewer rows than shards.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postflow.llm import common as C

SHARDS = 16
HEAVY = 1024
BLOCK_GROUPS = 4096
WORD = r"[^\x20\x09-\x0D]+"
DIMS = ("bytes", "tokens", "rows")


def place_groups(groups: np.ndarray, residual: np.ndarray) -> np.ndarray:
    """Shard of each group; ``groups`` (n x dims, in placing order) are taken off ``residual``
    (shards x dims, changed in place), both in units of a shard's share.

    Residuals count as shares of what is left over all shards, so differences weigh more as
    the shards fill. A group that no shard has room for goes to the one with the most room.
    """
    out = np.empty(len(groups), np.int64)
    left = residual.sum(axis=0)
    for i, g in enumerate(groups):
        score = residual @ (g / np.maximum(left, 1e-9))
        left -= g
        room = residual[:, 0] >= g[0]
        best = int(np.argmax(np.where(room, score, -np.inf))) if room.any() else int(np.argmax(residual[:, 0]))
        residual[best] -= g
        out[i] = best
    return out


def even_out(groups: np.ndarray, placed: np.ndarray, residual: np.ndarray) -> None:
    """Move groups from the fullest shard to the emptiest, each the one nearest to half their difference in
    bytes, while that brings them closer; at most 8 moves a shard."""
    for _ in range(8 * len(residual)):
        full, bare = int(np.argmin(residual[:, 0])), int(np.argmax(residual[:, 0]))
        gap = residual[bare, 0] - residual[full, 0]
        own = np.flatnonzero((placed == full) & (groups[:, 0] < gap))
        if not len(own):
            return
        move = own[np.argmin(np.abs(groups[own, 0] - gap / 2))]
        placed[move] = bare
        residual[full] += groups[move]
        residual[bare] -= groups[move]


def place_heavy(groups: np.ndarray, rows: np.ndarray, residual: np.ndarray) -> list[list[tuple[int, int]]]:
    """[(shard, rows)] of each group in placing order; one that fits nowhere whole is cut by rows."""
    out = []
    for g, n in zip(groups, rows.tolist()):
        if n == 1 or (g.max() <= 1 and (residual[:, 0] >= g[0]).any()):
            out.append([(int(place_groups(g[None], residual)[0]), n)])
            continue
        one, left, taken = g / n, n, np.zeros(len(residual), np.int64)
        for dims in (slice(None), slice(0, 1)):               # room in everything first, then in bytes
            for s in np.argsort(-residual[:, 0], kind="stable").tolist():
                most = np.min(residual[s, dims][one[dims] > 0] / one[dims][one[dims] > 0])
                take = min(left, max(0, int(most)))
                residual[s] -= one * take
                taken[s] += take
                left -= take
        for _ in range(left):                     # no shard has room for one more row; fewer rows than shards are left
            s = int(np.argmax(residual[:, 0]))
            residual[s] -= one
            taken[s] += 1
        out.append([(s, t) for s, t in enumerate(taken.tolist()) if t])
    whole = [i for i, p in enumerate(out) if len(p) == 1]
    placed = np.array([out[i][0][0] for i in whole], np.int64)
    even_out(groups[whole], placed, residual)
    for i, s in zip(whole, placed.tolist()):
        out[i] = [(s, out[i][0][1])]
    return out


def number_rows(rows: DataFrame, key: str, out: str) -> DataFrame:
    """``rows`` (with ``part`` and ``row``) numbered gapless from 0 within ``key``, in the order of (part, row)."""
    counts = rows.groupBy(key, "part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select(key, "part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    own = F.row_number().over(Window.partitionBy(key, "part").orderBy("row")) - 1
    return (rows.withColumn("_own", own).join(first, [key, "part"])
                .withColumn(out, F.col("_first") + F.col("_own")).drop("_first", "_own"))


def measured_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokens: Column | None = None) -> DataFrame:
    """The narrow table, written once: doc_id, size, text_crc32, n_tokens, digest, part, row."""
    spark = docs.sparkSession
    rows = docs.select(C.col(id_col).alias("doc_id"), C.col(text_col).alias("text"),
                       *([tokens.cast("long").alias("n_tokens")] if tokens is not None else []))
    text = F.coalesce("text", F.lit(""))
    count = F.coalesce("n_tokens", F.lit(0)) if tokens is not None else F.regexp_count(text, F.lit(WORD)).cast("long")
    out = C.shared_uri(spark, "sharding")
    rows.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        count.alias("n_tokens"), F.when(F.col("text").isNull(), F.lit(b"")).otherwise(F.unhex(F.md5(F.encode(text, "UTF-8")))).alias("digest"),
        F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("row")).write.parquet(out)
    return spark.read.parquet(out)


def balanced_shards(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text",
                    tokens: Column | None = None, heavy: int = HEAVY, block_groups: int = BLOCK_GROUPS) -> DataFrame:
    """doc_id, size, text_crc32, n_tokens, shard, slot of every row of ``docs``; ``tokens`` defaults to
    the number of words."""
    spark = docs.sparkSession
    rows = measured_rows(docs, id_col, text_col, tokens)
    groups = rows.groupBy("digest").agg(F.sum("size").alias("bytes"), F.sum("n_tokens").alias("tokens"),
                                        F.count(F.lit(1)).alias("rows"))
    all_rows = rows.agg(F.sum("size"), F.sum("n_tokens"), F.count(F.lit(1)), F.countDistinct(F.xxhash64("digest"))).first()
    share = np.maximum(np.array([x or 0 for x in all_rows[:3]], float) / shards, 1e-9)
    blocks = max(1, -(-int(all_rows[3]) // block_groups))

    is_heavy = F.lit(False)
    for c, s in zip(DIMS, share.tolist()):
        is_heavy = is_heavy | (F.col(c) * heavy > s)
    residual = np.ones((shards, len(DIMS)))
    big = groups.where(is_heavy).collect()                    # 3 * heavy * shards rows at most
    big.sort(key=lambda r: (-max(r[c] / s for c, s in zip(DIMS, share.tolist())), bytes(r["digest"])))
    sizes = np.array([[r[c] for c in DIMS] for r in big], float).reshape(-1, len(DIMS)) / share
    parts = place_heavy(sizes, np.array([r["rows"] for r in big], np.int64), residual)

    room = np.maximum(residual, 0)
    whole = np.maximum(room.sum(axis=0), 1e-9)
    part_of = room / whole                                    # each shard's part of what a block holds

    def pack(key, t):
        t = t.sort_by("digest")
        own = np.stack([t.column(c).to_numpy().astype(float) for c in DIMS], axis=1) / share
        order = np.argsort(-own.max(axis=1), kind="stable")
        t, own = t.take(pa.array(order)), own[order]
        turn = int(key[0].as_py()) % shards                   # ties fall on another shard in each block
        capacity = np.roll(part_of * own.sum(axis=0), -turn, axis=0)
        placed = place_groups(own, capacity)
        even_out(own, placed, capacity)
        return pa.table({"digest": t.column("digest"), "shard": pa.array((placed + turn) % shards, pa.int32())})

    block = F.pmod(F.xxhash64("digest"), F.lit(blocks)).alias("block")
    light = groups.where(~is_heavy).withColumn("block", block).groupBy("block").applyInArrow(pack, "digest binary, shard int")

    one = [(bytes(r["digest"]), p[0][0]) for r, p in zip(big, parts) if len(p) == 1]
    cut = [(bytes(r["digest"]), s, a, a + n) for r, p in zip(big, parts) if len(p) > 1
           for (s, n), a in zip(p, np.cumsum([0] + [n for _, n in p[:-1]]).tolist())]
    big_ids = spark.createDataFrame([(d, None if len(p) > 1 else p[0][0], len(p) > 1) for d, p in
                                     ((bytes(r["digest"]), p) for r, p in zip(big, parts))], "digest binary, heavy_shard int, cut boolean")
    known = rows.join(F.broadcast(big_ids), "digest", "left")           # bounded: 3 * heavy * shards rows at most
    placed = known.where("cut IS NULL").drop("heavy_shard", "cut").join(light, "digest")
    if one:
        placed = placed.unionByName(known.where("NOT cut").withColumn("shard", F.col("heavy_shard")).drop("heavy_shard", "cut"))
    if cut:
        ranges = spark.createDataFrame(cut, "digest binary, shard int, lo long, hi long")   # shards rows a cut group
        dealt = number_rows(known.where("cut").drop("heavy_shard", "cut"), "digest", "_nth").alias("r")
        hit = (F.col("r.digest") == F.col("p.digest")) & (F.col("_nth") >= F.col("p.lo")) & (F.col("_nth") < F.col("p.hi"))
        placed = placed.unionByName(dealt.join(F.broadcast(ranges).alias("p"), hit).select("r.*", "p.shard").drop("_nth"))
    done = number_rows(placed.select("doc_id", "size", "text_crc32", "n_tokens", "shard", "part", "row"), "shard", "slot")
    return done.select("doc_id", "size", "text_crc32", "n_tokens", "shard", "slot")
