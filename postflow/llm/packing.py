"""Packing: first-fit decreasing with a tournament tree, in randomised groups.

Documents are encoded, cut into pieces of at most ``capacity`` tokens and dealt
by a hash into groups of about ``group_docs`` documents. Each group is packed on
its own: pieces in decreasing length go to the first sequence with room, found
by descending a tournament tree over the sequences' free capacities in O(log n).
Groups are independent and bounded, so nothing depends on the size of the corpus
but the number of groups; only the last sequences of each group have padding.

The hash takes the document id, the piece's start and the input partition, so
neither a hot source nor a group of copies gathers in one group.

Defined results: a null or empty text packs as its end id alone; null ids and
repeated rows are packed like any other row; an empty table gives no rows. Equal
lengths are ordered by (doc_id, start).
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postflow.llm import common as C
from postflow.llm.tokenizing import encoder

CAPACITY = 2048
GROUP_DOCS = 4096


class TournamentTree:
    """Free capacities of bins; the root holds the largest."""

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1 << max(0, (bins - 1).bit_length())
        self.free = [capacity] * (2 * self.leaves)

    def place(self, size: int) -> tuple[int, int]:
        """Put ``size`` into the first bin with room; (bin, room left before)."""
        free, at = self.free, 1
        while at < self.leaves:
            at *= 2
            if free[at] < size:
                at += 1
        room, leaf = free[at], at
        free[at] = room - size
        while at > 1:
            at >>= 1
            best = max(free[2 * at], free[2 * at + 1])
            if free[at] == best:
                break
            free[at] = best
        return leaf - self.leaves, room


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of pieces given in decreasing length."""
    n = len(lengths)
    seq, off = np.zeros(n, np.int64), np.zeros(n, np.int64)
    full = int(np.count_nonzero(lengths >= capacity))      # they come first and fill one sequence each
    seq[:full] = np.arange(full)
    if full < n:
        tree = TournamentTree(n - full, capacity)
        for i, size in enumerate(lengths[full:].tolist(), full):
            b, room = tree.place(size)
            seq[i], off[i] = full + b, capacity - room
    return seq, off


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = CAPACITY,
                 id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False, lean: bool = False) -> DataFrame:
    """Pieces of encoded documents: doc_id, start, length, ids_crc32, doc_tokens
    (and ``ids``, little-endian unsigned 32-bit, when ``keep_ids``). ``lean``: a task leaves no tokenizer and no
    words in its worker, for jobs that run other operators too."""
    docs = C.pick(docs, doc_id=id_col, text=text_col)
    kind = docs.schema["doc_id"].dataType.simpleString()
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches):
        C.release_memory()
        enc = encoder(tokenizer)
        for whole in batches:
            for i in range(0, whole.num_rows, 1000):
                b = whole.slice(i, 1000)
                row, start, length, crc, total, ids = [], [], [], [], [], []
                for r, raw in enumerate(enc.encode(C.texts_of(b.column(1)))):
                    raw += end
                    n = len(raw) // 4
                    for a in range(0, n, capacity):
                        piece = raw[4 * a:4 * (a + capacity)]
                        row.append(r)
                        start.append(a)
                        length.append(len(piece) // 4)
                        crc.append(zlib.crc32(piece))
                        total.append(n)
                        if keep_ids:
                            ids.append(piece)
                out = [b.column(0).take(pa.array(row, pa.int64())), *(pa.array(x, pa.int64()) for x in (start, length, crc, total))]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
                if keep_ids:
                    out.append(pa.array(ids, pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(out, names=names)
        enc.trim()
        if lean:
            del enc
            C.drop_caches()
        C.release_memory()

    return docs.mapInArrow(run, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long"
                           + (", ids binary" if keep_ids else ""))


def pack_pieces(pieces: DataFrame, groups: int, capacity: int = CAPACITY, seed: int = 17) -> DataFrame:
    """``pieces`` (doc_id, start, length, any further columns) with sequence_id and offset.

    ``sequence_id`` is group * 2**31 + the sequence's number in its group;
    offsets in a sequence are gapless from 0.
    """
    pieces = pieces.drop("sequence_id", "offset")
    group = C.fresh_name(pieces, "pack_group")
    dealt = pieces.withColumn(group, F.pmod(
        F.xxhash64(F.col("doc_id"), F.col("start"), F.spark_partition_id(), F.lit(seed)), F.lit(max(1, groups))))
    names = pieces.columns

    def pack(key, t):
        C.drop_caches()
        at = pc.sort_indices(t.select(["length", "doc_id", "start"]), sort_keys=[
            ("length", "descending"), ("doc_id", "ascending"), ("start", "ascending")])
        t = t.select(names).take(at)                       # the dealing column is not copied
        seq, off = first_fit_decreasing(t.column("length").to_numpy(), capacity)
        return (t.append_column("sequence_id", pa.array(seq + (key[0].as_py() << 31), pa.int64()))
                 .append_column("offset", pa.array(off, pa.int64())))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return dealt.groupBy(group).applyInArrow(pack, f"{schema}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = CAPACITY,
                   group_docs: int = GROUP_DOCS, id_col: str = "doc_id", text_col: str = "text",
                   keep_ids: bool = False, lean: bool = False) -> DataFrame:
    """Encode and pack whole documents; one row per piece."""
    groups = -(-docs.count() // group_docs)          # row counts come from file footers
    pieces = token_pieces(docs, tokenizer, end_id, capacity, id_col, text_col, keep_ids, lean)
    return pack_pieces(pieces, groups, capacity)
