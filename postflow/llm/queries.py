"""The registered queries ``opN_<name>`` and ``pipeline``.

Each query applies one operator with production parameters to its whole table
and derives the digest columns from the operator's output. None of them has
DuckDB SQL: tests hold them against brute force, exact round trips or held-out
rows (``tests/llm``).
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postflow.llm import (
    alignment, bpe, conversations, hpy, langid, nn_descent, packing, quality, sharding, simhash, suffix_dedup, token_files, topk,
)
from postflow.llm import common as C

Query = Callable[[SparkSession, str], DataFrame]


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(C.table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1)


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(C.table(spark, sf_dir, "documents"), shingle=3, max_bits=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def trusted_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents labelled good and not toxic."""
    return C.table(spark, sf_dir, "labels").where("quality = 1 AND toxic = 0").select("doc_id")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return quality.classify(docs, trusted_ids(spark, sf_dir)).drop("text")


def op4_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nn_descent.near_duplicates(C.table(spark, sf_dir, "embeddings"), threshold=0.98)


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = topk.make_blocks(C.table(spark, sf_dir, "embeddings"), scale=256)
    return topk.top_k(blocks, k=5, query_every=50)


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, at = suffix_dedup.remove_repeats(C.table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", at["n_bytes"], at["n_removed"], at["n_spans"], F.sha2(at["kept"], 256).alias("kept_sha256"))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    docs = C.table(spark, sf_dir, "documents").select("doc_id", "text")
    ids = bpe.encode_texts(docs, path, pattern).select("doc_id", "ids")
    both = bpe.decode_ids(ids, path, pattern)
    text = F.array_join(F.col("ids").cast("array<string>"), " ")
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(text, 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


def op8_hpy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hpy.score_documents(C.table(spark, sf_dir, "documents"), folds=7, held=2)


def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents")
    learn = langid.learns(F.col("doc_id"), folds=4, held=2)
    net = langid.train(docs, learn)
    held = langid.held_out(F.col("doc_id"), folds=4, held=2).alias("held_out")
    return langid.predict(docs.select("doc_id", "text", held), net).drop("text")


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = C.shared_uri(spark, "tokens")
    manifest = token_files.write_token_files(C.table(spark, sf_dir, "documents"),
                                             public_tokenizers.path("byte_bpe_50k.json"), out, end_id=2)
    return (token_files.read_documents(spark, out, manifest)
            .select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")))


def op11_role_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = C.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    report = conversations.repair_report(conversations.damage(rows))
    return conversations.all_conversations(rows, report)


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, _ = alignment.align_documents(C.table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                        public_tokenizers.path("piece_bpe_32k.model"))
    return docs.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.balanced_shards(C.table(spark, sf_dir, "documents"), shards=16)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "n_tokens")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Query] = {f.__name__: f for f in (op1_packing, op2_simhash, op3_quality, op4_nn_descent, op5_topk, op6_suffix_dedup, op7_byte_bpe, op8_hpy, op9_langid, op10_token_files, op11_role_repair, op12_alignment,
                                              op13_sharding, pipeline)}
ORACLE_SQL: dict[str, str] = {}


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
