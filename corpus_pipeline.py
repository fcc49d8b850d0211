"""Corpus pipeline: five stages from raw documents to packed token sequences.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame. Each stage works on all rows its predecessor kept and is
written as Parquet and read again before the next one. All but the last return
the columns of ``documents``.

* language_id: rejects texts that are null or have no letter, and those whose
  predicted language has a probability under ``MIN_LANGUAGE_SCORE``.
* quality: rejects texts whose perplexity is above their language's threshold.
* simhash: keeps, of each near-duplicate component, the row of the smallest id.
* suffix_dedup: removes byte passages that repeat an earlier document; a
  character that loses a byte goes whole, ``n_chars`` follows the new text, and a
  document that loses all its text stays as an empty one.
* packing: one row per piece, packed into sequences of 2048 tokens, with its ids.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postflow.llm import common as C
from postflow.llm import langid, packing, quality, simhash, suffix_dedup
from postflow.llm.queries import trusted_ids

MIN_LANGUAGE_SCORE = 0.35
ORACLE_SQL = None      # no stage but the cuts is expressible in SQL; tests use brute force


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    net = langid.train(docs, langid.learns(F.col("doc_id")))
    lang, score = C.fresh_name(docs, "lang_pred"), C.fresh_name(docs, "lang_score")
    found = langid.predict(docs, net, lang_out=lang, score_out=score)
    return found.where((F.col(lang) != langid.UNKNOWN) & (F.col(score) >= MIN_LANGUAGE_SCORE)).drop(lang, score)


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ppl, limit, kept = (C.fresh_name(docs, n) for n in ("perplexity", "threshold", "kept"))
    found = quality.classify(docs, trusted_ids(spark, sf_dir), ppl_out=ppl, limit_out=limit, kept_out=kept)
    return found.where(F.col(kept)).drop(ppl, limit, kept)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_representatives(docs, shingle=3, max_bits=3)


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found, at = suffix_dedup.remove_repeats(docs, whole_characters=True)
    cut = found.withColumn("text", F.when(F.col("text").isNotNull(), C.col(at["kept"])))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        cut = cut.withColumn("n_chars", F.when(F.col(at["n_removed"]) > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return cut.select(*[C.col(c) for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1, keep_ids=True, lean=True)


STAGES = [
    ("language_id", language_id),
    ("quality", quality_filter),
    ("simhash", near_dedup),
    ("suffix_dedup", passage_dedup),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written below the shared folder and read again."""
    docs = C.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        out = C.shared_uri(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
