"""The pipeline's stages on edge rows, and registration."""

import public_tokenizers
import pyarrow as pa

import __spark_entry__ as E
import corpus_pipeline
from postflow.llm import langid, packing, queries, suffix_dedup, tokenizing
from tests.llm.conftest import ROWS

SF = "/root/testdata/sf0.001"


def test_registered():
    names = set(queries.queries())
    assert {n.split("_")[0] for n in names if n != "pipeline"} == {f"op{i}" for i in range(1, 14)} and "pipeline" in names
    assert names <= set(E.queries()) and corpus_pipeline.ORACLE_SQL is None
    assert len(corpus_pipeline.STAGES) == 5


def test_stages_on_edge_rows(spark, docs, no_docs, workdir):
    for name, rows in (("edge", docs), ("empty", no_docs)):
        for step, stage in corpus_pipeline.STAGES:
            out = f"{workdir}/{name}/{step}"
            made = stage(spark, rows, SF)
            if step != "packing":
                assert made.columns == docs.columns
            made.write.parquet(out)
            rows = spark.read.parquet(out)
        assert rows.columns[:7] == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids", "sequence_id"]
        assert (rows.count() > 0) == (name == "edge")


def test_run_keeps_clean_documents(spark):
    packed = corpus_pipeline.run(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    good = spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1 AND toxic = 0").select("doc_id")
    kept = {r.doc_id for r in packed.select("doc_id").distinct().collect()}
    alone = {r.doc_id for r in docs.join(good, "doc_id").dropDuplicates(["text"]).collect()}
    assert len(kept) < docs.count() and len(alone & kept) >= 0.9 * len(alone)
    assert ROWS


def test_packing_leaves_no_tokenizer_in_workers(spark, docs):
    """Workers are reused: what packing keeps would lie beside the next stage's memory, four times on an executor."""
    def encoders(clear):
        def run(batches):
            for b in batches:
                n = len(tokenizing._ENCODERS)
                if clear:
                    tokenizing._ENCODERS.clear()
                yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64())})
        return sum(r.n for r in spark.range(16, numPartitions=16).mapInArrow(run, "n long").collect())

    encoders(True)
    rows = docs.select("doc_id", "text", "lang", "source", "n_chars")
    assert corpus_pipeline.pack(spark, rows, "").collect()
    assert encoders(False) == 0
    packing.token_pieces(rows, public_tokenizers.path("word_bpe_49k.json")).collect()       # kept by default
    assert encoders(False) > 0
    langid.predict(rows.repartition(16), langid.ByteCNN(["en", "fr"])).collect()
    assert encoders(False) == 0


def test_one_python_worker_a_core(spark, docs):
    """Python steps that follow each other in a stage hold a worker each, so what workers hold adds up beside the heap."""
    rows = docs.select("doc_id", "text", "lang", "source", "n_chars")
    made = corpus_pipeline.passage_dedup(spark, rows, "")
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "MapInArrow" not in plan.replace("FlatMapCoGroupsInArrow", "").replace("FlatMapGroupsInArrow", "")
    found, at = suffix_dedup.remove_repeats(rows)
    key = lambda x: (x[0], x[1] or "")
    assert sorted(((r.doc_id if r.doc_id is not None else -1, r.text) for r in made.collect()), key=key) == sorted(
        ((r.doc_id if r.doc_id is not None else -1, None if r.text is None else bytes(r[at["kept"]]).decode("utf-8", "ignore"))
         for r in found.collect()), key=key)
