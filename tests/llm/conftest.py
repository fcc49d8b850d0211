import pytest
from pyspark.sql import types as T

LONG = "wörd übung " * 9000 + "x" * 30000                # very long, partly one word
SHARED = "this passage of well over fifty bytes stands in several documents of the table, "
ROWS = [
    (0, "The cat sat on the mat and then it sat on the hat of the man.", "en"),
    (1, "The cat sat on the mat and then it sat on the hat of the man.", "en"),
    (2, None, "en"),
    (3, "", None),
    (4, "  \n\t ", "fr"),
    (5, LONG, "de"),
    (6, SHARED + "alpha beta gamma", "en"),
    (7, "delta epsilon " + SHARED + "zeta eta", "en"),
    (8, "日本語のテキスト 123 !!! 'll 're", "ja"),
    (9, "a", "en"),
    (10, "THE CAT SAT ON THE MAT AND THEN IT SAT ON THE HAT OF THE MAN.", "en"),
    (11, "l'été à la plage est très long et la mer est belle pour tous les enfants", "fr"),
    (11, "l'été à la plage est très long et la mer est belle pour tous les enfants", "fr"),
    (None, "a text without an id that is long enough to be " + SHARED, "en"),
    (12, SHARED + SHARED + "\x00 nul \x01", "en"),
]
# extra columns whose names the operators use themselves
EXTRA = ["ids", "kept", "fp", "component", "start", "perplexity", "chunk_id", "bucket", "n_bytes", "simhash_fp", "lang_pred", "decoded"]


@pytest.fixture(scope="session")
def docs(spark):
    rows = [(*r, "src0", len(r[1] or ""), *["x"] * len(EXTRA)) for r in ROWS]
    schema = T.StructType([T.StructField("doc_id", T.LongType()), *[T.StructField(c, T.StringType()) for c in ("text", "lang", "source")],
                           T.StructField("n_chars", T.LongType()), *[T.StructField(c, T.StringType()) for c in EXTRA]])
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.where("false")


@pytest.fixture(scope="session", autouse=True)
def warehouse(spark, tmp_path_factory):
    yield
