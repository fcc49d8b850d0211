"""Property tests: batch clean = stream clean, idempotence,
encode -> decode identity."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from postflow.functions.cleaning import null_if_matches, POSTS_PLACEHOLDERS
from postflow.functions.envelope import decode_json, encode_stream, stream_schema
from postflow.operators.clean import clean_posts
from postflow.schemas import POSTS_RAW, POSTS_STREAM
from postflow.streaming.pipeline import clean_records, to_records

SETTINGS = settings(max_examples=10, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

text = st.text(alphabet=st.characters(blacklist_categories=("Cs",)), max_size=12)
counts = st.one_of(st.none(), st.sampled_from(["12k", "3M", "987", "User Info Error", "1.2k", "x"]),
                   st.integers(0, 10 ** 6).map(str))
rows = st.lists(st.tuples(
    st.integers(0, 50), text, st.one_of(st.none(), st.sampled_from(["", "No Title Data Available", "T"])),
    st.one_of(st.none(), text), text, counts, st.one_of(st.none(), st.sampled_from(["a,b,,", "x", ""])),
    st.sampled_from(["image", "video"]), text, st.sampled_from([0, 1]),
    st.one_of(st.none(), text.map(lambda s: "Local save in " + s)), text), max_size=25)


@SETTINGS
@given(data=rows)
def test_batch_clean_equals_stream_clean(spark, data):
    raw = spark.createDataFrame(data, POSTS_RAW)
    batch = clean_posts(raw, dedup="none")
    typed = raw.withColumn("index", F.col("index").cast("int"))
    stream_rows = clean_records(to_records(typed, "posts-stream"), "posts")
    assert sorted(map(tuple, batch.collect()), key=repr) == sorted(map(tuple, stream_rows.collect()), key=repr)


@SETTINGS
@given(values=st.lists(st.one_of(st.none(), text), max_size=20))
def test_placeholder_nulling_idempotent(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    pattern = POSTS_PLACEHOLDERS["description"]
    once = df.select(null_if_matches(F.col("s"), pattern).alias("s"))
    twice = once.select(null_if_matches(F.col("s"), pattern).alias("s"))
    assert [r.s for r in once.collect()] == [r.s for r in twice.collect()]


@SETTINGS
@given(data=st.lists(st.tuples(st.one_of(st.none(), st.integers(-2 ** 31, 2 ** 31 - 1)), text, text),
                     max_size=20))
def test_encode_decode_identity(spark, data):
    df = spark.createDataFrame(data, "index int, title string, category string")
    env = df.select(encode_stream(df, "s").alias("body"))
    back = decode_json(env, stream_schema(POSTS_STREAM), "body").select("Data.*") \
        .select("index", "title", "category")
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(map(tuple, df.collect()), key=repr)


@SETTINGS
@given(values=st.lists(st.one_of(st.none(), st.text(alphabet="0123456789+-. eE_kx٣", max_size=14),
                                 st.integers(-2 ** 40, 2 ** 40).map(str)), max_size=40))
def test_text_to_int_fast_path_equals_decimal_route(spark, values):
    from postflow.functions.cleaning import text_to_int
    df = spark.createDataFrame([(v,) for v in values], "s string")
    out = df.select(text_to_int(F.col("s")).alias("a"),
                    F.col("s").try_cast("decimal(38,10)").try_cast("int").alias("b")).collect()
    assert all(r.a == r.b for r in out)
