"""Hot keys: a key holding a third of the rows on either side of the ind join."""

from contextlib import contextmanager

from pyspark.sql import functions as F

from postflow.operators.joins import left_join

N = 30000
SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@contextmanager
def conf(spark, values):
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot(spark, n=N, hot_key=7, name="v"):
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(hot_key)).otherwise(F.col("id")).cast("int").alias("ind"),
        F.col("id").alias(name))


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().executedPlan().toString()


def test_hot_key_on_posts_side_is_split_by_aqe(spark):
    with conf(spark, SKEW_CONF):
        right = spark.range(N).select(F.col("id").cast("int").alias("ind"), (F.col("id") * 2).alias("w"))
        j = left_join(hot(spark), right, "ind")
        assert "SortMergeJoin(skew=true)" in final_plan(j)
        assert j.where("ind = 7").count() == N // 3 + 1 and j.count() == N   # ids 0,3,6,... and 7


def test_hot_key_on_right_side_is_salted(spark):
    with conf(spark, SKEW_CONF):
        left = spark.range(100).select(F.col("id").cast("int").alias("ind"), F.col("id").alias("a"))
        right = hot(spark, name="b")
        plain = left_join(left, right, "ind")
        salted = left_join(left, right, "ind", skew="salt", hot_rows=1000, buckets=16)
        plan = final_plan(salted)
        assert "explode" in plan.lower()                  # hot rows went through the salted join
        assert salted.where("ind = 7").count() == N // 3 + 1
        assert sorted(map(tuple, salted.collect())) == sorted(map(tuple, plain.collect()))


def test_dedup_merges_copies_before_the_shuffle(spark):
    """A third of the rows are copies of one record: the dedup aggregate runs a
    map-side step before its exchange, so the copies leave each task once."""
    from postflow.operators.clean import clean_posts
    from postflow.schemas import POSTS_RAW
    copy = (1, "u1", "t", "d", "p", "12k", "a", "image", "s", 1, "Local save in /x", "c")
    rows = [copy] * 300 + [(i, f"u{i}", "t", "d", "p", "5", "a", "image", "s", 1, "x", "c") for i in range(2, 602)]
    out = clean_posts(spark.createDataFrame(rows, POSTS_RAW))
    plan = final_plan(out)
    agg_lines = [i for i, line in enumerate(plan.splitlines()) if "HashAggregate" in line]
    exch_lines = [i for i, line in enumerate(plan.splitlines()) if "Exchange hashpartitioning" in line]
    assert len(agg_lines) >= 2 and any(agg_lines[0] < e < agg_lines[-1] for e in exch_lines)
    assert out.count() == 601


def test_top_per_group_limits_before_the_shuffle(spark):
    from postflow.operators.ranking import top_per_group
    df = hot(spark).select(F.when(F.col("ind") == 7, "hot").otherwise("cold").alias("g"), "v")
    top = top_per_group(df, ["g"], "v")
    plan = final_plan(top)
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert sorted((r.g, r.v) for r in top.collect()) == [("cold", N - 1), ("hot", N - 3)]


def test_questions_with_every_key_salted(spark):
    """The questions give the same answers when every ind goes through the salted join."""
    from postflow.operators.joins import Salt
    from postflow.plans import catalog as C
    from postflow.plans import questions as Q
    sf = "/root/testdata/sf0.001"
    p, g, u = C.posts(spark, sf), C.geo(spark, sf), C.users(spark, sf)
    salt = Salt(hot_rows=0, buckets=4)
    pairs = [
        (Q.top_category_by_country(p, g), Q.top_category_by_country(p, g, skew=salt)),
        (Q.top_poster_by_country(p, g), Q.top_poster_by_country(p, g, skew=salt)),
        (Q.median_followers_by_age(p, u), Q.median_followers_by_age(p, u, skew=salt)),
        (Q.joined_per_year(p, u, (1996, 2000)), Q.joined_per_year(p, u, (1996, 2000), skew=salt)),
    ]
    for plain, salted in pairs:
        assert sorted(map(tuple, plain.collect()), key=repr) == sorted(map(tuple, salted.collect()), key=repr)
