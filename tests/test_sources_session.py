"""Sources, sinks, session helpers, sampling and stored tables."""

import os

import pytest
from pyspark.sql import functions as F

from postflow.operators.clean import drop_identical_records
from postflow.operators.sampling import draw_count, draw_thresholds, replay_sample
from postflow.schemas import POSTS_RAW, conform
from postflow import session
from postflow.session import apply_sizing, build_session, checkpoint_root, folder_bytes, path_bytes, shared_dir, sizing
from postflow.sources.files import read_table, read_topic, write_topic
from postflow.sources.tables import load_clean, store_clean


def test_topic_roundtrip_with_partitions(spark, workdir):
    rows = [(1, "u1", "t", "d", "p", "12k", "a,b", "image", "s", 1, "Local save in /x", "c"),
            (2, "u2", "t", "d", "p", "3", "a", "video", "s", 0, "Local save in /y", "c")]
    df = spark.createDataFrame(rows, POSTS_RAW).withColumn("partition", F.lit(0))
    write_topic(df, f"{workdir}/posts", partition_col="partition")
    assert os.path.isdir(f"{workdir}/posts/partition=0")
    back = read_topic(spark, f"{workdir}/posts", schema=POSTS_RAW)
    assert "partition" in back.columns            # discovered from the folder layout
    assert sorted(r["index"] for r in back.collect()) == [1, 2]
    inferred = read_topic(spark, f"{workdir}/posts", infer=True)
    assert dict(inferred.dtypes)["index"] == "bigint"


def test_read_topic_malformed_line(spark, workdir):
    path = f"{workdir}/geo"
    os.makedirs(path)
    with open(f"{path}/a.json", "w") as f:
        f.write('{"ind": 1, "country": "X"}\nnot json\n')
    from postflow.schemas import GEO_RAW
    rows = read_topic(spark, path, schema=GEO_RAW).collect()
    assert len(rows) == 2 and rows[0].country == "X" and rows[1].ind is None
    assert "_corrupt_record" in read_topic(spark, path, infer=True).columns


def test_read_table_columns(spark, workdir):
    spark.range(5).selectExpr("id", "id * 2 AS y").write.parquet(f"{workdir}/t")
    df = read_table(spark, f"{workdir}/t", "parquet", columns=["y"])
    assert df.columns == ["y"] and sorted(r.y for r in df.collect()) == [0, 2, 4, 6, 8]


def test_conform_casts_and_fills(spark):
    df = spark.createDataFrame([("7", "x")], "index string, extra string")
    out = conform(df, POSTS_RAW)
    assert out.columns == [f.name for f in POSTS_RAW.fields]
    r = out.collect()[0]
    assert r["index"] == 7 and r.title is None


def test_shared_dir_uses_session_setting(spark):
    root = checkpoint_root(spark)
    assert root == spark.conf.get("spark.checkpoint.dir")
    a, b = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert a != b and a.startswith(root.rstrip("/"))


def test_sizing_scales():
    small = sizing(38 * 2 ** 20, 8)
    assert small["spark.sql.shuffle.partitions"] == "8"
    assert int(small["spark.sql.adaptive.advisoryPartitionSizeInBytes"]) < 2 ** 20
    big = sizing(100 * 2 ** 40, 8000)
    assert int(big["spark.sql.shuffle.partitions"]) * 256 * 2 ** 20 == 100 * 2 ** 40      # no cap
    assert big["spark.sql.adaptive.advisoryPartitionSizeInBytes"] == str(256 * 2 ** 20)


def test_sizes_must_be_known(spark, workdir):
    with pytest.raises(ValueError):
        sizing(0, 8000)
    with pytest.raises(ValueError):
        folder_bytes("s3://bucket/topics")
    with open(f"{workdir}/a", "wb") as f:
        f.write(b"x" * 1000)
    assert path_bytes(spark, f"file://{workdir}") == path_bytes(spark, workdir) == 1000 == folder_bytes(workdir)


def test_callers_settings_win(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        assert build_session().conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"
        before = spark.conf.get("spark.sql.shuffle.partitions")
        apply_sizing(spark, 10 ** 12, 100)
        assert spark.conf.get("spark.sql.shuffle.partitions") == before
        assert int(spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes").rstrip("b")) == 256 * 2 ** 20
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
        for k in sizing(1, 1):
            if k != "spark.sql.shuffle.partitions":
                spark.conf.unset(k)


def test_no_machine_local_checkpoints_on_a_cluster():
    class Conf:
        get = staticmethod(lambda *a: None)

    class Context:
        master = "spark://host:7077"
        getConf = staticmethod(lambda: Conf)

    class Session:
        conf, sparkContext = Conf, Context

    with pytest.raises(RuntimeError):
        session.checkpoint_root(Session)


def test_draws_deterministic_and_poisson(spark):
    df = spark.range(20000).select(F.col("id").alias("ind"))
    n = df.select(draw_count(F.col("ind"), 1.0, 100).alias("n"))
    stats = n.agg(F.avg("n").alias("m"), F.var_samp("n").alias("v"), F.max("n").alias("mx"), F.min("n").alias("mn")).collect()[0]
    assert abs(stats.m - 1.0) < 0.05 and abs(stats.v - 1.0) < 0.06 and stats.mx > 4 and stats.mn == 0
    again = df.select(draw_count(F.col("ind"), 1.0, 100).alias("n"))
    assert n.exceptAll(again).count() == 0
    assert df.select(F.sum(draw_count(F.col("ind"), 0.0, 100))).first()[0] == 0 and len(draw_thresholds(1.0)) > 10


def test_malformed_lines_stay_apart(spark, workdir):
    with open(f"{workdir}/a.json", "w") as f:
        f.write('{"ind": 1, "country": "X"}\nnot json\nnor this\nnot json\n{"ind": 1, "country": "X"}\n')
    out = drop_identical_records(read_topic(spark, f"{workdir}/a.json", infer=True), "geo")
    assert out.count() == 3


def test_appended_files_are_seen(spark, workdir):
    from postflow.sources.fixtures import table
    spark.range(3).write.parquet(f"{workdir}/orders.parquet")
    assert table(spark, workdir, "orders").count() == 3
    spark.range(5).write.mode("append").parquet(f"{workdir}/orders.parquet")
    assert table(spark, workdir, "orders").count() == 8


def test_replay_sample_aligns_feeds(spark):
    posts = spark.createDataFrame([(i, f"c{i}") for i in range(200)], "ind int, category string")
    geo = spark.createDataFrame([(i, f"X{i}") for i in range(0, 200, 2)], "ind int, country string")
    out = replay_sample(posts, [geo], fraction=1.5, seed=7).collect()
    assert len(out) > 200
    for r in out:
        assert r.category == f"c{r.ind}"
        assert r.country == (f"X{r.ind}" if r.ind % 2 == 0 else None)
        assert r.draw >= 1


def test_store_clean_bucketed_join_has_no_exchange(spark, workdir):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        a = spark.range(1000).selectExpr("CAST(id AS INT) AS ind", "id % 7 AS category")
        b = spark.range(0, 1000, 3).selectExpr("CAST(id AS INT) AS ind", "'X' AS country")
        t = load_clean(spark, store_clean({"posts": a, "geo": b}, workdir, buckets=4))
        j = t["posts"].join(t["geo"], "ind", "left")
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert j.where("country IS NOT NULL").count() == 334
        plain = load_clean(spark, store_clean({"posts": a}, f"{workdir}/plain"))
        assert plain["posts"].count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_store_clean_writes_one_file_per_bucket(spark, workdir):
    df = spark.range(5000).selectExpr("CAST(id AS INT) AS ind", "id % 7 AS category").repartition(9)
    store_clean({"posts": df}, workdir, buckets=4)
    version, = os.listdir(f"{workdir}/posts")
    files = [f for f in os.listdir(f"{workdir}/posts/{version}") if f.endswith(".parquet")]
    assert len(files) == 4


def test_store_clean_twice_switches_one_table(spark, workdir):
    one = spark.range(10).selectExpr("CAST(id AS INT) AS ind")
    stored = store_clean({"posts": one}, workdir, buckets=2, prefix="twice")
    again = store_clean({"posts": one.union(one)}, workdir, buckets=2, prefix="twice")
    assert stored == again == {"posts": "twice_posts"}
    assert load_clean(spark, again)["posts"].count() == 20
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith("twice")] == ["twice_posts"]
