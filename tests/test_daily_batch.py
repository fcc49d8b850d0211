"""The daily job end to end: JSON topics -> clean tables -> question results."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from postflow.plans import daily_batch
from postflow.plans.catalog import FIXTURE_JOIN_YEARS, FIXTURE_POST_YEARS
from postflow.sources.files import write_topic
from postflow.sources.fixtures import raw_feeds

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_daily_batch_matches_registered_queries(spark, workdir):
    for feed, df in raw_feeds(spark, SF).items():
        write_topic(df.withColumn("partition", F.lit(0)), f"{workdir}/topics/{feed}", partition_col="partition")
    paths = daily_batch.run(spark, f"{workdir}/topics", f"{workdir}/out", buckets=4, exact=True,
                            post_years=FIXTURE_POST_YEARS, join_years=FIXTURE_JOIN_YEARS)
    qs = E.queries()
    for key in ("top_category_by_country", "top_category_by_year", "top_poster_by_country",
                "median_followers_by_age_and_year", "joined_per_year"):
        got = sorted(map(tuple, spark.read.parquet(paths[key]).collect()), key=repr)
        want = sorted(map(tuple, qs[key](spark, SF).collect()), key=repr)
        assert got == want, key
