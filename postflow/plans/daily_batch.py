"""The daily batch job: read the three feeds, clean them once, store the clean
tables, answer every question into its own result table.

Run with spark-submit (any scheduler can trigger it daily):

    spark-submit --py-files postflow.zip postflow/plans/daily_batch.py \\
        --topics s3://bucket/topics --out s3://bucket/analytics

The input is measured first and sizes the shuffles and the buckets
(``--input-bytes``, ``--slots`` and ``--buckets`` override it). The feeds are read
from ``<topics>/<feed>`` with explicit schemas; the clean tables are written once,
bucketed by ``ind``, and every question then reads only the columns it needs from them. Results are
written as Parquet below ``<out>/results``.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from postflow.operators.clean import CLEANERS
from postflow.plans import questions as Q
from postflow.schemas import RAW
from postflow.sources.files import read_topic
from postflow.sources.tables import load_clean, store_clean


def questions(t: dict[str, DataFrame], post_years=Q.POST_YEARS, join_years=Q.JOIN_YEARS,
              exact: bool = False, skew="aqe") -> dict[str, DataFrame]:
    p, g, u = t["posts"], t["geo"], t["users"]
    return {
        "category_counts_by_country": Q.category_counts_by_country(p, g, sorted_=True, skew=skew),
        "top_category_by_country": Q.top_category_by_country(p, g, skew=skew),
        "top_category_by_year": Q.top_category_by_year(p, g, post_years, skew=skew),
        "top_poster_by_country": Q.top_poster_by_country(p, g, skew=skew),
        "country_with_top_poster": Q.country_with_top_poster(p, g, skew=skew),
        "top_category_by_age": Q.top_category_by_age(p, u, skew=skew),
        "median_followers_by_age": Q.median_followers_by_age(p, u, exact=exact, sorted_=True, skew=skew),
        "joined_per_year": Q.joined_per_year(p, u, join_years, skew=skew),
        "median_followers_by_join_year": Q.median_followers_by_join_year(
            p, u, join_years, exact=exact, sorted_=True, skew=skew),
        "median_followers_by_age_and_year": Q.median_followers_by_age_and_year(
            p, u, join_years, exact=exact, sorted_=True, skew=skew),
    }


def run(spark: SparkSession, topics: str, out: str, buckets: int | None = None,
        exact: bool = False, skew="aqe", post_years=Q.POST_YEARS,
        join_years=Q.JOIN_YEARS) -> dict[str, str]:
    """Clean, store, answer. Returns question -> result path."""
    raw = {f: read_topic(spark, f"{topics.rstrip('/')}/{f}", schema=RAW[f]) for f in CLEANERS}
    clean = {f: CLEANERS[f](df) for f, df in raw.items()}
    tables = load_clean(spark, store_clean(clean, f"{out.rstrip('/')}/clean", buckets))
    paths = {}
    for name, df in questions(tables, post_years, join_years, exact, skew).items():
        path = f"{out.rstrip('/')}/results/{name}"
        df.write.mode("overwrite").parquet(path)
        paths[name] = path
    return paths


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.split("\n\n")[0])
    ap.add_argument("--topics", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--buckets", type=int, default=None, help="default: one per 256 MB of input; 0: none")
    ap.add_argument("--input-bytes", type=int, default=None, help="default: measured")
    ap.add_argument("--slots", type=int, default=None, help="task slots; default: Spark's parallelism")
    ap.add_argument("--exact", action="store_true", help="exact medians instead of the sketch")
    ap.add_argument("--skew", default="aqe", choices=["aqe", "salt"],
                    help="salt: spread keys that are hot on the geo/users side")
    ap.add_argument("--hot-rows", type=int, default=1_000_000, help="rows that make a key hot")
    ap.add_argument("--salt-buckets", type=int, default=64)
    a = ap.parse_args(argv)
    from postflow.operators.joins import Salt
    from postflow.session import apply_sizing, build_session, path_bytes
    from postflow.sources.tables import bucket_count
    skew = Salt(a.hot_rows, a.salt_buckets) if a.skew == "salt" else "aqe"
    spark = build_session()
    size = a.input_bytes or path_bytes(spark, a.topics)
    apply_sizing(spark, size, a.slots or spark.sparkContext.defaultParallelism)
    run(spark, a.topics, a.out, bucket_count(size) if a.buckets is None else a.buckets, a.exact, skew)


if __name__ == "__main__":
    main()
