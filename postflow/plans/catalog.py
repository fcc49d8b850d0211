"""Registered queries: key -> (Spark callable, oracle SQL or None).

Every callable takes ``(spark, sf_dir)``, reads the test tables (whole, no
subsets) through the fixture adapter and returns a DataFrame. The oracle SQL
computes the same result in DuckDB from the same tables. Keys without SQL are
checked on row counts only (and by unit tests against brute force).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from postflow.operators.clean import clean_geo, clean_posts, clean_users
from postflow.plans import questions as Q
from postflow.plans.oracle import AGE_GROUP_SQL, POSTS_COLS, with_clean
from postflow.sources.fixtures import geo_raw, posts_raw, users_raw

# Year bounds mapped onto the test tables' order dates (1995-01 .. 2001-08):
# the posting-year window and the joining-year window of the questions.
FIXTURE_POST_YEARS = (1996, 2000)
FIXTURE_JOIN_YEARS = (1996, 2000)

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Query, str | None]] = {}


def register(key: str, sql: str | None):
    def deco(fn: Query) -> Query:
        if key in REGISTRY:
            raise KeyError(f"duplicate key {key}")
        REGISTRY[key] = (fn, sql)
        return fn
    return deco


def posts(spark, sf):
    return clean_posts(posts_raw(spark, sf))


def geo(spark, sf):
    return clean_geo(geo_raw(spark, sf))


def users(spark, sf):
    return clean_users(users_raw(spark, sf))


# --------------------------------------------------------------------------- clean frames
@register("clean_posts", with_clean(f"SELECT {POSTS_COLS} FROM posts"))
def _clean_posts(spark, sf):
    return posts(spark, sf)


@register("clean_geo", with_clean("SELECT ind, country, coordinates, \"timestamp\" FROM geo"))
def _clean_geo(spark, sf):
    return geo(spark, sf)


@register("clean_users", with_clean("SELECT ind, user_name, age, date_joined FROM users"))
def _clean_users(spark, sf):
    return users(spark, sf)


# --------------------------------------------------------------------------- questions
_COUNTS_BY_COUNTRY = """
SELECT g.country, p.category, COUNT(*) AS category_count
FROM posts p LEFT JOIN geo g ON p.ind = g.ind
GROUP BY g.country, p.category"""


@register("category_counts_by_country", with_clean(_COUNTS_BY_COUNTRY))
def _category_counts_by_country(spark, sf):
    return Q.category_counts_by_country(posts(spark, sf), geo(spark, sf), sorted_=True)


@register("top_category_by_country", with_clean(f"""
SELECT country, category, category_count FROM (
  SELECT *, rank() OVER (PARTITION BY country ORDER BY category_count DESC) AS rnk
  FROM ({_COUNTS_BY_COUNTRY}) cc) t
WHERE rnk = 1"""))
def _top_category_by_country(spark, sf):
    return Q.top_category_by_country(posts(spark, sf), geo(spark, sf))


@register("top_category_by_year", with_clean(f"""
SELECT post_year, category, category_count FROM (
  SELECT *, rank() OVER (PARTITION BY post_year ORDER BY category_count DESC) AS rnk
  FROM (SELECT CAST(year(g."timestamp") AS INTEGER) AS post_year, p.category, COUNT(*) AS category_count
        FROM posts p LEFT JOIN geo g ON p.ind = g.ind
        WHERE year(g."timestamp") BETWEEN {FIXTURE_POST_YEARS[0]} AND {FIXTURE_POST_YEARS[1]}
        GROUP BY 1, 2) c) t
WHERE rnk = 1"""))
def _top_category_by_year(spark, sf):
    return Q.top_category_by_year(posts(spark, sf), geo(spark, sf), FIXTURE_POST_YEARS)


_MAX_BY_POSTER = """
SELECT g.country, p.poster_name, MAX(p.follower_count) AS follower_count
FROM posts p LEFT JOIN geo g ON p.ind = g.ind
GROUP BY g.country, p.poster_name"""


@register("max_followers_by_poster", with_clean(_MAX_BY_POSTER))
def _max_followers_by_poster(spark, sf):
    return Q.max_followers_by_poster(posts(spark, sf), geo(spark, sf))


_TOP_POSTER = f"""
SELECT country, poster_name, follower_count FROM (
  SELECT *, rank() OVER (PARTITION BY country ORDER BY follower_count DESC NULLS LAST) AS rnk
  FROM ({_MAX_BY_POSTER}) m) t
WHERE rnk = 1"""


@register("top_poster_by_country", with_clean(_TOP_POSTER))
def _top_poster_by_country(spark, sf):
    return Q.top_poster_by_country(posts(spark, sf), geo(spark, sf))


@register("country_with_top_poster", with_clean(f"""
SELECT country, follower_count FROM ({_TOP_POSTER}) t
ORDER BY follower_count DESC NULLS LAST, country ASC NULLS FIRST LIMIT 1"""))
def _country_with_top_poster(spark, sf):
    return Q.country_with_top_poster(posts(spark, sf), geo(spark, sf))


_POSTS_USERS = f"""
SELECT p.ind, p.category, p.follower_count, u.age, u.date_joined, {AGE_GROUP_SQL} AS age_group
FROM posts p LEFT JOIN users u ON p.ind = u.ind"""


@register("top_category_by_age", with_clean(f"""
SELECT age_group, category, category_count FROM (
  SELECT *, rank() OVER (PARTITION BY age_group ORDER BY category_count DESC) AS rnk
  FROM (SELECT age_group, category, COUNT(*) AS category_count
        FROM ({_POSTS_USERS}) j GROUP BY 1, 2) c) t
WHERE rnk = 1"""))
def _top_category_by_age(spark, sf):
    return Q.top_category_by_age(posts(spark, sf), users(spark, sf))


@register("median_followers_by_age", with_clean(f"""
SELECT age_group, quantile_disc(follower_count, 0.5) AS median_follower_count
FROM ({_POSTS_USERS}) j GROUP BY age_group ORDER BY age_group"""))
def _median_followers_by_age(spark, sf):
    return Q.median_followers_by_age(posts(spark, sf), users(spark, sf), exact=True, sorted_=True)


_JOIN_YEAR = f"""
SELECT *, CAST(year(date_joined) AS INTEGER) AS post_year FROM ({_POSTS_USERS}) j
WHERE year(date_joined) BETWEEN {FIXTURE_JOIN_YEARS[0]} AND {FIXTURE_JOIN_YEARS[1]}"""


@register("joined_per_year", with_clean(f"""
SELECT post_year, COUNT(*) AS number_users_joined FROM ({_JOIN_YEAR}) y GROUP BY post_year"""))
def _joined_per_year(spark, sf):
    return Q.joined_per_year(posts(spark, sf), users(spark, sf), FIXTURE_JOIN_YEARS)


@register("median_followers_by_join_year", with_clean(f"""
SELECT post_year, quantile_disc(follower_count, 0.5) AS median_follower_count
FROM ({_JOIN_YEAR}) y GROUP BY post_year ORDER BY post_year"""))
def _median_followers_by_join_year(spark, sf):
    return Q.median_followers_by_join_year(posts(spark, sf), users(spark, sf), FIXTURE_JOIN_YEARS,
                                           exact=True, sorted_=True)


@register("median_followers_by_age_and_year", with_clean(f"""
SELECT age_group, post_year, quantile_disc(follower_count, 0.5) AS median_follower_count
FROM ({_JOIN_YEAR}) y GROUP BY age_group, post_year ORDER BY age_group, post_year"""))
def _median_followers_by_age_and_year(spark, sf):
    return Q.median_followers_by_age_and_year(posts(spark, sf), users(spark, sf),
                                              FIXTURE_JOIN_YEARS, exact=True, sorted_=True)


def queries() -> dict[str, Query]:
    return {k: fn for k, (fn, _) in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {k: sql for k, (_, sql) in REGISTRY.items() if sql is not None}


# Further keys register themselves on import.
from postflow.plans import operator_keys  # noqa: E402,F401
from postflow.plans import stream_keys  # noqa: E402,F401
from postflow.plans import live_keys  # noqa: E402,F401
from postflow.plans import sketch_keys  # noqa: E402,F401
from postflow.plans import observed_keys  # noqa: E402,F401
