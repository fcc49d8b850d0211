"""The analytic questions over clean posts, geo and users.

All joins are left outer on ``ind`` with posts on the left (posts without a
location or user stay, in a NULL group). Each function returns an unsorted
DataFrame unless its name says otherwise; the order of rows is fixed only by a
final ``orderBy`` (``sorted_=True``), as sorts before a join, group or window
are dropped by those anyway.

Plan notes at scale: the join shuffles both sides on ``ind`` (or broadcasts a
side whose measured size is under the threshold, decided by AQE at run time);
AQE splits a skewed ``ind`` partition of the preserved (posts) side, and
``skew="salt"`` also splits keys that are hot on the geo/users side. The
groupings after the join aggregate map-side first, so their shuffles carry
one row per group and task. Year filters sit on the right side of a left
join, which Catalyst turns into an inner join and pushes below it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postflow.operators.aggregates import bucketize, count_by, max_by_group, median_by, year_between
from postflow.operators.joins import Salt, left_join
from postflow.operators.ranking import top_overall, top_per_group

# Year bounds of the questions as posed for the source feeds.
POST_YEARS = (2018, 2022)
JOIN_YEARS = (2015, 2020)


def posts_with(posts: DataFrame, other: DataFrame, keep_both_keys: bool = False,
               skew: str | Salt = "aqe") -> DataFrame:
    """Left join on ``ind``. ``keep_both_keys`` joins by expression and keeps
    the right key as well (two ``ind`` columns, the right one NULL when there
    is no match). ``skew="salt"`` salts keys that are hot on the right side
    (see ``postflow.operators.joins``)."""
    if keep_both_keys and skew == "aqe":
        return posts.join(other, posts["ind"] == other["ind"], "left")
    if keep_both_keys:
        out = left_join(posts, other.withColumn("_right_ind", F.col("ind")), "ind", skew=skew)
        rest = [c for c in other.columns if c != "ind"]
        return out.select(*posts.columns, F.col("_right_ind").alias("ind"), *rest)
    return left_join(posts, other, "ind", skew=skew)


def category_counts_by_country(posts: DataFrame, geo: DataFrame, sorted_: bool = False,
                               skew: str | Salt = "aqe") -> DataFrame:
    """Posts per (country, category) as ``category_count``."""
    j = posts_with(posts.select("ind", "category"), geo.select("ind", "country"), skew=skew)
    out = count_by(j, ["country", "category"], "category_count")
    return out.orderBy("country", F.col("category_count").desc()) if sorted_ else out


def top_category_by_country(posts: DataFrame, geo: DataFrame, strategy: str = "auto",
                            skew: str | Salt = "aqe") -> DataFrame:
    """Most frequent category per country (ties kept)."""
    counts = category_counts_by_country(posts, geo, skew=skew)
    return top_per_group(counts, ["country"], "category_count", strategy=strategy) \
        .select("country", "category", "category_count")


def top_category_by_year(posts: DataFrame, geo: DataFrame, years=POST_YEARS,
                         strategy: str = "auto", skew: str | Salt = "aqe") -> DataFrame:
    """Most frequent category per posting year within ``years`` (inclusive)."""
    j = posts_with(posts.select("ind", "category"), geo.select("ind", "timestamp"), skew=skew)
    j = year_between(j, "timestamp", *years)
    counts = count_by(j, ["post_year", "category"], "category_count")
    return top_per_group(counts, ["post_year"], "category_count", strategy=strategy) \
        .select("post_year", "category", "category_count")


def max_followers_by_poster(posts: DataFrame, geo: DataFrame, skew: str | Salt = "aqe") -> DataFrame:
    """Largest follower count per (country, poster_name)."""
    j = posts_with(posts.select("ind", "poster_name", "follower_count"),
                   geo.select("ind", "country"), skew=skew)
    return max_by_group(j, ["country", "poster_name"], "follower_count")


def top_poster_by_country(posts: DataFrame, geo: DataFrame, strategy: str = "join",
                          skew: str | Salt = "aqe") -> DataFrame:
    """Poster(s) with the most followers per country. A country whose counts are
    all NULL returns every one of its posters, which is why the join plan is the
    default: tied rows of a group then stay spread over many tasks."""
    per_poster = max_followers_by_poster(posts, geo, skew=skew)
    return top_per_group(per_poster, ["country"], "follower_count", strategy=strategy) \
        .select("country", "poster_name", "follower_count")


def country_with_top_poster(posts: DataFrame, geo: DataFrame, skew: str | Salt = "aqe") -> DataFrame:
    """The one country holding the most-followed poster; ties go to the first
    country by name. The overall first row of the per-poster maxima is always
    rank 1 in its own country, so the per-country ranking step is not needed:
    a top-1 over the maxima gives the same row without a window or its shuffle."""
    per_poster = max_followers_by_poster(posts, geo, skew=skew)
    return top_overall(per_poster, "follower_count", ["country"]).select("country", "follower_count")


def _with_age_group(posts: DataFrame, users: DataFrame, cols: list[str], strict: bool,
                    skew: str | Salt) -> DataFrame:
    j = posts_with(posts.select("ind", *cols), users.select("ind", "age", "date_joined"), skew=skew)
    return bucketize(j, "age", "age_group", strict=strict)


def top_category_by_age(posts: DataFrame, users: DataFrame, strict: bool = False,
                        strategy: str = "auto", skew: str | Salt = "aqe") -> DataFrame:
    """Most frequent category per age group. Posts without a user (NULL age) and
    ages outside every range fall into ``50+`` unless ``strict``."""
    j = _with_age_group(posts, users, ["category"], strict, skew)
    counts = count_by(j, ["age_group", "category"], "category_count")
    return top_per_group(counts, ["age_group"], "category_count", strategy=strategy) \
        .select("age_group", "category", "category_count")


def median_followers_by_age(posts: DataFrame, users: DataFrame, exact: bool = False,
                            accuracy: int = 10000, strict: bool = False,
                            sorted_: bool = False, skew: str | Salt = "aqe") -> DataFrame:
    j = _with_age_group(posts, users, ["follower_count"], strict, skew)
    out = median_by(j, ["age_group"], "follower_count", "median_follower_count",
                    accuracy=accuracy, exact=exact)
    return out.orderBy("age_group") if sorted_ else out


def joined_per_year(posts: DataFrame, users: DataFrame, years=JOIN_YEARS,
                    skew: str | Salt = "aqe") -> DataFrame:
    """Post rows per year of the user's joining date within ``years``. It counts
    posts (one user with many posts counts many times), as posed."""
    j = posts_with(posts.select("ind"), users.select("ind", "date_joined"), skew=skew)
    j = year_between(j, "date_joined", *years)
    return count_by(j, ["post_year"], "number_users_joined")


def median_followers_by_join_year(posts: DataFrame, users: DataFrame, years=JOIN_YEARS,
                                  exact: bool = False, accuracy: int = 10000,
                                  sorted_: bool = False, skew: str | Salt = "aqe") -> DataFrame:
    j = posts_with(posts.select("ind", "follower_count"), users.select("ind", "date_joined"), skew=skew)
    j = year_between(j, "date_joined", *years)
    out = median_by(j, ["post_year"], "follower_count", "median_follower_count",
                    accuracy=accuracy, exact=exact)
    return out.orderBy("post_year") if sorted_ else out


def median_followers_by_age_and_year(posts: DataFrame, users: DataFrame, years=JOIN_YEARS,
                                     exact: bool = False, accuracy: int = 10000,
                                     strict: bool = False, sorted_: bool = False,
                                     skew: str | Salt = "aqe") -> DataFrame:
    j = _with_age_group(posts, users, ["follower_count"], strict, skew)
    j = year_between(j, "date_joined", *years)
    out = median_by(j, ["age_group", "post_year"], "follower_count", "median_follower_count",
                    accuracy=accuracy, exact=exact)
    return out.orderBy("age_group", "post_year") if sorted_ else out
