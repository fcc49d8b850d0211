"""Registered keys for single operators, quality checks, joins, dedup variants
and wire formats (the questions and clean frames are in ``catalog``)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from postflow.functions.cleaning import join_name, parse_timestamp, split_list, strip_text
from postflow.functions.envelope import decode_json, encode_rest, encode_stream
from postflow.operators import quality as QA
from postflow.operators.aggregates import bucketize
from postflow.operators.joins import Salt
from postflow.operators.clean import (
    clean_geo, clean_posts, clean_users, expand_suffix_int, null_placeholders,
)
from postflow.plans import questions as Q
from postflow.plans.catalog import FIXTURE_JOIN_YEARS, REGISTRY, geo, posts, register, users
from postflow.plans.oracle import (
    AGE_GROUP_SQL, GEO_NODEDUP, GEO_TYPED, POSTS_COLS, USERS_NODEDUP, posts_ctes, with_clean,
    with_feeds,
)
from postflow.schemas import POSTS_COLUMNS, POSTS_RAW
from postflow.sources.fixtures import geo_raw, posts_raw, source_rows, table, users_raw

PLACEHOLDER_COLS = ["title", "description", "follower_count", "poster_name", "tag_list", "image_src"]
RAW_POST_COLS = ", ".join(f'"{c}"' for c in POSTS_RAW.fieldNames())
NULLED = posts_ctes("posts_raw", "pr")

# --------------------------------------------------------------------------- cleaning rules


@register("null_placeholders", with_feeds(
    f'SELECT "index", {", ".join(PLACEHOLDER_COLS)} FROM pr_nulled', NULLED))
def _null_placeholders(spark, sf):
    return null_placeholders(posts_raw(spark, sf)).select("index", *PLACEHOLDER_COLS)


@register("expand_suffix_int", with_feeds('SELECT ind, follower_count FROM pr',
                                          NULLED))
def _expand_suffix_int(spark, sf):
    df = expand_suffix_int(null_placeholders(posts_raw(spark, sf)))
    return df.select(F.col("index").cast("int").alias("ind"), "follower_count")


@register("strip_save_location", with_feeds(
    """SELECT "index", regexp_replace(save_location, 'Local save in ', '', 'g') AS save_location
FROM posts_raw"""))
def _strip_save_location(spark, sf):
    return posts_raw(spark, sf).select("index", strip_text(F.col("save_location")).alias("save_location"))


@register("split_tags", with_feeds('SELECT "index", string_split(tag_list, \',\') AS tag_list FROM pr_nulled',
                                   NULLED))
def _split_tags(spark, sf):
    df = null_placeholders(posts_raw(spark, sf))
    return df.select("index", split_list(F.col("tag_list")).alias("tag_list"))


@register("parse_timestamp", with_feeds(
    """SELECT ind, TRY_STRPTIME("timestamp", '%Y-%m-%d %H:%M:%S') AS "timestamp" FROM geo_raw"""))
def _parse_timestamp(spark, sf):
    return geo_raw(spark, sf).select("ind", parse_timestamp(F.col("timestamp")).alias("timestamp"))


@register("full_name", with_feeds("SELECT ind, first_name || ' ' || last_name AS user_name FROM user_raw"))
def _full_name(spark, sf):
    return users_raw(spark, sf).select("ind", join_name("first_name", "last_name").alias("user_name"))


@register("bucketize_age", with_clean(f"""
SELECT ind, age, {AGE_GROUP_SQL} AS age_group,
       CASE WHEN age >= 18 AND age <= 24 THEN 1 WHEN age >= 25 AND age <= 35 THEN 2
            WHEN age >= 36 AND age <= 50 THEN 3 ELSE 4 END AS age_group_rank
FROM users"""))
def _bucketize_age(spark, sf):
    return bucketize(users(spark, sf), "age", "age_group", order_col="age_group_rank") \
        .select("ind", "age", "age_group", "age_group_rank")


@register("json_struct_expand",
          "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events")
def _json_struct_expand(spark, sf):
    schema = T.StructType([T.StructField("k", T.IntegerType(), True)])
    return decode_json(table(spark, sf, "events"), schema, "props", keep=["event_id"])


# --------------------------------------------------------------------------- quality


@register("geo_null_latitude", with_feeds(
    "SELECT ind, CAST(latitude AS FLOAT) AS latitude FROM geo_raw WHERE CAST(latitude AS FLOAT) IS NULL"))
def _geo_null_latitude(spark, sf):
    df = geo_raw(spark, sf).select("ind", F.col("latitude").try_cast("float").alias("latitude"))
    return QA.rows_with_null(df, "latitude")


@register("array_null_exists", with_clean(
    'SELECT ind, country, coordinates, "timestamp" FROM geo '
    "WHERE len(list_filter(coordinates, lambda x: x IS NULL)) > 0"))
def _array_null_exists(spark, sf):
    return QA.array_null_exists(geo(spark, sf))


@register("array_null_count", with_clean(
    'SELECT ind, country, coordinates, "timestamp", '
    "CAST(len(list_filter(coordinates, lambda x: x IS NULL)) AS INTEGER) AS num_nulls FROM geo "
    "WHERE len(list_filter(coordinates, lambda x: x IS NULL)) > 0"))
def _array_null_count(spark, sf):
    return QA.array_null_count(geo(spark, sf)).where("num_nulls > 0")


@register("array_null_sizes", with_clean(
    "SELECT ind, CAST(len(list_filter(coordinates, lambda x: x IS NULL)) AS INTEGER) AS num_nulls FROM geo"))
def _array_null_sizes(spark, sf):
    return QA.array_null_count(geo(spark, sf)).select("ind", "num_nulls")


_NULL_SUM = " + ".join(f"CAST({c} IS NULL AS INTEGER)" for c in POSTS_COLUMNS)


@register("row_null_count", with_clean(f"SELECT ind, unique_id, {_NULL_SUM} AS num_nulls FROM posts"))
def _row_null_count(spark, sf):
    return QA.row_null_count(posts(spark, sf)).select("ind", "unique_id", "num_nulls")


@register("drop_rows_by_null_count", with_clean(f"SELECT {POSTS_COLS} FROM posts WHERE {_NULL_SUM} <> 6"))
def _drop_rows_by_null_count(spark, sf):
    return QA.drop_rows_by_null_count(posts(spark, sf), 6)


@register("null_profile", with_clean("\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS null_count FROM posts"
    for c in POSTS_COLUMNS)))
def _null_profile(spark, sf):
    return QA.null_profile(posts(spark, sf))


@register("key_uniqueness", with_feeds("""
SELECT 'posts' AS feed, COUNT(*) AS total_count, COUNT(DISTINCT "index") AS distinct_count,
       COUNT(*) = COUNT(DISTINCT "index") AS is_unique FROM posts_raw
UNION ALL
SELECT 'geo', COUNT(*), COUNT(DISTINCT ind), COUNT(*) = COUNT(DISTINCT ind) FROM geo_raw
UNION ALL
SELECT 'users', COUNT(*), COUNT(DISTINCT ind), COUNT(*) = COUNT(DISTINCT ind) FROM user_raw"""))
def _key_uniqueness(spark, sf):
    p = QA.key_uniqueness(clean_posts(posts_raw(spark, sf), dedup="none"), "ind", "posts")
    g = QA.key_uniqueness(clean_geo(geo_raw(spark, sf), dedup="none"), "ind", "geo")
    u = QA.key_uniqueness(clean_users(users_raw(spark, sf), dedup="none"), "ind", "users")
    return p.unionByName(g).unionByName(u)


@register("key_uniqueness_clean", with_clean("""
SELECT 'posts' AS feed, COUNT(*) AS total_count, COUNT(DISTINCT ind) AS distinct_count,
       COUNT(*) = COUNT(DISTINCT ind) AS is_unique FROM posts"""))
def _key_uniqueness_clean(spark, sf):
    return QA.key_uniqueness(posts(spark, sf), "ind", "posts")


@register("dedup_posts", with_feeds(f"SELECT DISTINCT {RAW_POST_COLS} FROM posts_raw"))
def _dedup_posts(spark, sf):
    return posts_raw(spark, sf).dropDuplicates()


@register("distinct_values", with_feeds("SELECT DISTINCT description FROM posts_raw"))
def _distinct_values(spark, sf):
    return QA.distinct_values(posts_raw(spark, sf), "description")


# --------------------------------------------------------------------------- joins, dedup variants

_GEO_OUT = 'g.country, g.coordinates, g."timestamp"'


@register("posts_geo_left", with_clean(
    f"SELECT p.*, {_GEO_OUT} FROM posts p LEFT JOIN geo g ON p.ind = g.ind"))
def _posts_geo_left(spark, sf):
    return posts(spark, sf).join(geo(spark, sf), on="ind", how="left")


@register("posts_users_left", with_clean(
    "SELECT p.*, u.user_name, u.age, u.date_joined FROM posts p LEFT JOIN users u ON p.ind = u.ind"))
def _posts_users_left(spark, sf):
    return posts(spark, sf).join(users(spark, sf), on="ind", how="left")


@register("posts_geo_left_both_keys", with_clean(
    "SELECT p.ind, p.category, g.ind AS geo_ind, g.country FROM posts p LEFT JOIN geo g ON p.ind = g.ind"))
def _posts_geo_left_both_keys(spark, sf):
    p, g = posts(spark, sf).select("ind", "category"), geo(spark, sf).select("ind", "country")
    return Q.posts_with(p, g, keep_both_keys=True).toDF("ind", "category", "geo_ind", "country")


@register("posts_geo_left_both_keys_salted", with_clean(
    "SELECT p.ind, p.category, g.ind AS geo_ind, g.country FROM posts p LEFT JOIN geo g ON p.ind = g.ind"))
def _posts_geo_left_both_keys_salted(spark, sf):
    p, g = posts(spark, sf).select("ind", "category"), geo(spark, sf).select("ind", "country")
    return Q.posts_with(p, g, keep_both_keys=True, skew=Salt(hot_rows=1, buckets=8)) \
        .toDF("ind", "category", "geo_ind", "country")


@register("clean_posts_dedup_late", with_feeds(f"SELECT DISTINCT {POSTS_COLS} FROM pr", NULLED))
def _clean_posts_dedup_late(spark, sf):
    return clean_posts(posts_raw(spark, sf), dedup="clean")


@register("clean_geo_dedup_late", with_feeds(
    'SELECT DISTINCT ind, country, coordinates, "timestamp" FROM geo_nodedup', GEO_NODEDUP))
def _clean_geo_dedup_late(spark, sf):
    return clean_geo(geo_raw(spark, sf), dedup="clean")


@register("clean_users_stream_rules", with_feeds(
    "SELECT ind, user_name, age, date_joined FROM users_nodedup", USERS_NODEDUP))
def _clean_users_nodedup(spark, sf):
    return clean_users(users_raw(spark, sf), dedup="none")


# --------------------------------------------------------------------------- wire formats

_RAW_POST_FIELDS = POSTS_RAW.fieldNames()
_REST_VALUE = ", ".join(f"'{c}', \"{c}\"" for c in _RAW_POST_FIELDS)


@register("envelope_encode_rest", with_feeds(f"""
SELECT "index", CAST(json_object('records', json_array(json_object('value', json_object({_REST_VALUE}))))
                     AS VARCHAR) AS payload
FROM posts_raw"""))
def _envelope_encode_rest(spark, sf):
    raw = posts_raw(spark, sf)
    return raw.select("index", encode_rest(raw).alias("payload"))


@register("envelope_encode_stream", with_feeds("""
SELECT ind, CAST(json_object('StreamName', 'geo-stream',
                             'Data', json_object('ind', CAST(ind AS INTEGER),
                                                 'timestamp', strftime("timestamp", '%Y-%m-%dT%H:%M:%S'),
                                                 'latitude', latitude, 'longitude', longitude,
                                                 'country', country),
                             'PartitionKey', CAST(ind AS VARCHAR)) AS VARCHAR) AS payload
FROM geo_typed""", GEO_TYPED))
def _envelope_encode_stream(spark, sf):
    rows = source_rows(spark, sf, "geo")
    return rows.select("ind", encode_stream(rows, "geo-stream").alias("payload"))


@register("envelope_roundtrip_users", with_feeds("""
SELECT CAST(ind AS INTEGER) AS ind, first_name, last_name, CAST(age AS INTEGER) AS age,
       TRY_STRPTIME(date_joined, '%Y-%m-%d %H:%M:%S') AS date_joined
FROM user_raw"""))
def _envelope_roundtrip_users(spark, sf):
    from postflow.functions.envelope import stream_schema
    from postflow.schemas import USERS_STREAM
    rows = source_rows(spark, sf, "users")
    env = rows.select(encode_stream(rows, "users-stream").alias("body"))
    return decode_json(env, stream_schema(USERS_STREAM), "body").select("Data.*") \
        .select("ind", "first_name", "last_name", "age", "date_joined")


# --------------------------------------------------------------------------- aligned replay sample

_SAMPLE = dict(fraction=1.0, seed=100)


def _sample_sql() -> str:
    from postflow.operators.sampling import draw_thresholds
    limits = draw_thresholds(_SAMPLE["fraction"])
    h = f"('0x' || substr(md5('{_SAMPLE['seed']}:' || CAST(ind AS VARCHAR)), 1, 8))::BIGINT"
    draws = " + ".join(f"CASE WHEN {h} >= {t} THEN 1 ELSE 0 END" for t in limits)
    return with_clean(f"""
SELECT s.ind, CAST(s.draw AS INTEGER) AS draw, s.category, g.country, u.user_name FROM (
  SELECT p.ind, p.category, d.draw
  FROM (SELECT ind, category, {draws} AS n FROM posts) p
  JOIN range(1, {len(limits) + 1}) d(draw) ON d.draw <= p.n) s
LEFT JOIN geo g ON s.ind = g.ind
LEFT JOIN users u ON s.ind = u.ind""")


@register("replay_sample", _sample_sql())
def _replay_sample(spark, sf):
    from postflow.operators.sampling import replay_sample
    return replay_sample(posts(spark, sf).select("ind", "category"),
                         [geo(spark, sf).select("ind", "country"),
                          users(spark, sf).select("ind", "user_name")], **_SAMPLE) \
        .select("ind", "draw", "category", "country", "user_name")


# --------------------------------------------------------------------------- approximate medians
# The feeds' own definition of the median: percentile_approx. At this accuracy
# the sketch keeps every distinct value of the test tables, so it returns the
# exact lower median and shares the exact keys' SQL; the default accuracy
# (10000) of the questions stays, and a unit test bounds its rank error.

CHECK_ACCURACY = 1_000_000


@register("median_followers_by_age_approx", REGISTRY["median_followers_by_age"][1])
def _median_followers_by_age_approx(spark, sf):
    return Q.median_followers_by_age(posts(spark, sf), users(spark, sf), exact=False,
                                     accuracy=CHECK_ACCURACY, sorted_=True)


@register("median_followers_by_join_year_approx", REGISTRY["median_followers_by_join_year"][1])
def _median_followers_by_join_year_approx(spark, sf):
    return Q.median_followers_by_join_year(posts(spark, sf), users(spark, sf), FIXTURE_JOIN_YEARS,
                                           exact=False, accuracy=CHECK_ACCURACY, sorted_=True)


@register("median_followers_by_age_and_year_approx", REGISTRY["median_followers_by_age_and_year"][1])
def _median_followers_by_age_and_year_approx(spark, sf):
    return Q.median_followers_by_age_and_year(posts(spark, sf), users(spark, sf), FIXTURE_JOIN_YEARS,
                                              exact=False, accuracy=CHECK_ACCURACY, sorted_=True)


# --------------------------------------------------------------------------- salted joins
# Every hundredth key has two versions on the right side (planted); with
# hot_rows=1 these are the hot keys, and only their left rows are replicated.

@register("posts_geo_left_salted", with_clean(
    f"SELECT p.*, {_GEO_OUT} FROM posts p LEFT JOIN geo g ON p.ind = g.ind"))
def _posts_geo_left_salted(spark, sf):
    from postflow.operators.joins import left_join
    return left_join(posts(spark, sf), geo(spark, sf), "ind", skew="salt", hot_rows=1, buckets=8)


@register("posts_users_left_salted", with_clean(
    "SELECT p.*, u.user_name, u.age, u.date_joined FROM posts p LEFT JOIN users u ON p.ind = u.ind"))
def _posts_users_left_salted(spark, sf):
    from postflow.operators.joins import left_join
    return left_join(posts(spark, sf), users(spark, sf), "ind", skew="salt", hot_rows=1, buckets=8)
