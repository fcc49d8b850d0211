"""Reference SQL (DuckDB dialect) for the correctness check.

Each statement starts from the test tables only: ``FEEDS`` rebuilds the raw
feeds by the same formulas as ``postflow.sources.fixtures`` and ``CLEAN`` the
clean frames, written independently of the DataFrame code. Types are cast to
Spark's result types (``year`` -> INTEGER, medians as the column's type).
"""

from __future__ import annotations

FEEDS = """
b AS (
  SELECT o.o_orderkey AS k, c.c_custkey AS c, o.o_orderstatus, o.o_orderdate, o.o_orderpriority,
         c.c_name, c.c_mktsegment, n.n_nationkey, n.n_name
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
),
d AS (SELECT *, 1 AS cp FROM b UNION ALL SELECT *, 2 AS cp FROM b WHERE k % 50 = 0),
posts_raw AS (
  SELECT k AS "index",
         'u-' || CAST(k AS VARCHAR) AS unique_id,
         CASE WHEN k % 19 = 0 THEN '' WHEN k % 23 = 0 THEN 'No Title Data Available'
              WHEN k % 150 = 0 AND cp = 2 THEN 'Title ' || CAST(k AS VARCHAR) || ' edited'
              ELSE 'Title ' || CAST(k AS VARCHAR) END AS title,
         CASE WHEN k % 13 = 0 THEN 'No description available' WHEN k % 29 = 0 THEN 'Untitled'
              WHEN k % 59 = 0 THEN 'An Untitled piece'
              ELSE 'Status ' || o_orderstatus END AS description,
         CASE WHEN k % 11 = 0 THEN 'User Info Error' ELSE c_name END AS poster_name,
         CASE WHEN k % 11 = 0 OR n_nationkey = 7 THEN 'User Info Error'
              WHEN k % 100 = 0 THEN CASE WHEN cp = 1 THEN '12k' ELSE '12000' END
              WHEN c % 13 = 0 THEN CAST(c % 9 + 1 AS VARCHAR) || CASE WHEN c % 2 = 0 THEN '.7k' ELSE '.2k' END
              WHEN c % 17 = 0 THEN 'kk12k'
              WHEN c % 3 = 0 THEN CAST(c % 900 + 1 AS VARCHAR) || 'k'
              WHEN c % 7 = 0 THEN CAST(c % 9 + 1 AS VARCHAR) || 'M'
              ELSE CAST(c % 9973 AS VARCHAR) END AS follower_count,
         CASE WHEN k % 31 = 0 THEN 'N,o, ,T,a,g,s, ,A,v,a,i,l,a,b,l,e'
              WHEN k % 41 = 0 THEN o_orderpriority || ','
              ELSE o_orderpriority || ',' || o_orderstatus || ',' || c_mktsegment END AS tag_list,
         CASE WHEN k % 4 = 0 THEN 'video' ELSE 'image' END AS is_image_or_video,
         CASE WHEN k % 37 = 0 THEN 'Image src error.'
              ELSE 'https://img.example/' || CAST(k AS VARCHAR) END AS image_src,
         CASE WHEN k % 7 = 0 THEN 0 ELSE 1 END AS downloaded,
         'Local save in /data/' || c_mktsegment AS save_location,
         o_orderpriority AS category
  FROM d
),
geo_raw AS (
  SELECT k AS ind, CASE WHEN k % 47 = 0 THEN 'not a time' ELSE CAST(o_orderdate AS VARCHAR) END AS "timestamp",
         CASE WHEN k % 43 <> 0 THEN CAST(n_nationkey * 6.5 - 78.0 AS DOUBLE)
                                    + CASE WHEN k % 100 = 0 AND cp = 2 AND n_nationkey <> 12 THEN CAST(1e-9 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END
         END AS latitude,
         CAST(n_nationkey * 14.25 - 171.0 AS DOUBLE) AS longitude,
         n_name AS country
  FROM d WHERE k % 17 <> 0
),
user_raw AS (
  SELECT k AS ind,
         CASE WHEN c % 41 = 0 THEN NULL ELSE 'First' || CAST(c % 97 AS VARCHAR) END AS first_name,
         'Last' || CAST(c % 89 AS VARCHAR) AS last_name,
         13 + c % 60 + CASE WHEN k % 100 = 0 AND cp = 2 THEN 1 ELSE 0 END AS age,
         CASE WHEN k % 53 = 0 THEN '' ELSE CAST(o_orderdate AS VARCHAR) END AS date_joined
  FROM d WHERE k % 23 <> 0
)"""

# Placeholder nulling and suffix expansion of posts.
_POSTS_STEPS = """
{name}_nulled AS (
  SELECT "index", unique_id,
         CASE WHEN regexp_matches(title, '(^$|No Title Data Available)') THEN NULL ELSE title END AS title,
         CASE WHEN regexp_matches(description, '(No description available|Untitled)') THEN NULL
              ELSE description END AS description,
         CASE WHEN regexp_matches(poster_name, 'User Info Error') THEN NULL ELSE poster_name END AS poster_name,
         CASE WHEN regexp_matches(follower_count, 'User Info Error') THEN NULL
              ELSE follower_count END AS follower_count,
         CASE WHEN regexp_matches(tag_list, 'N,o, ,T,a,g,s, ,A,v,a,i,l,a,b,l,e') THEN NULL
              ELSE tag_list END AS tag_list,
         is_image_or_video,
         CASE WHEN regexp_matches(image_src, 'Image src error.') THEN NULL ELSE image_src END AS image_src,
         downloaded, save_location, category
  FROM {src}
),
{name} AS (
  SELECT CAST("index" AS INTEGER) AS ind, unique_id, title, description,
         TRY_CAST(trunc(TRY_CAST(CASE WHEN follower_count LIKE '%k' THEN regexp_replace(follower_count, 'k', '000', 'g')
                       WHEN follower_count LIKE '%M' THEN regexp_replace(follower_count, 'M', '000000', 'g')
                       ELSE follower_count END AS DOUBLE)) AS INTEGER) AS follower_count,
         poster_name,
         string_split(tag_list, ',') AS tag_list,
         is_image_or_video, image_src,
         regexp_replace(save_location, 'Local save in ', '', 'g') AS save_location,
         CAST(downloaded AS BOOLEAN) AS downloaded,
         category
  FROM {name}_nulled
)"""

def posts_ctes(src: str, name: str) -> str:
    """Two CTEs: ``<name>_nulled`` (placeholders nulled, raw types) and
    ``<name>`` (clean posts) over the raw rows of ``src``."""
    return _POSTS_STEPS.format(src=src, name=name).strip("\n")


CLEAN = ",\n".join([
    FEEDS,
    "posts_dedup AS (SELECT DISTINCT * FROM posts_raw)",
    posts_ctes("posts_dedup", "posts"),
    """geo AS (
  SELECT CAST(ind AS INTEGER) AS ind, country,
         [CAST(latitude AS FLOAT), CAST(longitude AS FLOAT)] AS coordinates,
         TRY_STRPTIME("timestamp", '%Y-%m-%d %H:%M:%S') AS "timestamp"
  FROM (SELECT DISTINCT * FROM geo_raw) g
)""",
    """users AS (
  SELECT CAST(ind AS INTEGER) AS ind, first_name || ' ' || last_name AS user_name,
         CAST(age AS INTEGER) AS age,
         TRY_STRPTIME(date_joined, '%Y-%m-%d %H:%M:%S') AS date_joined
  FROM (SELECT DISTINCT * FROM user_raw) u
)""",
])

AGE_GROUP_SQL = """CASE WHEN age >= 18 AND age <= 24 THEN '18-24'
              WHEN age >= 25 AND age <= 35 THEN '25-35'
              WHEN age >= 36 AND age <= 50 THEN '36-50'
              ELSE '50+' END"""

POSTS_COLS = ("ind, unique_id, title, description, follower_count, poster_name, tag_list, "
              "is_image_or_video, image_src, save_location, downloaded, category")


GEO_TYPED = """geo_typed AS (
  SELECT CAST(ind AS INTEGER) AS ind, TRY_STRPTIME("timestamp", '%Y-%m-%d %H:%M:%S') AS "timestamp", latitude, longitude, country
  FROM geo_raw
)"""
USERS_TYPED = """users_typed AS (
  SELECT CAST(ind AS INTEGER) AS ind, first_name, last_name, CAST(age AS INTEGER) AS age,
         TRY_STRPTIME(date_joined, '%Y-%m-%d %H:%M:%S') AS date_joined
  FROM user_raw
)"""
GEO_NODEDUP = """geo_nodedup AS (
  SELECT CAST(ind AS INTEGER) AS ind, country,
         [CAST(latitude AS FLOAT), CAST(longitude AS FLOAT)] AS coordinates,
         TRY_STRPTIME("timestamp", '%Y-%m-%d %H:%M:%S') AS "timestamp"
  FROM geo_raw
)"""
USERS_NODEDUP = """users_nodedup AS (
  SELECT CAST(ind AS INTEGER) AS ind, first_name || ' ' || last_name AS user_name,
         CAST(age AS INTEGER) AS age,
         TRY_STRPTIME(date_joined, '%Y-%m-%d %H:%M:%S') AS date_joined
  FROM user_raw
)"""


def with_clean(body: str) -> str:
    return f"WITH {CLEAN.strip()}\n{body.strip()}"


def with_feeds(body: str, *extra: str) -> str:
    parts = [FEEDS.strip()] + [e.strip() for e in extra if e]
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()
