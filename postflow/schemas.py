"""Schemas of the three feeds: raw batch rows, stream payload rows, clean frames.

Explicit schemas spare the inference pass over every file (one full extra scan
per load at scale) and keep the column set stable when a file is malformed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

S, I, L = T.StringType(), T.IntegerType(), T.LongType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Raw batch rows as the JSON feed lands them (numbers are JSON numbers).
# The feeds' field names, order and types, as they arrive.
POSTS_RAW = _struct(
    ("index", L), ("unique_id", S), ("title", S), ("description", S), ("poster_name", S),
    ("follower_count", S), ("tag_list", S), ("is_image_or_video", S), ("image_src", S),
    ("downloaded", L), ("save_location", S), ("category", S),
)
GEO_RAW = _struct(("ind", L), ("timestamp", S), ("latitude", T.DoubleType()),
                  ("longitude", T.DoubleType()), ("country", S))
USERS_RAW = _struct(("ind", L), ("first_name", S), ("last_name", S), ("age", L), ("date_joined", S))

# Rows inside the stream payload: every posts field is text except the key;
# geo and users carry typed numbers and ISO timestamps.
POSTS_STREAM = _struct(
    ("index", I), ("unique_id", S), ("title", S), ("description", S), ("poster_name", S),
    ("follower_count", S), ("tag_list", S), ("is_image_or_video", S), ("image_src", S),
    ("downloaded", S), ("save_location", S), ("category", S),
)
GEO_STREAM = _struct(("ind", I), ("latitude", T.FloatType()), ("longitude", T.FloatType()),
                     ("timestamp", T.TimestampType()), ("country", S))
USERS_STREAM = _struct(("ind", I), ("date_joined", T.TimestampType()), ("first_name", S),
                       ("last_name", S), ("age", I))

# Column order of the clean frames.
POSTS_COLUMNS = ["ind", "unique_id", "title", "description", "follower_count", "poster_name",
                 "tag_list", "is_image_or_video", "image_src", "save_location", "downloaded",
                 "category"]
GEO_COLUMNS = ["ind", "country", "coordinates", "timestamp"]
USERS_COLUMNS = ["ind", "user_name", "age", "date_joined"]

RAW = {"posts": POSTS_RAW, "geo": GEO_RAW, "users": USERS_RAW}
STREAM = {"posts": POSTS_STREAM, "geo": GEO_STREAM, "users": USERS_STREAM}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select ``schema``'s fields in order, casting (NULL on failure) and
    filling absent columns with NULL; extra columns are dropped."""
    present = set(df.columns)
    cols = []
    for f in schema.fields:
        c = F.col(f.name).try_cast(f.dataType) if f.name in present else F.lit(None).cast(f.dataType)
        cols.append(c.alias(f.name))
    return df.select(*cols)
