"""Wire formats of the feeds, as column expressions.

* REST form (one record per request body): ``{"records":[{"value": <row>}]}``,
  timestamps as ``yyyy-MM-dd HH:mm:ss``.
* Stream form: ``{"StreamName": ..., "Data": <row>, "PartitionKey": ...}``,
  timestamps ISO-8601 with ``T``.
* A stream *record*, as a stream source yields it: the row JSON as binary
  ``data`` next to its ``partitionKey``.

NULL fields are written as ``null`` (as a JSON encoder of the row would), not
dropped. Decoding is one function for batch and streaming frames.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Timestamp text of the two wire forms.
REST_TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
STREAM_TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"


def _row(df: DataFrame) -> Column:
    return F.struct(*[F.col(c) for c in df.columns])


def encode_rest(df: DataFrame) -> Column:
    """REST body of one row: ``{"records":[{"value": row}]}``."""
    records = F.array(F.struct(_row(df).alias("value")))
    return F.to_json(F.struct(records.alias("records")),
                     {"timestampFormat": REST_TIMESTAMP_FORMAT, "ignoreNullFields": "false"})


def encode_stream(df: DataFrame, stream_name: str, partition_key: Column | None = None) -> Column:
    """Stream PUT body of one row. ``partition_key`` defaults to the row's first
    column as text, which spreads records over shards (a constant key would put
    every record on one shard)."""
    key = partition_key if partition_key is not None else F.col(df.columns[0]).cast("string")
    body = F.struct(F.lit(stream_name).alias("StreamName"), _row(df).alias("Data"),
                    key.alias("PartitionKey"))
    return F.to_json(body, {"timestampFormat": STREAM_TIMESTAMP_FORMAT, "ignoreNullFields": "false"})


def row_json(df: DataFrame, timestamp_format: str = STREAM_TIMESTAMP_FORMAT) -> Column:
    """The row alone as JSON text."""
    return F.to_json(_row(df), {"timestampFormat": timestamp_format, "ignoreNullFields": "false"})


def rest_schema(row: T.StructType) -> T.StructType:
    value = T.StructType([T.StructField("value", row, True)])
    return T.StructType([T.StructField("records", T.ArrayType(value, True), True)])


def stream_schema(row: T.StructType) -> T.StructType:
    return T.StructType([T.StructField("StreamName", T.StringType(), True),
                         T.StructField("Data", row, True),
                         T.StructField("PartitionKey", T.StringType(), True)])


def decode_json(df: DataFrame, schema: T.StructType, column: str = "data",
                keep: list[str] | None = None) -> DataFrame:
    """Binary or text JSON column -> the schema's columns.

    PERMISSIVE: a document that does not parse gives all-NULL fields, a field of
    the wrong type gives NULL alone. ``keep`` carries source columns along.
    """
    text = F.col(column).cast("string")
    parsed = F.from_json(text, schema).alias("_parsed")
    return df.select(*(keep or []), parsed).select(*(keep or []), "_parsed.*")


CORRUPT = "_corrupt_record"


def decode_json_checked(df: DataFrame, schema: T.StructType, column: str = "data",
                        keep: list[str] | None = None) -> DataFrame:
    """Like ``decode_json`` plus ``_corrupt_record``: the raw text of a record
    that did not parse or had a field of the wrong type (NULL otherwise)."""
    full = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType(), True)])
    text = F.col(column).cast("string")
    parsed = F.from_json(text, full, {"columnNameOfCorruptRecord": CORRUPT}).alias("_parsed")
    return df.select(*(keep or []), parsed).select(*(keep or []), "_parsed.*")
