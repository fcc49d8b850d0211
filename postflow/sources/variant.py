"""JSON topics whose fields differ from file to file, loaded in one pass.

An inferred schema costs a pass over every file before the load, and changes with
the files. ``read_topic_variant`` reads each line as one ``VARIANT`` value instead;
``from_variant`` takes typed columns out of it. What fields there are is an aggregate
(``schema_of_variant_agg``) that merges over all rows; ``load_topic_variant`` observes it
in the pass that writes the typed rows.

Against a load with the explicit schema: a field that one file writes as a number and
another as text of that number is read from both (the explicit reader gives NULL for the
wrong kind), and a number read as text is written shortest (``1.50`` as ``1.5``). Fields
absent from a line, values that do not cast, and lines that do not parse give NULL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postflow.streaming.observed import write_observed

VALUE = "_value"


def read_topic_variant(spark: SparkSession, path: str) -> DataFrame:
    """One ``VARIANT`` column per line, with the partition columns of the topic's folders."""
    return spark.read.option("singleVariantColumn", VALUE).json(path)


def _path(name: str) -> str:
    if "'" in name:
        raise ValueError(f"a quote in field name {name!r}")
    return f"$['{name}']"


def from_variant(df: DataFrame, schema: T.StructType, column: str = VALUE) -> DataFrame:
    """``df`` with the fields of ``schema`` in place of ``column``; its other columns follow."""
    rest = [c for c in df.columns if c != column and c not in schema.fieldNames()]
    fields = [F.try_variant_get(column, _path(f.name), f.dataType.simpleString()).alias(f.name) for f in schema.fields]
    return df.select(*fields, *rest)


def load_topic_variant(spark: SparkSession, path: str, out: str, schema: T.StructType) -> tuple[DataFrame, str]:
    """Write the topic's typed rows to ``out`` and give them with the schema that all lines
    together have (as text; ``VOID`` where there is no line), both from a single pass."""
    seen = write_observed(read_topic_variant(spark, path), lambda d: from_variant(d, schema).write.parquet(out),
                          fields=F.schema_of_variant_agg(VALUE))
    return spark.read.parquet(out), seen["fields"]
