"""DataFrame -> DataFrame operators."""

from postflow.operators.aggregates import (
    bucketize, count_by, exact_quantile_by, max_by_group, median_by, year_between,
)
from postflow.operators.clean import (
    clean_all, clean_geo, clean_posts, clean_users, drop_identical_records, expand_suffix_int,
    null_placeholders,
    split_column, strip_column, to_timestamp_column,
)
from postflow.operators.joins import Salt, hot_keys, left_join, null_safe_on
from postflow.operators.ranking import top_overall, top_per_group
from postflow.operators.sampling import replay_sample

__all__ = [
    "bucketize", "count_by", "exact_quantile_by", "max_by_group", "median_by", "year_between",
    "clean_all", "clean_geo", "clean_posts", "clean_users", "drop_identical_records", "expand_suffix_int",
    "null_placeholders", "split_column", "strip_column", "to_timestamp_column",
    "Salt", "hot_keys", "left_join", "null_safe_on", "replay_sample", "top_overall", "top_per_group",
]
