"""Column expressions: cleaning rules and wire formats."""

from postflow.functions.cleaning import (
    AGE_GROUPS, AGE_OTHER, FOLLOWER_SUFFIXES, POSTS_PLACEHOLDERS, SAVE_LOCATION_PREFIX,
    TIMESTAMP_FORMAT, age_group, age_group_order, expand_suffix, join_name, null_if_matches,
    pack_array, parse_timestamp, split_list, strip_text, text_to_int,
)
from postflow.functions.envelope import decode_json, encode_rest, encode_stream, row_json

__all__ = [
    "AGE_GROUPS", "AGE_OTHER", "FOLLOWER_SUFFIXES", "POSTS_PLACEHOLDERS", "SAVE_LOCATION_PREFIX",
    "TIMESTAMP_FORMAT", "age_group", "age_group_order", "expand_suffix", "join_name",
    "null_if_matches", "pack_array", "parse_timestamp", "split_list", "strip_text", "text_to_int",
    "decode_json", "encode_rest", "encode_stream", "row_json",
]
