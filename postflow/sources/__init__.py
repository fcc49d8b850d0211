"""Sources and sinks: JSON feeds, tables, file streams, and the test-table adapter."""

from postflow.sources.files import read_stream, read_table, read_topic, write_topic
from postflow.sources.fixtures import geo_raw, posts_raw, raw_feeds, table, users_raw

__all__ = ["read_stream", "read_table", "read_topic", "write_topic",
           "geo_raw", "posts_raw", "raw_feeds", "table", "users_raw"]
