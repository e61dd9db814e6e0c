"""Sinks: Parquet, versioned marts, bucketed tables, CSV, JDBC, and the checks around a load."""

from flowmart.sinks.buckets import join_bucketed, read_bucketed, write_bucketed, write_bucketed_dim
from flowmart.sinks.content import Content, content_of
from flowmart.sinks.database import drop_jdbc, load_jdbc, verify_load
from flowmart.sinks.files import export_csv, materialize, verify_written, write_parquet
from flowmart.sinks.versions import Published, current, expire, publish, read_mart

__all__ = [
    "Content", "Published", "content_of", "current", "drop_jdbc", "expire", "export_csv", "join_bucketed", "load_jdbc", "materialize", "publish",
    "read_bucketed", "read_mart", "verify_load", "verify_written", "write_bucketed", "write_bucketed_dim", "write_parquet",
]
