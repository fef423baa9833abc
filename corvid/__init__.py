"""corvid: a PySpark-native toolkit for table, text, model and stream analytics.

Every operator takes and returns DataFrames and is built from the public
DataFrame, SQL, ML and Structured Streaming APIs, so Catalyst plans it and
Spark partitions and shuffles the work.
"""

from corvid.session import build_session, scratch_path, shared_dir, table

__all__ = ["build_session", "scratch_path", "shared_dir", "table"]
