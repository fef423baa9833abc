from corvid.sinks.files import (
    drop_table,
    save_bucketed_table,
    write_csv,
    write_json,
    write_orc,
    write_parquet,
    write_text,
)
from corvid.sinks.jdbc import write_jdbc, write_jdbc_method

__all__ = [
    "drop_table",
    "save_bucketed_table",
    "write_csv",
    "write_jdbc",
    "write_jdbc_method",
    "write_json",
    "write_orc",
    "write_parquet",
    "write_text",
]
