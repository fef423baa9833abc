from corvid.sources.files import (
    TEXT_TS_OPTIONS,
    load,
    parse_csv_column,
    parse_json_column,
    read_csv,
    read_glob,
    read_json,
    read_modified_window,
    read_orc,
    read_parquet,
    read_recursive,
    read_skipping_corrupt,
    read_text_lines,
    read_whole_files,
    session_conf,
    sql_on_file,
    with_declared_schema,
)
from corvid.sources.jdbc import read_jdbc, read_jdbc_method

__all__ = [
    "TEXT_TS_OPTIONS",
    "load",
    "parse_csv_column",
    "parse_json_column",
    "read_csv",
    "read_glob",
    "read_jdbc",
    "read_jdbc_method",
    "read_json",
    "read_modified_window",
    "read_orc",
    "read_parquet",
    "read_recursive",
    "read_skipping_corrupt",
    "read_text_lines",
    "read_whole_files",
    "session_conf",
    "sql_on_file",
    "with_declared_schema",
]
