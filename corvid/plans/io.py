"""Queries over sources, sinks and the catalog.

Round-trip queries write a copy of a given table into a fresh folder under
the shared scratch directory (``spark.checkpoint.dir``), then return the
lazy read-back, so the check compares what the format stored.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from corvid.functions.text import path_segment
from corvid.operators.text import word_counts
from corvid.plans.registry import SQL_LINES, register
from corvid.session import scratch_path, table
from corvid.sinks import files as sinks
from corvid.sources import files as src

SQL_TEXT_LINES = f"SELECT unnest({SQL_LINES}) AS value FROM documents"


def _stage_text(spark: SparkSession, sf_dir: str, label: str, compression: str | None = None,
                line_sep: str | None = None) -> str:
    path = scratch_path(spark, label)
    sinks.write_text(table(spark, sf_dir, "documents").select("text"), path,
                     "errorifexists", compression, line_sep=line_sep)
    return path


@register("src_text_lines", SQL_TEXT_LINES)
def src_text_lines(spark, sf_dir):
    """Text lines from a folder of files (documents written as text)."""
    return src.read_text_lines(spark, _stage_text(spark, sf_dir, "text-lines"))


@register("src_text_linesep", "SELECT unnest(string_split(text, ',')) AS value FROM documents")
def src_text_linesep(spark, sf_dir):
    """Records ended by ``,`` instead of line ends; newlines stay in the value."""
    return src.read_text_lines(spark, _stage_text(spark, sf_dir, "text-linesep", line_sep=","), line_sep=",")


@register("src_whole_files", r"""
SELECT text || chr(10) AS text, source AS topic FROM documents
""")
def src_whole_files(spark, sf_dir):
    """One row per file, one file per document; the topic from the path
    ``…/source=<topic>/<file>``. Ids from paths are ``fn_path_segments``."""
    path = scratch_path(spark, "whole-files")
    docs = table(spark, sf_dir, "documents").select("source", "doc_id", "text")
    # one small file per document in its topic's folder (a folder per
    # document would make commit and listing grow with the documents); by the
    # hash of the unique doc_id, so a hot topic is written by all tasks; the
    # number is given, since so few bytes would be coalesced into one task
    writers = spark.sparkContext.defaultParallelism * 8
    sinks.write_text(docs, path, "errorifexists", partition_by=["source"], records_per_file=1,
                     deal=(writers, "doc_id"))
    files = src.read_whole_files(spark, path, levels=1)
    return files.select(
        F.col("value").alias("text"),
        F.substring_index(path_segment("path", -2), "=", -1).alias("topic"),
    )


@register("src_csv_header", "SELECT * FROM orders")
def src_csv_header(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    path = scratch_path(spark, "csv-header")
    sinks.write_csv(orders, path, header=True)
    return src.read_csv(spark, path, header=True, schema=orders.schema)


@register("src_csv_plain", """
SELECT CAST(n_nationkey AS VARCHAR) AS _c0, n_name AS _c1, CAST(n_regionkey AS VARCHAR) AS _c2
FROM nation
""")
def src_csv_plain(spark, sf_dir):
    """No header, no schema: columns ``_c0…``, all strings."""
    path = scratch_path(spark, "csv-plain")
    sinks.write_csv(table(spark, sf_dir, "nation"), path, header=False)
    return src.read_csv(spark, path)


@register("src_csv_delimiter", """
SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name, CAST(s_nationkey AS VARCHAR) AS s_nationkey,
       CAST(s_acctbal AS VARCHAR) AS s_acctbal
FROM supplier
""")
def src_csv_delimiter(spark, sf_dir):
    """``;``-separated with a header, several options at once; strings."""
    path = scratch_path(spark, "csv-semicolon")
    sinks.write_csv(table(spark, sf_dir, "supplier"), path, header=True, sep=";")
    return spark.read.options(sep=";", header=True).csv(path)


@register("src_csv_folder", "SELECT * FROM customer")
def src_csv_folder(spark, sf_dir):
    """A folder of several CSV part files read as one table."""
    customer = table(spark, sf_dir, "customer")
    path = scratch_path(spark, "csv-folder")
    sinks.write_csv(customer.repartition(4), path, header=True)
    return src.read_csv(spark, path, header=True, schema=customer.schema)


@register("src_json_lines", """
SELECT event_id, event_type, props, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS ts, user_id, value
FROM events
""")
def src_json_lines(spark, sf_dir):
    """JSON lines with the schema inferred (timestamps stay strings)."""
    path = scratch_path(spark, "json")
    sinks.write_json(table(spark, sf_dir, "events"), path)
    return src.read_json(spark, path)


@register("src_json_strings", """
SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events
""")
def src_json_strings(spark, sf_dir):
    """JSON held in a string column parsed into a struct."""
    events = table(spark, sf_dir, "events").select("event_id", "props")
    return src.parse_json_column(events, "props", "k INT").select("event_id", "parsed.k")


@register("src_csv_inferred", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def src_csv_inferred(spark, sf_dir):
    """Types inferred from the file (one more pass over it)."""
    path = scratch_path(spark, "csv-inferred")
    sinks.write_csv(table(spark, sf_dir, "nation"), path, header=True)
    return src.read_csv(spark, path, header=True, infer_schema=True)


@register("src_parquet_paths", """
SELECT r_regionkey AS "key", r_name AS "name" FROM region
UNION ALL SELECT n_nationkey, n_name FROM nation
""")
def src_parquet_paths(spark, sf_dir):
    """Several parquet paths in one read."""
    base = scratch_path(spark, "parquet-paths")
    sinks.write_parquet(table(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("key"), F.col("r_name").alias("name")), f"{base}/a")
    sinks.write_parquet(table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("key"), F.col("n_name").alias("name")), f"{base}/b")
    return src.read_parquet(spark, f"{base}/a", f"{base}/b")


@register("src_parquet", "SELECT * FROM lineitem")
def src_parquet(spark, sf_dir):
    """Generic ``load`` (default format parquet)."""
    return src.load(spark, f"{sf_dir.rstrip('/')}/lineitem.parquet")


@register("src_sql_on_file", "SELECT * FROM part")
def src_sql_on_file(spark, sf_dir):
    return src.sql_on_file(spark, "parquet", f"{sf_dir.rstrip('/')}/part.parquet")


@register("src_recursive", "SELECT n_nationkey, n_name FROM nation")
def src_recursive(spark, sf_dir):
    """Files in nested ``n_regionkey=…`` folders read recursively: the folder
    names do not become a column."""
    path = scratch_path(spark, "nested")
    sinks.write_parquet(table(spark, sf_dir, "nation"), path, partition_by=["n_regionkey"])
    return src.read_recursive(spark, path, "parquet")


@register("src_path_glob", "SELECT * FROM region")
def src_path_glob(spark, sf_dir):
    """Only ``region.parquet`` out of the whole table folder."""
    return src.read_glob(spark, sf_dir, "region.parquet")


@register("src_modified_window", "SELECT * FROM region")
def src_modified_window(spark, sf_dir):
    """Modified before a far-future date: every file; after it: none."""
    schema = table(spark, sf_dir, "region").schema
    before = src.read_modified_window(spark, f"{sf_dir.rstrip('/')}/region.parquet", schema,
                                      modified_before="2050-07-01T08:30:00")
    after = src.read_modified_window(spark, f"{sf_dir.rstrip('/')}/region.parquet", schema,
                                     modified_after="2050-06-01T08:30:00")
    return before.unionByName(after)


@register("src_ignore_corrupt", "SELECT * FROM region")
def src_ignore_corrupt(spark, sf_dir):
    """Parquet folders where one holds JSON files (corrupt to parquet)."""
    region = table(spark, sf_dir, "region")
    base = scratch_path(spark, "corrupt")
    sinks.write_parquet(region, f"{base}/good")
    sinks.write_json(region, f"{base}/bad")
    return src.read_skipping_corrupt(spark, [f"{base}/good", f"{base}/bad"], region.schema)


@register("src_merge_schema", """
SELECT p_partkey AS single,
       CASE WHEN p_size <= 25 THEN CAST(p_size AS BIGINT) * p_size END AS "double",
       CASE WHEN p_size > 25 THEN CAST(p_size AS BIGINT) * p_size * p_size END AS triple,
       CASE WHEN p_size <= 25 THEN 1 ELSE 2 END AS "key"
FROM part
""")
def src_merge_schema(spark, sf_dir):
    """Two partition folders with different columns (squares under key=1,
    cubes under key=2), read back as one merged schema plus ``key``."""
    part = table(spark, sf_dir, "part")
    size = F.col("p_size").cast("bigint")
    base = scratch_path(spark, "merge")
    squares = part.filter(F.col("p_size") <= 25).select(
        F.col("p_partkey").alias("single"), (size * size).alias("double"))
    cubes = part.filter(F.col("p_size") > 25).select(
        F.col("p_partkey").alias("single"), (size * size * size).alias("triple"))
    sinks.write_parquet(squares, f"{base}/key=1")
    sinks.write_parquet(cubes, f"{base}/key=2")
    return src.read_parquet(spark, base, merge_schema=True)


DOC_SCHEMA = StructType([StructField(n, StringType(), True) for n in ("id", "text", "topic")])


@register("src_inline_typed", """
SELECT string_split(url, '/')[-1] AS id, html AS text, string_split(url, '/')[-2] AS topic FROM pages
""")
def src_inline_typed(spark, sf_dir):
    """Derived rows given a declared all-string schema ``(id, text, topic)``."""
    pages = table(spark, sf_dir, "pages")
    rows = pages.select(path_segment("url", -1).alias("id"), F.col("html").alias("text"),
                        path_segment("url", -2).alias("topic"))
    return src.with_declared_schema(rows, DOC_SCHEMA)


@register("src_inline_inferred", """
SELECT CAST(p_size AS BIGINT) AS single, CAST(p_size AS BIGINT) * p_size AS "double" FROM part
""")
def src_inline_inferred(spark, sf_dir):
    """Rows whose types Spark infers from the expressions (long)."""
    part = table(spark, sf_dir, "part")
    size = F.col("p_size").cast("bigint")
    return part.select(size.alias("single"), (size * size).alias("double"))


SQL_WORD_LINES = f"""
SELECT word || chr(9) || CAST(count(*) AS VARCHAR) AS value
FROM (SELECT unnest(string_split(line, ' ')) AS word
      FROM (SELECT unnest({SQL_LINES}) AS line FROM documents))
GROUP BY word
"""


@register("snk_text_overwrite", SQL_WORD_LINES)
def snk_text_overwrite(spark, sf_dir):
    """Word counts as ``word<TAB>count`` text, written twice to the same
    folder; the second run replaces the first."""
    counts = word_counts(table(spark, sf_dir, "documents").select("text"), "text")
    lines = counts.select(F.concat_ws("\t", "word", F.col("count").cast("string")).alias("value"))
    path, first = scratch_path(spark, "text-overwrite"), scratch_path(spark, "text-first")
    # counted once; what the first run wrote is what the second replaces it by
    sinks.write_text(lines, first)
    kept = src.read_text_lines(spark, first)
    sinks.write_text(kept, path, mode="overwrite")
    sinks.write_text(kept, path, mode="overwrite")
    return src.read_text_lines(spark, path)


@register("snk_parquet", "SELECT c_name, c_mktsegment FROM customer")
def snk_parquet(spark, sf_dir):
    path = scratch_path(spark, "parquet")
    table(spark, sf_dir, "customer").select("c_name", "c_mktsegment").write.save(path)
    return src.load(spark, path)


@register("snk_partitioned", "SELECT * FROM events")
def snk_partitioned(spark, sf_dir):
    """Hive-style ``event_type=…`` folders; read back with the column rebuilt."""
    path = scratch_path(spark, "partitioned")
    events = table(spark, sf_dir, "events")
    sinks.write_parquet(events, path, partition_by=["event_type"])
    # Spark reads the folder column last
    return src.read_parquet(spark, path).select(*events.columns)


def _table_name(label: str) -> str:
    return f"corvid_{label}_{uuid.uuid4().hex[:12]}"


@register("snk_partition_bucket", "SELECT * FROM customer")
def snk_partition_bucket(spark, sf_dir):
    """Table partitioned by segment and bucketed by key (42 buckets)."""
    name = _table_name("cust_pb")
    sinks.save_bucketed_table(table(spark, sf_dir, "customer"), name, scratch_path(spark, name),
                              42, "c_custkey", partition_by=["c_mktsegment"])
    return spark.table(name)


@register("snk_bucket_sorted", "SELECT * FROM lineitem")
def snk_bucket_sorted(spark, sf_dir):
    """Table bucketed by order key and sorted by line number in each bucket."""
    name = _table_name("li_bs")
    sinks.save_bucketed_table(table(spark, sf_dir, "lineitem"), name, scratch_path(spark, name),
                              42, "l_orderkey", sort_col="l_linenumber")
    return spark.table(name)


ORC_OPTIONS = {
    "orc.bloom.filter.columns": "c_mktsegment",
    "orc.dictionary.key.threshold": "1.0",
    "orc.column.encoding.direct": "c_name",
}
PARQUET_OPTIONS = {
    "parquet.bloom.filter.enabled#c_mktsegment": "true",
    "parquet.bloom.filter.expected.ndv#c_mktsegment": "1000000",
    "parquet.enable.dictionary": "true",
    "parquet.page.write-checksum.enabled": "false",
}


@register("snk_orc_options", "SELECT * FROM customer")
def snk_orc_options(spark, sf_dir):
    path = scratch_path(spark, "orc")
    sinks.write_orc(table(spark, sf_dir, "customer"), path, options=ORC_OPTIONS)
    return src.read_orc(spark, path)


@register("snk_parquet_options", "SELECT * FROM customer")
def snk_parquet_options(spark, sf_dir):
    path = scratch_path(spark, "parquet-opts")
    sinks.write_parquet(table(spark, sf_dir, "customer"), path, options=PARQUET_OPTIONS)
    return src.read_parquet(spark, path)


@register("snk_csv", "SELECT * FROM supplier")
def snk_csv(spark, sf_dir):
    supplier = table(spark, sf_dir, "supplier")
    path = scratch_path(spark, "csv-out")
    sinks.write_csv(supplier, path, header=True)
    return src.read_csv(spark, path, header=True, schema=supplier.schema)


@register("snk_text_gzip", SQL_TEXT_LINES)
def snk_text_gzip(spark, sf_dir):
    """gzip-compressed text, read back transparently."""
    return src.read_text_lines(spark, _stage_text(spark, sf_dir, "text-gzip", "gzip"))


@register("cat_drop_table", """
SELECT 'created' AS state, true AS table_exists, count(*) AS n_rows FROM region
UNION ALL SELECT 'dropped', false, NULL
""")
def cat_drop_table(spark, sf_dir):
    """Create a table, then drop it if present: whether the catalog has it,
    and its rows, after either step."""
    name = _table_name("drop")
    (table(spark, sf_dir, "region").write.format("parquet")
     .option("path", scratch_path(spark, name)).saveAsTable(name))
    states = [("created", spark.catalog.tableExists(name), spark.table(name).count())]
    sinks.drop_table(spark, name)
    sinks.drop_table(spark, name)                   # dropping what is gone is no error
    states.append(("dropped", spark.catalog.tableExists(name), None))
    return spark.createDataFrame(states, "state STRING, table_exists BOOLEAN, n_rows BIGINT")

