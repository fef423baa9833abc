"""File sources: text, whole files, CSV, JSON, parquet, ORC and the generic
file-source options (recursive lookup, glob filter, modification-time window,
corrupt-file skipping, schema merging).

Each reader returns a lazy DataFrame; the scan is planned by Catalyst, so a
later ``select``/``filter`` prunes columns and pushes predicates into it.
Prefer a declared schema at scale: inference costs one more pass over the
input.
"""

from __future__ import annotations

from contextlib import contextmanager
from typing import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from corvid.sources.whole_files import local_whole_files

# Microsecond precision for timestamps in text formats; the writers'
# default pattern keeps only milliseconds.
TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
TEXT_TS_OPTIONS = {"timestampFormat": TS_FORMAT, "timestampNTZFormat": TS_FORMAT}

# Scan partitions that one task reads when there are very many small files.
PARTS_PER_TASK = 32


def _reader(spark: SparkSession, schema: StructType | str | None = None, **options):
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    clean = {k: v for k, v in options.items() if v is not None}
    return reader.options(**clean) if clean else reader


def read_text_lines(spark: SparkSession, *paths: str, line_sep: str | None = None,
                    path_glob: str | None = None, recursive: bool = False) -> DataFrame:
    """One row per line (``value``); a path may be a file or a folder.

    The format is called ``text`` (``txt`` does not resolve).
    """
    return _reader(spark, lineSep=line_sep, pathGlobFilter=path_glob,
                   recursiveFileLookup="true" if recursive else None).text(list(paths))


def read_whole_files(spark: SparkSession, path: str, recursive: bool = False,
                     levels: int = 0) -> DataFrame:
    """One row per file: ``(path, value)``. Files are never split, so each
    must fit in a task's memory; many small files are packed per task.

    ``levels`` > 0 reads the files ``levels`` folders below ``path`` (a
    ``<topic>/<id>/`` layout is ``levels=2``). In local or mounted folders
    tasks list and read the files (``local_whole_files``), so the driver holds
    none of their names. Elsewhere Spark's reader does it, whose driver keeps
    an entry for each file: the glob turns every leaf folder into a root path,
    and Spark lists many roots as a distributed job.
    """
    if (local := local_whole_files(spark, path, recursive, levels)) is not None:
        return local
    target = path.rstrip("/") + "/*" * levels if levels else path
    listing = str(max(1, spark.sparkContext.defaultParallelism * 4))
    with session_conf(spark, "spark.sql.sources.parallelPartitionDiscovery.parallelism", listing):
        df = _reader(spark, recursiveFileLookup="true" if recursive else None).text(
            target, wholetext=True)
    files = df.select(F.col("_metadata.file_path").alias("path"), "value")
    # Spark counts 4 MB for opening a file, which makes a task of some 30 small ones
    parts = files.rdd.getNumPartitions()
    return files.coalesce(max(1, min(parts, max(spark.sparkContext.defaultParallelism * 2, -(-parts // PARTS_PER_TASK)))))


def read_csv(spark: SparkSession, path: str | Sequence[str], header: bool = False,
             schema: StructType | str | None = None, infer_schema: bool = False,
             sep: str | None = None, **options) -> DataFrame:
    """CSV with quoting honoured. Without header the columns are ``_c0…``;
    without schema or inference every column is a string."""
    opts = dict(TEXT_TS_OPTIONS)
    opts.update(header="true" if header else "false", sep=sep,
                inferSchema="true" if (infer_schema and schema is None) else None)
    opts.update(options)
    paths = [path] if isinstance(path, str) else list(path)
    return _reader(spark, schema, **opts).csv(paths)


def read_json(spark: SparkSession, path: str | Sequence[str],
              schema: StructType | str | None = None, **options) -> DataFrame:
    """JSON lines; schema inferred when not given (one extra pass)."""
    opts = dict(TEXT_TS_OPTIONS)
    opts.update(options)
    paths = [path] if isinstance(path, str) else list(path)
    return _reader(spark, schema, **opts).json(paths)


def parse_json_column(df: DataFrame, column: str, schema: StructType | str,
                      alias: str = "parsed") -> DataFrame:
    """JSON held in a string column → a struct column (``from_json``)."""
    return df.withColumn(alias, F.from_json(F.col(column), schema))


def parse_csv_column(df: DataFrame, column: str, schema: StructType | str,
                     alias: str = "parsed", sep: str = ",") -> DataFrame:
    """Delimited text held in a string column → a struct column (``from_csv``)."""
    ddl = schema if isinstance(schema, str) else ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    return df.withColumn(alias, F.from_csv(F.col(column), ddl, {"sep": sep}))


def read_parquet(spark: SparkSession, *paths: str, merge_schema: bool = False,
                 schema: StructType | str | None = None, **options) -> DataFrame:
    """Parquet from one or several paths; ``merge_schema`` unions the part
    schemas (opt-in: it reads every footer)."""
    return _reader(spark, schema, mergeSchema="true" if merge_schema else None,
                   **options).parquet(*paths)


def read_orc(spark: SparkSession, *paths: str, **options) -> DataFrame:
    return _reader(spark, **options).orc(list(paths))


def load(spark: SparkSession, path: str | Sequence[str], fmt: str | None = None,
         schema: StructType | str | None = None, **options) -> DataFrame:
    """Generic ``spark.read.load``; the default format is parquet."""
    return spark.read.load(path, format=fmt, schema=schema, **options)


def sql_on_file(spark: SparkSession, fmt: str, path: str, columns: str = "*") -> DataFrame:
    """SQL straight on a file path: ``SELECT … FROM parquet.`path` ``."""
    return spark.sql(f"SELECT {columns} FROM {fmt}.`{path}`")


def read_recursive(spark: SparkSession, path: str, fmt: str = "parquet",
                   schema: StructType | str | None = None) -> DataFrame:
    """All files under ``path`` at any depth; partition discovery is off, so
    ``key=value`` folder names do not become columns."""
    return _reader(spark, schema, recursiveFileLookup="true").format(fmt).load(path)


def read_glob(spark: SparkSession, path: str, path_glob: str, fmt: str = "parquet",
              schema: StructType | str | None = None) -> DataFrame:
    """Only files whose name matches ``path_glob`` (partition discovery kept)."""
    return _reader(spark, schema, pathGlobFilter=path_glob).format(fmt).load(path)


def read_modified_window(spark: SparkSession, path: str, schema: StructType | str,
                         fmt: str = "parquet", modified_before: str | None = None,
                         modified_after: str | None = None) -> DataFrame:
    """Files modified inside a time window (``YYYY-MM-DDTHH:mm:ss``). The
    schema is required: an empty selection cannot be inferred."""
    return _reader(spark, schema, modifiedBefore=modified_before,
                   modifiedAfter=modified_after).format(fmt).load(path)


def read_skipping_corrupt(spark: SparkSession, paths: Sequence[str], schema: StructType | str,
                          fmt: str = "parquet") -> DataFrame:
    """Skip files that cannot be read as ``fmt``. The per-read option travels
    with the plan, so it still holds when the DataFrame runs later."""
    return _reader(spark, schema, ignoreCorruptFiles="true").format(fmt).load(list(paths))


@contextmanager
def session_conf(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """Set a session conf for the duration of a block and restore it in
    ``finally`` (use it around actions: a lazy plan run after the block does
    not see the setting)."""
    previous = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if previous is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, previous)


def with_declared_schema(df: DataFrame, schema: StructType) -> DataFrame:
    """Apply a declared schema to derived rows: cast each field by name, then
    reconcile order and nullability with ``DataFrame.to``."""
    casted = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    return casted.to(schema)
