"""File sinks and catalog tables.

Writers never delete folders by hand: replacing an earlier run is
``mode("overwrite")``, and the default mode fails if the target exists.
Bucketed tables are written after a rebalance on the bucket column, so a task
writes the files of few buckets and a large bucket is written by several.
"""

from __future__ import annotations

import os
import re
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvid.sinks.folders import _path
from corvid.sources.files import TEXT_TS_OPTIONS


def _writer(df: DataFrame, mode: str, partition_by: Sequence[str] | None, options: dict | None):
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    clean = {k: v for k, v in (options or {}).items() if v is not None}
    return writer.options(**clean) if clean else writer


def write_text(df: DataFrame, path: str, mode: str = "overwrite",
               compression: str | None = None, partition_by: Sequence[str] | None = None,
               line_sep: str | None = None, records_per_file: int | None = None,
               deal: tuple[int, str] | None = None) -> None:
    """Text output: one string column per row (plus partition columns), ended
    by ``line_sep`` (default: a line feed). ``deal`` (tasks, column) deals the
    rows out to so many tasks by a column that is not written.
    ``gzip`` output is not splittable on read; prefer ``zstd``/``bzip2`` for
    large files that will be read back in parallel. A file for each record
    (``records_per_file`` 1) of a new local or mounted folder is written by
    ``_write_record_files``."""
    if records_per_file == 1 and mode == "errorifexists" and compression is None:
        fs, target = _path(df.sparkSession, path)
        if fs.getUri().getScheme() == "file" and not fs.exists(target):
            return _write_record_files(df, target.toUri().getPath(), partition_by or [], line_sep or "\n", deal)
    if deal:
        df = df.repartition(*deal).drop(deal[1])
    _writer(df, mode, partition_by, {"compression": compression, "lineSep": line_sep,
                                     "maxRecordsPerFile": records_per_file}).text(path)


def _write_record_files(df: DataFrame, folder: str, partition_by: Sequence[str], line_sep: str,
                        deal: tuple[int, str] | None = None) -> None:
    """One text file per row in ``column=value`` folders, laid out as Spark's
    writer does, in a folder that all tasks reach as a local path.

    Tasks create the files where they stay. Spark's local file system starts
    two ``chmod`` processes for each file, writes a checksum file beside it and
    has the driver rename them one by one.

    Rows are sorted in each partition and a file is named by its partition and
    its number there, so a task that runs again writes the same bytes
    to the same names; ``_SUCCESS`` follows when all are done. Texts that are
    dealt out travel compressed, since what is shuffled stays on disk beside
    the files."""
    value, = (c for c in df.columns if c not in (*partition_by, *(deal or ())[1:]))
    # folder names in the bytes by which the JVM finds them
    codec = df.sparkSession._jvm.System.getProperty("sun.jnu.encoding") or "UTF-8"

    def pack(batches):
        import pyarrow as pa

        zstd = pa.Codec("zstd")
        for batch in batches:
            *others, values, _ = batch.columns
            texts = [t or b"" for t in values.to_pylist()]
            columns = [pa.array([zstd.compress(t, asbytes=True) for t in texts], values.type),
                       pa.array([*map(len, texts)], pa.int64())]
            yield pa.RecordBatch.from_arrays([*others, *columns], names=batch.schema.names)

    def write(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        def escaped(name):
            return re.sub(r"""[\x01-\x1f"#%'*/:=?\\\x7f{\[\]^]""", lambda c: f"%{ord(c[0]):02X}", name)

        task, end, zstd = TaskContext.get().partitionId(), line_sep.encode(), pa.Codec("zstd")
        last, at, number = None, None, 0
        for batch in batches:
            for *key, text, size in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if at is None or key != last:
                    names = [f"{escaped(c)}={escaped(v) if v else '__HIVE_DEFAULT_PARTITION__'}"
                             for c, v in zip(partition_by, key, strict=True)]
                    last, at = key, "/".join([folder, *names]).encode(codec, "replace")
                    os.makedirs(at, exist_ok=True)
                with open(at + b"/part-%05d-%06d.txt" % (task, number), "wb") as f:
                    f.write(((text or b"") if size is None else zstd.decompress(text, size, asbytes=True)) + end)
                number += 1
        yield pa.RecordBatch.from_pydict({"files": pa.array([number], pa.int64())})

    # nulls and empty values share a folder
    names = [f"key{i}" for i in range(len(partition_by))]
    keys = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in zip(partition_by, names, strict=True)]
    # size: of a compressed text
    columns = [*keys, F.col(value).cast("binary").alias("text"), F.lit(None).cast("long").alias("size")]
    if deal:
        rows = df.select(F.xxhash64(deal[1]).alias("dealt"), *columns)
        rows = rows.mapInArrow(pack, rows.schema).repartition(deal[0], "dealt").drop("dealt")
    else:
        rows = df.select(*columns)
    os.makedirs(folder)
    rows.sortWithinPartitions(*names, "text").mapInArrow(write, "files LONG").agg(F.sum("files")).collect()
    with open(f"{folder}/_SUCCESS", "wb"):
        pass


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists",
                  partition_by: Sequence[str] | None = None,
                  options: dict[str, str] | None = None) -> None:
    """Parquet output (self-describing). ``options`` carries writer settings such
    as ``parquet.bloom.filter.enabled#col`` or ``parquet.enable.dictionary``."""
    _writer(df, mode, partition_by, options).parquet(path)


def write_orc(df: DataFrame, path: str, mode: str = "errorifexists",
              partition_by: Sequence[str] | None = None,
              options: dict[str, str] | None = None) -> None:
    """ORC output; ``options`` carries e.g. ``orc.bloom.filter.columns``."""
    _writer(df, mode, partition_by, options).orc(path)


def write_csv(df: DataFrame, path: str, header: bool = True, sep: str = ",",
              mode: str = "errorifexists", partition_by: Sequence[str] | None = None) -> None:
    opts = dict(TEXT_TS_OPTIONS)
    opts.update(header="true" if header else "false", sep=sep)
    _writer(df, mode, partition_by, opts).csv(path)


def write_json(df: DataFrame, path: str, mode: str = "errorifexists",
               partition_by: Sequence[str] | None = None) -> None:
    _writer(df, mode, partition_by, dict(TEXT_TS_OPTIONS)).json(path)


def save_bucketed_table(df: DataFrame, name: str, path: str, buckets: int, bucket_col: str,
                        sort_col: str | None = None, partition_by: Sequence[str] | None = None,
                        fmt: str = "parquet", mode: str = "errorifexists") -> None:
    """External catalog table, bucketed (and optionally sorted / partitioned).

    Joins and aggregations on ``bucket_col`` between tables bucketed the same
    way read without a shuffle. The data lives at ``path`` (a shared folder),
    not in a machine-local warehouse.

    The rows are rebalanced on the bucket column: small buckets share a task
    and a bucket above the advisory partition size is split over several, each
    writing a file of it, so a key with a third of the rows doesn't hold up
    the write. A bucket may then have several files; reads stay shuffle-free.
    """
    rebalanced = df.hint("rebalance", buckets, F.col(bucket_col))
    writer = (rebalanced.write.mode(mode).format(fmt)
              .option("path", path).bucketBy(buckets, bucket_col))
    if sort_col:
        writer = writer.sortBy(sort_col)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)


def drop_table(spark: SparkSession, name: str) -> None:
    """``DROP TABLE IF EXISTS``; for an external table the files stay."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
