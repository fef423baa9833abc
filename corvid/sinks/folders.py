"""Folders of written results, on any file system that Spark reaches.

Spark's writers put a ``_SUCCESS`` file into a folder once a whole job is
committed; a folder without it may hold part of a result and counts as absent.
"""

from __future__ import annotations

import hashlib
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvid.session import shared_dir


def _path(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def committed(spark: SparkSession, folder: str) -> bool:
    """Whether a whole result stands in ``folder``."""
    fs, path = _path(spark, f"{folder}/_SUCCESS")
    return fs.exists(path)


def children(spark: SparkSession, folder: str) -> list[str]:
    """Names in ``folder``, sorted; none if there is no such folder."""
    fs, path = _path(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []


def delete(spark: SparkSession, folder: str) -> None:
    """Remove ``folder`` and what is in it; nothing happens if it is gone."""
    fs, path = _path(spark, folder)
    fs.delete(path, True)


def files_identity(*tables: DataFrame) -> str:
    """A name for the present contents of file-backed tables: a hash over
    path, size and modification time of their files, from one aggregate each."""
    parts = []
    for df in tables:
        file = F.xxhash64("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time")
        row = df.select(file.alias("h")).distinct().agg(F.bit_xor("h"), F.count(F.lit(1))).first()
        parts.append(f"{row[0]}:{row[1]}")
    return ",".join(parts)


def kept_result(spark: SparkSession, label: str, identity: str, compute: Callable[[], DataFrame]) -> DataFrame:
    """The result of ``compute``, worked out once for each ``identity`` (of
    inputs and parameters) and written to the application's shared folder;
    later calls read it. A run that was cut short leaves no ``_SUCCESS``, so
    its remains are overwritten."""
    name = hashlib.sha256(identity.encode()).hexdigest()[:32]
    folder = f"{shared_dir(spark).rstrip('/')}/corvid/kept/{label}-{name}"
    if not committed(spark, folder):
        compute().write.mode("overwrite").parquet(folder)
    return spark.read.parquet(folder)
