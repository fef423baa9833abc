"""Whole files of a local or mounted folder, listed and read by tasks.

Spark's file readers keep an entry for each file on the driver. Here the driver
knows only the folders it was given: tasks list them, deal out the names and
read the files.
"""

from __future__ import annotations

import os
import re
import unicodedata
import zlib
from itertools import islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Files that one task reads, when there are many.
FILES_PER_TASK = 4096
# Rows and bytes of a batch that goes to the JVM.
BATCH_ROWS, BATCH_BYTES = 4096, 8 << 20


def local_whole_files(spark: SparkSession, path: str, recursive: bool, levels: int) -> DataFrame | None:
    """``(path, value)`` of the files that ``spark.read.text(wholetext=True)``
    reads from ``path`` followed by ``levels`` wildcards; None where that reader
    has to do it: other file systems, folders without files, compressed files,
    and folders below those read (which may be partition columns).

    The folders are listed once here, to count the files, and again whenever
    the rows are read."""
    conf = spark._jsc.hadoopConfiguration()
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(conf)
    if fs.getUri().getScheme() != "file":
        return None
    # file names in the bytes by which the JVM finds them
    codec = spark._jvm.System.getProperty("sun.jnu.encoding") or "UTF-8"
    roots = [(s.getPath().toUri().getPath().encode(codec, "replace"),) for s in fs.globStatus(target) or []]
    if not roots:
        return None
    hadoop = spark._jvm.org.apache.hadoop
    compressed = tuple({hadoop.util.ReflectionUtils.newInstance(c, conf).getDefaultExtension().encode()
                        for c in hadoop.io.compress.CompressionCodecFactory.getCodecClasses(conf)})
    skip_missing, skip_corrupt = (
        spark.conf.get(f"spark.sql.files.ignore{x}Files").lower() == "true" for x in ("Missing", "Corrupt"))

    def in_batches(rows, **kinds):
        import pyarrow as pa

        while part := list(islice(rows, BATCH_ROWS)):
            columns = [pa.array(c, getattr(pa, kind)()) for c, kind in zip(zip(*part), kinds.values(), strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=list(kinds))

    def children(batches):
        def found():
            for batch in batches:
                for at in filter(os.path.isdir, batch.column(0).to_pylist()):
                    with os.scandir(at) as entries:
                        yield from ((e.path,) for e in entries)

        yield from in_batches(found(), at="binary")

    def hidden(name):
        return name.startswith(b"_") and b"=" not in name or name.startswith(b".") or name.endswith(b"._COPYING_")

    def files_in(folder):
        with os.scandir(folder) as entries:
            for e in entries:
                if e.is_dir():
                    if hidden(e.name) and not e.name.startswith((b"_metadata", b"_common_metadata")):
                        continue
                    if recursive:
                        yield from files_in(e.path)
                    else:
                        yield folder, e.name, True
                elif e.is_file() and not hidden(e.name):
                    yield folder, e.name, e.name.endswith(compressed)

    def listed(batches):
        def found():
            for batch in batches:
                for at in batch.column(0).to_pylist():
                    if os.path.isdir(at):
                        yield from files_in(at)
                    elif not hidden(os.path.basename(at)):
                        yield *os.path.split(at), at.endswith(compressed)

        yield from in_batches(found(), folder="binary", name="binary", odd="bool_")

    def content(folder, name):
        with open(os.path.join(folder, name), "rb") as f:
            data = f.read()
        try:
            with open(os.path.join(folder, b"." + name + b".crc"), "rb") as f:
                sums = f.read()
        except FileNotFoundError:
            return data
        # the checksum file of Hadoop's local file system
        if sums[:4] != b"crc\0" or len(sums) < 8:
            raise OSError(f"Not a checksum file: {folder!r}, {name!r}")
        step = int.from_bytes(sums[4:8], "big")
        right = b"".join(zlib.crc32(data[i:i + step]).to_bytes(4, "big") for i in range(0, len(data), step))
        if sums[8:8 + len(right)] != right:
            raise OSError(f"Checksum error: {folder!r}, {name!r}")
        return data

    def quoted(text):
        # as java.net.URI writes a path
        return re.sub(r"[^0-9A-Za-z_\-!.~'()*:@&=+$,;/]", lambda c: c[0] if c[0] > "\x7f" and unicodedata.category(
            c[0]) not in ("Cc", "Zs", "Zl", "Zp") else "".join(f"%{b:02X}" for b in c[0].encode()), text)

    def read(batches):
        import pyarrow as pa

        paths, values, size = [], [], 0

        def full():
            columns = [pa.array(paths, pa.string()), pa.array(values, pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=["path", "value"])

        for batch in batches:
            for folder, name in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                try:
                    data = content(folder, name)
                except FileNotFoundError:
                    if skip_missing:
                        continue
                    raise
                except OSError:
                    if skip_corrupt:
                        continue
                    raise
                if not data:  # Spark skips empty files
                    continue
                if paths and (size + len(data) > BATCH_BYTES or len(paths) == BATCH_ROWS):
                    yield full()
                    paths, values, size = [], [], 0
                paths.append("file:" + quoted(os.path.join(folder, name).decode(codec, "replace")))
                values.append(data)
                size += len(data)
        if paths:
            yield full()

    parallel = spark.sparkContext.defaultParallelism
    at = spark.createDataFrame(roots, "at BINARY")
    for _ in range(levels):
        at = at.mapInArrow(children, "at BINARY").repartition(parallel * 4, "at")
    found = at.mapInArrow(listed, "folder BINARY, name BINARY, odd BOOLEAN")
    files, odd = found.agg(F.count("name"), F.bool_or("odd")).first()
    if odd or not files:
        return None
    tasks = max(parallel * 2, -(-files // FILES_PER_TASK))
    named = found.select("folder", "name").repartition(tasks, "folder", "name")
    return named.mapInArrow(read, "path STRING, value BINARY").select("path", F.col("value").cast("string").alias("value"))
