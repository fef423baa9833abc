"""Small helpers shared by the operators: written intermediate tables, null
handling and Arrow text access."""

from __future__ import annotations

import ctypes
import pickle
import uuid
from typing import Any, Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvid.session import scratch_path

# bytes that separate words: space, tab, line feed, vertical tab, form feed,
# carriage return
SPACE_BYTES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)


def written(df: DataFrame, label: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet (compressed by ``codec``, if given) in the
    shared folder and read it back.

    Cuts the lineage: executors lost later cost no recomputation of what
    stands before, and every consumer reads the same rows."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path, compression=codec)
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema.fields])
    return df.sparkSession.read.schema(schema).parquet(path)


def quoted(name: str) -> Column:
    """The column of exactly this name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, or with underscores, such that ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def shared_value(spark: SparkSession, value: Any) -> Callable[[], Any]:
    """Broadcast ``value`` and return a function that gives it back in tasks.

    It is broadcast as bytes that hold the code of this package's classes too,
    so that workers which can't import the package can read it."""
    shared = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(shared.value)


def release_memory() -> None:
    """Hand freed memory of this worker back: workers are kept for later
    stages, and so would be what their pools still hold."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass                                # no such call outside glibc


def fold(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo ``modulus`` (null id: null)."""
    return F.crc32(doc_id.cast("string")) % modulus


def total_bytes(df: DataFrame, column: str) -> int:
    """UTF-8 bytes of a text column, for sizing blocks (one aggregate row)."""
    return df.agg(F.sum(F.octet_length(F.col(column)))).first()[0] or 0


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 buffer of a string column as uint8 and its row offsets
    (``len + 1``); null rows have no bytes."""
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        width = np.int64
    else:
        width = np.int32
    if column.null_count:
        column = column.fill_null("")
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], dtype=width)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data, offsets


def chunks(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes each (a longer row stands alone)."""
    rows, start = len(offsets) - 1, 0
    while start < rows:
        end = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
        end = min(max(end, start + 1), rows)
        yield start, end
        start = end


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """Bytes A-Z to a-z, all others unchanged."""
    upper = (data >= 65) & (data <= 90)
    return data + (upper.astype(np.uint8) << 5)


_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[list(SPACE_BYTES)] = True


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word ``[^\\x20\\x09-\\x0D]+`` in the rows
    ``offsets`` of ``data`` (byte positions relative to ``offsets[0]``).

    Words never reach across rows."""
    base, size = int(offsets[0]), int(offsets[-1] - offsets[0])
    if size == 0:
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = ~_IS_SPACE[data[base:base + size]]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    edges = (offsets - base)[:-1]
    edges = edges[edges < size]
    first[edges] = inside[edges]
    before = edges[edges > 0] - 1
    last[before] = inside[before]
    start = np.flatnonzero(first)
    end = np.flatnonzero(last) + 1
    row = np.searchsorted(offsets - base, start, side="right") - 1
    return start, end, row


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def block_table(docs: DataFrame, by: Column, columns: list[str], size_of: str, label: str,
                block_bytes: int = 8 << 20) -> tuple[DataFrame, int]:
    """``docs`` dealt into blocks of about ``block_bytes`` of the text column
    ``size_of`` by a hash of ``by``, as a table bucketed on ``block`` in the
    shared folder.

    Passes that work on a block together read the table again and again
    without a further shuffle of the texts. Returns it and the number of
    blocks, which follows the table's bytes."""
    spark = docs.sparkSession
    blocks = max(1, -(-total_bytes(docs, size_of) // block_bytes))
    name = f"{label}_{uuid.uuid4().hex}".replace("-", "_")
    dealt = docs.select(F.pmod(F.xxhash64(by), F.lit(blocks)).cast("int").alias("block"), *columns)
    (dealt.repartition(blocks, "block").write.bucketBy(blocks, "block").option("compression", "zstd")
     .option("path", scratch_path(spark, label)).format("parquet").saveAsTable(name))
    return spark.table(name), blocks
