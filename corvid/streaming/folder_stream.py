"""Word counts on a folder of text files, per period.

A period is the folder a file lands in (``…/period=<name>/``), so results
repeat from run to run; micro-batch boundaries do not follow file names.
Each micro-batch is processed by ``foreachBatch``: its word counts are
written to ``<sink>/counts/batch_id=<id>`` with ``overwrite``, so a batch
replayed after a failure replaces its own output (exactly once per batch).
Batch results are then merged per period on read.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.utils import AnalysisException

from corvid.operators.relational import top_k_per_group
from corvid.operators.text import word_counts

LINE_SCHEMA = "value STRING, period STRING"
COUNT_SCHEMA = "period STRING, word STRING, count BIGINT, batch_id INT"


def stage_lines_by_period(df: DataFrame, text_col: str, period_col: str, path: str) -> None:
    """Write a text column as files under ``path/period=<value>/``."""
    (df.select(F.col(text_col).alias("value"), F.col(period_col).cast("string").alias("period"))
     .write.mode("errorifexists").partitionBy("period").text(path))


def text_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Watch ``path`` for new text files; rows are ``(value, period)``."""
    reader = spark.readStream.schema(LINE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.text(path)


def await_query(query: StreamingQuery, limit_s: float | None = None) -> None:
    """Wait for the query's end: without a limit, unless the caller gives one."""
    if limit_s is None:
        query.awaitTermination()
    elif not query.awaitTermination(limit_s):
        query.stop()
        raise TimeoutError(f"streaming query {query.name or query.id} did not finish in {limit_s}s")
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def start_batch_word_counts(lines: DataFrame, sink: str, checkpoint: str,
                            trigger_seconds: float | None = None, drop_empty: bool = False,
                            after_write: Callable[[int], None] | None = None) -> StreamingQuery:
    """Stateless per-batch word counts (tokens split on one space, empty
    tokens kept), written per batch id.

    ``trigger_seconds`` runs continuously on a processing-time trigger (the
    reference used 1 s batches); ``None`` processes what is there and stops.
    ``after_write`` is called with the batch id between the write and the
    commit of a batch (for progress reports and fault tests): if it fails, the
    batch is replayed after a restart and overwrites its own folder.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        counts = word_counts(batch, "value", ["period"], by_lines=False, drop_empty=drop_empty)
        counts.write.mode("overwrite").parquet(f"{sink}/counts/batch_id={batch_id}")
        if after_write:
            after_write(batch_id)

    writer = lines.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    if trigger_seconds:
        writer = writer.trigger(processingTime=f"{trigger_seconds} seconds")
    else:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def batch_counts(spark: SparkSession, sink: str) -> DataFrame:
    """The per-batch counts written so far (empty if no batch ran)."""
    try:
        return spark.read.parquet(f"{sink}/counts")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], COUNT_SCHEMA)


def period_word_counts(spark: SparkSession, sink: str) -> DataFrame:
    """``(period, word, count)``: batch counts merged per period."""
    return (batch_counts(spark, sink).groupBy("period", "word")
            .agg(F.sum("count").cast("bigint").alias("count")))


def period_totals(spark: SparkSession, sink: str, label: str = "all_times:") -> DataFrame:
    """``(period, label, total)``: all words per period."""
    return (batch_counts(spark, sink).groupBy("period")
            .agg(F.sum("count").cast("bigint").alias("total"))
            .select("period", F.lit(label).alias("label"), "total"))


def hot_words(counts: DataFrame, k: int = 3, buckets: int = 32) -> DataFrame:
    """Top ``k`` words per period by count (ties by word), exact, without
    ranking a whole period in one task."""
    return top_k_per_group(counts, ["period"], [F.col("count").desc(), F.col("word").asc()],
                           k, spread_cols=["word"], buckets=buckets)
