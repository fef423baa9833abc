"""Windowed counts and sums over an event-time column of a stream.

Tumbling windows (``slide`` omitted) and sliding windows are
``groupBy(window(ts, duration, slide), keys…)`` on the stream; the state
store keeps one aggregate per open window and key. Sliding windows can be kept
as panes of the slide instead (``pane_aggregate``): one state row per pane and
key, added up when windows are read.

Output modes, both with a watermark so that state stays bounded:
* ``update``: every batch writes the windows it changed under its own batch
  id, replacing that batch's folder if it is replayed; the latest row of each
  window is its result, so windows still open are there too. Committed batches
  are folded into one folder from time to time.
* ``append`` with a watermark (production): a window is emitted once the
  watermark passes its end and its state is dropped, so state stays bounded.
  ``withWatermark`` needs a ``timestamp`` column; ``timestamp_ntz`` input is
  cast (session time zone) and the window bounds are cast back.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from corvid.sinks.folders import children, committed, delete


def table_stream(spark: SparkSession, folder: str, name: str, schema: StructType,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream the parquet files named ``<name>.parquet`` in ``folder`` (a table
    folder may hold other tables too)."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(folder)


def windowed_aggregate(stream: DataFrame, time_col: str, duration: str, slide: str | None = None,
                       keys: Sequence[str] = (), value_col: str | None = None,
                       watermark: str | None = None) -> DataFrame:
    """``(window, keys…, n[, total])`` per window (and key)."""
    df = stream
    if watermark:
        df = df.withColumn(time_col, F.col(time_col).cast("timestamp")).withWatermark(time_col, watermark)
    win = F.window(time_col, duration, slide) if slide else F.window(time_col, duration)
    aggs = [F.count(F.lit(1)).alias("n")]
    if value_col:
        aggs.append(F.sum(value_col).alias("total"))
    return df.groupBy(win.alias("window"), *keys).agg(*aggs)


def flatten_window(df: DataFrame, ntz: bool = True) -> DataFrame:
    """``window`` struct → ``window_start``, ``window_end`` columns."""
    start, end = F.col("window.start"), F.col("window.end")
    if ntz:
        start, end = start.cast("timestamp_ntz"), end.cast("timestamp_ntz")
    rest = [c for c in df.columns if c != "window"]
    return df.select(start.alias("window_start"), end.alias("window_end"), *rest)


# Batches between two compactions of an update sink.
COMPACT_EVERY = 10


def start_update(agg: DataFrame, sink: str, checkpoint: str, keys: Sequence[str] = (), value_col: str | None = None,
                 trigger_seconds: float | None = None, compact_every: int = COMPACT_EVERY) -> StreamingQuery:
    """Update mode into ``sink/updates/batch_id=<id>``: a batch holds the new
    values of the windows it changed, and a replayed batch overwrites only
    itself. Every ``compact_every`` batches the committed ones are folded
    together (``compact``), so the sink doesn't grow with the stream's age."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        if batch_id and batch_id % compact_every == 0:
            # a batch starts only after the one before was committed
            compact(batch.sparkSession, sink, batch_id - 1, keys, value_col)
        flatten_window(batch).write.mode("overwrite").parquet(f"{sink}/updates/batch_id={batch_id}")

    writer = (agg.writeStream.outputMode("update").foreachBatch(handle)
              .option("checkpointLocation", checkpoint))
    writer = (writer.trigger(processingTime=f"{trigger_seconds} seconds") if trigger_seconds
              else writer.trigger(availableNow=True))
    return writer.start()


def _numbers(spark: SparkSession, folder: str, prefix: str) -> list[int]:
    """Numbers of the committed folders ``<prefix>=<number>``, ascending."""
    found = [int(n.removeprefix(f"{prefix}=")) for n in children(spark, folder) if n.startswith(f"{prefix}=")]
    return sorted(n for n in found if committed(spark, f"{folder}/{prefix}={n}"))


def _latest(spark: SparkSession, sink: str, upto: int | None, keys: Sequence[str], value_col: str | None) -> DataFrame | None:
    """The last values of every window (and key), and the batch they are of:
    the newest compacted folder and the updates after it, no later than ``upto``."""
    folded = [n for n in _numbers(spark, f"{sink}/compacted", "upto") if upto is None or n <= upto]
    batches = [n for n in _numbers(spark, f"{sink}/updates", "batch_id")
               if (not folded or n > folded[-1]) and (upto is None or n <= upto)]
    parts = [spark.read.parquet(f"{sink}/compacted/upto={folded[-1]}")] if folded else []
    if batches:
        parts.append(spark.read.option("basePath", f"{sink}/updates").parquet(*[f"{sink}/updates/batch_id={n}" for n in batches])
                     .withColumn("batch_id", F.col("batch_id").cast("long")))
    if not parts:
        return None
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    values = ["n"] + (["total"] if value_col else [])
    return rows.groupBy("window_start", "window_end", *keys).agg(
        *[F.max_by(v, "batch_id").alias(v) for v in values], F.max("batch_id").alias("batch_id"))


def compact(spark: SparkSession, sink: str, upto: int, keys: Sequence[str] = (), value_col: str | None = None) -> None:
    """Fold all committed batches up to ``upto``, and what was folded before,
    into ``sink/compacted/upto=<upto>``, then drop what it replaces.

    It may be run again at any point: the folder counts only once it is
    committed, and from then on readers pass over what it replaces, whether
    that is dropped already or a crash came between the two steps."""
    folder = f"{sink}/compacted/upto={upto}"
    if not committed(spark, folder):
        latest = _latest(spark, sink, upto, keys, value_col)
        if latest is None:
            return
        latest.write.mode("overwrite").parquet(folder)
    _drop_folded(spark, sink, upto)


def _drop_folded(spark: SparkSession, sink: str, upto: int) -> None:
    for name in children(spark, f"{sink}/updates"):
        if name.startswith("batch_id=") and int(name.removeprefix("batch_id=")) <= upto:
            delete(spark, f"{sink}/updates/{name}")
    for name in children(spark, f"{sink}/compacted"):
        if name.startswith("upto=") and int(name.removeprefix("upto=")) < upto:
            delete(spark, f"{sink}/compacted/{name}")


def latest_windows(spark: SparkSession, sink: str, keys: Sequence[str] = (),
                   value_col: str | None = None) -> DataFrame:
    """The current result of ``start_update``: for every window (and key) the
    values of the last batch that changed it. Read it between triggers, or
    again if a compaction dropped a folder meanwhile."""
    found = _latest(spark, sink, None, keys, value_col)
    if found is None:
        raise ValueError(f"no committed batch in {sink}")
    return found.drop("batch_id")


def pane_aggregate(stream: DataFrame, time_col: str, duration: str, slide: str, keys: Sequence[str] = (),
                   value_col: str | None = None, watermark: str | None = None) -> DataFrame:
    """State of sliding windows as panes: tumbling windows of the slide's
    length (which must divide the duration). Each event changes one pane and
    key, however many windows it lies in; ``windows_of_panes`` adds the panes
    up when the result is read.

    An event later than the watermark allows is dropped with its pane, also
    where a sliding window over it would still be open."""
    if _seconds(duration) % _seconds(slide):
        raise ValueError(f"the slide {slide} does not divide the duration {duration}")
    return windowed_aggregate(stream, time_col, slide, None, keys, value_col, watermark)


def windows_of_panes(panes: DataFrame, duration: str, slide: str, keys: Sequence[str] = (),
                     value_col: str | None = None) -> DataFrame:
    """``window_start, window_end, keys…, n[, total]`` of the sliding windows
    from the values of their panes: each pane is read once for each of the
    duration / slide windows over it, and added in the partial aggregate."""
    step, width = _seconds(slide), _seconds(duration)
    starts = F.transform(F.sequence(F.lit(0), F.lit(width // step - 1)),
                         lambda j: F.col("window_start") - F.make_dt_interval(secs=(j * step).cast("decimal(18,6)")))
    wide = panes.select(F.explode(starts).alias("start"), *keys, "n", *(["total"] if value_col else []))
    aggs = [F.sum("n").cast("long").alias("n")] + ([F.sum("total").alias("total")] if value_col else [])
    sums = wide.groupBy("start", *keys).agg(*aggs)
    end = F.col("start") + F.make_dt_interval(secs=F.lit(width).cast("decimal(18,6)"))
    return sums.select(F.col("start").alias("window_start"), end.alias("window_end"), *[c for c in sums.columns if c != "start"])


_UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def _seconds(text: str) -> int:
    """Seconds of an interval such as ``30 minutes``."""
    count, unit = text.split()
    return int(count) * _UNITS[unit.rstrip("s")]


def start_append(agg: DataFrame, sink: str, checkpoint: str,
                 trigger_seconds: float | None = None) -> StreamingQuery:
    """Append mode (needs a watermark) into a parquet file sink; the sink's
    commit log makes the output exactly once across restarts."""
    out = flatten_window(agg)
    writer = (out.writeStream.outputMode("append").format("parquet")
              .option("path", sink).option("checkpointLocation", checkpoint))
    writer = (writer.trigger(processingTime=f"{trigger_seconds} seconds") if trigger_seconds
              else writer.trigger(availableNow=True))
    return writer.start()
