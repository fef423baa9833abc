"""Queries over streams.

Text streams watch a folder staged from the documents table, one
sub-folder per source (the period); event-window streams read the events
table as a file stream. Tests and checks run with an ``availableNow``
trigger so each query processes what is there and stops.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from corvid.plans.io import SQL_TEXT_LINES
from corvid.plans.registry import SQL_LINES, register
from corvid.session import scratch_path, table
from corvid.sinks.files import write_text
from corvid.sources.files import read_parquet
from corvid.streaming import folder_stream as ts
from corvid.streaming import windows as win

HOT_K = 3
WINDOW = "1 hour"
# How late an event may come: a window is complete, and its state dropped, this
# long after its end.
WATERMARK = "10 minutes"
SLIDE = "30 minutes"


def _run_period_word_counts(spark: SparkSession, sf_dir: str) -> str:
    source = scratch_path(spark, "stream-in")
    ts.stage_lines_by_period(table(spark, sf_dir, "documents"), "text", "source", source)
    sink, checkpoint = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-ck")
    query = ts.start_batch_word_counts(ts.text_stream(spark, source), sink, checkpoint)
    ts.await_query(query)
    return sink


SQL_PERIOD_WORDS = f"""
SELECT period, unnest(string_split(line, ' ')) AS word
FROM (SELECT source AS period, unnest({SQL_LINES}) AS line FROM documents)
"""


@register("str_text_source", SQL_TEXT_LINES)
def str_text_source(spark, sf_dir):
    """Lines of files arriving in a watched folder, appended to a parquet sink."""
    source = scratch_path(spark, "stream-text")
    write_text(table(spark, sf_dir, "documents").select("text"), source, "errorifexists")
    sink, checkpoint = scratch_path(spark, "stream-text-out"), scratch_path(spark, "stream-text-ck")
    lines = spark.readStream.schema("value STRING").text(source)
    query = (lines.writeStream.format("parquet").option("path", sink)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    ts.await_query(query)
    return read_parquet(spark, sink)


@register("str_restart", SQL_TEXT_LINES)
def str_restart(spark, sf_dir):
    """The same stream started twice on one checkpoint: the second run finds
    every file already committed and adds no rows."""
    source = scratch_path(spark, "stream-restart")
    write_text(table(spark, sf_dir, "documents").select("text"), source, "errorifexists")
    sink, checkpoint = scratch_path(spark, "restart-out"), scratch_path(spark, "restart-ck")
    for _ in range(2):
        lines = spark.readStream.schema("value STRING").text(source)
        query = (lines.writeStream.format("parquet").option("path", sink)
                 .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        ts.await_query(query)
    return read_parquet(spark, sink)


@register("str_batch_wordcount", f"""
SELECT period, word, count(*) AS count FROM ({SQL_PERIOD_WORDS}) GROUP BY period, word
""")
def str_batch_wordcount(spark, sf_dir):
    """Word counts per period (empty tokens counted), merged from per-batch counts."""
    return ts.period_word_counts(spark, _run_period_word_counts(spark, sf_dir))


@register("str_batch_total", f"""
SELECT period, 'all_times:' AS label, CAST(count(*) AS BIGINT) AS total
FROM ({SQL_PERIOD_WORDS}) GROUP BY period
""")
def str_batch_total(spark, sf_dir):
    return ts.period_totals(spark, _run_period_word_counts(spark, sf_dir))


@register("str_hot_words", f"""
SELECT period, word, count, rank FROM (
  SELECT period, word, count,
         CAST(row_number() OVER (PARTITION BY period ORDER BY count DESC, word) AS BIGINT) AS rank
  FROM (SELECT period, word, count(*) AS count FROM ({SQL_PERIOD_WORDS}) GROUP BY period, word))
WHERE rank <= {HOT_K}
""")
def str_hot_words(spark, sf_dir):
    """The top words of each period."""
    counts = ts.period_word_counts(spark, _run_period_word_counts(spark, sf_dir))
    return ts.hot_words(counts, HOT_K)


def _events_window(spark, sf_dir, keys=(), value_col=None, slide=None):
    events = table(spark, sf_dir, "events")
    stream = win.table_stream(spark, sf_dir, "events", events.schema)
    if slide:
        agg = win.pane_aggregate(stream, "ts", WINDOW, slide, keys, value_col, watermark=WATERMARK)
    else:
        agg = win.windowed_aggregate(stream, "ts", WINDOW, None, keys, value_col, watermark=WATERMARK)
    sink, checkpoint = scratch_path(spark, "win-out"), scratch_path(spark, "win-ck")
    ts.await_query(win.start_update(agg, sink, checkpoint, keys, value_col))
    latest = win.latest_windows(spark, sink, keys, value_col)
    return win.windows_of_panes(latest, WINDOW, slide, keys, value_col) if slide else latest


SQL_BUCKET = "time_bucket(INTERVAL '1 hour', ts)"


@register("str_window_count", f"""
SELECT {SQL_BUCKET} AS window_start, {SQL_BUCKET} + INTERVAL '1 hour' AS window_end, count(*) AS n
FROM events GROUP BY 1, 2
""")
def str_window_count(spark, sf_dir):
    """Events per 1-hour tumbling window of event time."""
    return _events_window(spark, sf_dir)


@register("str_window_sum", f"""
SELECT {SQL_BUCKET} AS window_start, {SQL_BUCKET} + INTERVAL '1 hour' AS window_end,
       count(*) AS n, round(sum(value), 6) AS total
FROM events GROUP BY 1, 2
""")
def str_window_sum(spark, sf_dir):
    """Sum of ``value`` per 1-hour window."""
    out = _events_window(spark, sf_dir, value_col="value")
    return out.withColumn("total", F.round("total", 6))


@register("str_window_key_count", f"""
SELECT {SQL_BUCKET} AS window_start, {SQL_BUCKET} + INTERVAL '1 hour' AS window_end,
       event_type, count(*) AS n
FROM events GROUP BY 1, 2, 3
""")
def str_window_key_count(spark, sf_dir):
    """Events per type and 1-hour tumbling window."""
    return _events_window(spark, sf_dir, keys=["event_type"])


@register("str_window_key_count_sliding", """
WITH w AS (
  SELECT time_bucket(INTERVAL '30 minutes', ts) - to_minutes(CAST(30 * j AS BIGINT)) AS window_start,
         event_type
  FROM events CROSS JOIN range(2) r(j))
SELECT window_start, window_start + INTERVAL '1 hour' AS window_end, event_type, count(*) AS n
FROM w GROUP BY 1, 2, 3
""")
def str_window_key_count_sliding(spark, sf_dir):
    """Events per type over 1-hour windows sliding every 30 minutes."""
    return _events_window(spark, sf_dir, keys=["event_type"], slide=SLIDE)
