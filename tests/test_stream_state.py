"""State and recovery of streams: compaction, panes, replayed batches."""

import pytest
from pyspark.sql import functions as F

from corvid.operators.text import word_counts
from corvid.session import table
from corvid.sinks import folders
from corvid.streaming import folder_stream as fs
from corvid.streaming import windows as win


def _same_rows(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


EVENTS = "ts timestamp_ntz, kind string, value double"


def write_events(spark, folder, files):
    """Files of five events each, two minutes from file to file."""
    rows = spark.range(files * 5).select(
        (F.col("id") / 5).cast("int").alias("file"),
        (F.lit("2024-01-01 00:00:00").cast("timestamp") + F.make_dt_interval(secs=((F.col("id") / 5).cast("int") * 120 + F.col("id") % 5)
                                                                             .cast("decimal(18,6)"))).cast("timestamp_ntz").alias("ts"),
        F.concat(F.lit("k"), F.col("id") % 2).alias("kind"), (F.col("id") * 1.5).alias("value"))
    rows.repartition(files, "file").sortWithinPartitions("ts").write.partitionBy("file").parquet(folder)
    return spark.read.schema(EVENTS + ", file int").parquet(folder)


def stream_of(spark, folder):
    return (spark.readStream.schema(EVENTS).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", "1").parquet(folder))


def test_a_sink_of_many_triggers_holds_one_folded_folder_and_the_tail(spark, workdir, monkeypatch):
    events = write_events(spark, f"{workdir}/in", 50)
    agg = win.windowed_aggregate(stream_of(spark, f"{workdir}/in"), "ts", "10 minutes", None, ["kind"], "value", "2 hours")
    sink = f"{workdir}/out"
    query = win.start_update(agg, sink, f"{workdir}/ck", ["kind"], "value")
    fs.await_query(query)
    assert len(folders.children(spark, f"{sink}/compacted")) == 1
    tail = folders.children(spark, f"{sink}/updates")
    assert 0 < len(tail) <= win.COMPACT_EVERY + 1
    want = win.flatten_window(win.windowed_aggregate(events, "ts", "10 minutes", None, ["kind"], "value"))
    cols = ["window_start", "window_end", "kind", "n", "total"]

    def result():
        return win.latest_windows(spark, sink, ["kind"], "value").select(*cols)

    assert _same_rows(result(), want.select(*cols))
    last = max(int(n.split("=")[1]) for n in tail)

    # a crash between the fold and the drop: nothing is lost or counted twice
    def crash(*_):
        raise RuntimeError("stopped here")

    monkeypatch.setattr(win, "_drop_folded", crash)
    with pytest.raises(RuntimeError):
        win.compact(spark, sink, last, ["kind"], "value")
    assert folders.children(spark, f"{sink}/updates") == tail and len(folders.children(spark, f"{sink}/compacted")) == 2
    assert _same_rows(result(), want.select(*cols))
    # a crash while it was written: the folder doesn't count
    folders.delete(spark, f"{sink}/compacted/upto={last}/_SUCCESS")
    assert _same_rows(result(), want.select(*cols))
    monkeypatch.undo()
    for _ in range(2):
        win.compact(spark, sink, last, ["kind"], "value")
        assert folders.children(spark, f"{sink}/updates") == []
        assert folders.children(spark, f"{sink}/compacted") == [f"upto={last}"]
        assert _same_rows(result(), want.select(*cols))


def test_panes_hold_one_state_row_for_each_pane_and_key(spark, workdir):
    events = write_events(spark, f"{workdir}/in", 12)
    stream = spark.readStream.schema(EVENTS).option("recursiveFileLookup", "true").parquet(f"{workdir}/in")
    states = {}
    for name, agg in (("panes", win.pane_aggregate(stream, "ts", "20 minutes", "5 minutes", ["kind"], "value", "10 hours")),
                      ("windows", win.windowed_aggregate(stream, "ts", "20 minutes", "5 minutes", ["kind"], "value", "10 hours"))):
        query = win.start_update(agg, f"{workdir}/{name}", f"{workdir}/ck-{name}", ["kind"], "value")
        fs.await_query(query)
        states[name] = max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"])
    panes = events.select(F.window("ts", "5 minutes"), "kind").distinct().count()
    assert states["panes"] == panes < states["windows"]
    got = win.windows_of_panes(win.latest_windows(spark, f"{workdir}/panes", ["kind"], "value"), "20 minutes", "5 minutes", ["kind"], "value")
    want = win.flatten_window(win.windowed_aggregate(events, "ts", "20 minutes", "5 minutes", ["kind"], "value"))
    assert _same_rows(got.select("window_start", "window_end", "kind", "n", F.round("total", 6)),
                      want.select("window_start", "window_end", "kind", "n", F.round("total", 6)))
    with pytest.raises(ValueError):
        win.pane_aggregate(stream, "ts", "20 minutes", "7 minutes")


def test_a_batch_stopped_before_its_commit_is_replayed_once(spark, sf_dir, workdir):
    docs = table(spark, sf_dir, "documents")
    fs.stage_lines_by_period(docs, "text", "source", f"{workdir}/in")
    written = []

    def stop_first(batch_id):
        written.append(batch_id)
        if len(written) == 1:
            raise RuntimeError("executor lost")

    def run():
        return fs.start_batch_word_counts(fs.text_stream(spark, f"{workdir}/in"), f"{workdir}/out", f"{workdir}/ck", after_write=stop_first)

    with pytest.raises(Exception, match="executor lost"):
        fs.await_query(run())
    assert folders.children(spark, f"{workdir}/out/counts") == ["batch_id=0"]
    fs.await_query(run())
    assert written == [0, 0]                            # the same folder, written twice
    want = word_counts(docs.select(F.col("source").alias("period"), "text"), "text", ["period"])
    cols = ["period", "word", "count"]
    assert _same_rows(fs.period_word_counts(spark, f"{workdir}/out").select(*cols), want.select(*cols))
