"""Golden inputs with known outputs, rebuilt inline (see FIXTURES.md)."""

import os

import pytest
from pyspark.sql import functions as F

from corvid.operators import relational as rel
from corvid.operators.text import word_counts
from corvid.session import scratch_path
from corvid.sinks import files as sinks
from corvid.sources import files as src
from corvid.streaming import folder_stream as fs


def _write(path, name, content):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w", encoding="utf-8") as fh:
        fh.write(content)
    return os.path.join(path, name)


def test_batch_word_count(spark, workdir):
    # three lines in, eight (word, count) pairs out.
    _write(workdir, "test.txt",
           "hello hadoop hello spark\ni love hadoop and spark\ni love you hadoop and scala\n")
    lines = src.read_text_lines(spark, workdir)
    got = {r["word"]: r["count"] for r in word_counts(lines, "value").collect()}
    assert got == {"hello": 2, "hadoop": 3, "spark": 2, "i": 2, "love": 2, "and": 2,
                   "you": 1, "scala": 1}


def test_streamed_batch_counts_empty_tokens(spark, workdir):
    # one batch with 17 tokens, 12 of them empty.
    _write(os.path.join(workdir, "in", "period=t0"), "log.txt",
           "PyCharm  \nPyCharm  \nLinux  \ndistribution\n  \nInstructions\n  \n")
    sink, ck = scratch_path(spark, "g-sink"), scratch_path(spark, "g-ck")
    query = fs.start_batch_word_counts(fs.text_stream(spark, os.path.join(workdir, "in")), sink, ck)
    fs.await_query(query, 300)
    counts = {r["word"]: r["count"] for r in fs.period_word_counts(spark, sink).collect()}
    assert counts == {"": 12, "distribution": 1, "Linux": 1, "PyCharm": 2, "Instructions": 1}
    totals = fs.period_totals(spark, sink).collect()
    assert [(r["period"], r["label"], r["total"]) for r in totals] == [("t0", "all_times:", 17)]
    hot = fs.hot_words(fs.period_word_counts(spark, sink), 2).orderBy("rank").collect()
    assert [(r["word"], r["count"]) for r in hot] == [("", 12), ("PyCharm", 2)]


def test_stream_restart_adds_nothing(spark, workdir):
    _write(os.path.join(workdir, "in", "period=a"), "f1.txt", "x y\n")
    _write(os.path.join(workdir, "in", "period=b"), "f2.txt", "y z z\n")
    sink, ck = scratch_path(spark, "r-sink"), scratch_path(spark, "r-ck")
    for _ in range(2):
        fs.await_query(fs.start_batch_word_counts(
            fs.text_stream(spark, os.path.join(workdir, "in"), 1), sink, ck), 300)
    counts = sorted((r["period"], r["word"], r["count"])
                    for r in fs.period_word_counts(spark, sink).collect())
    assert counts == [("a", "x", 1), ("a", "y", 1), ("b", "y", 1), ("b", "z", 2)]
    # a new file in a later trigger is picked up once
    _write(os.path.join(workdir, "in", "period=a"), "f3.txt", "x\n")
    fs.await_query(fs.start_batch_word_counts(
        fs.text_stream(spark, os.path.join(workdir, "in"), 1), sink, ck), 300)
    counts = {(r["period"], r["word"]): r["count"]
              for r in fs.period_word_counts(spark, sink).collect()}
    assert counts[("a", "x")] == 2


MOVIES = """movieId,title,genres
1,"Weather Report: 5/7, Rain",Documentary
2,Small Harbours (1991),Crime|Drama
3,Anna K (1985),Drama|War
4,Unseen (2003),Comedy|Drama
5,Quarter Moon (2012),Drama
"""
RATINGS = """userId,movieId,rating
10,1,5.0
11,1,5.0
10,2,4.0
12,2,4.0
10,3,4.5
11,3,4.0
12,5,4.0
"""


def test_ratings_questions(spark, workdir):
    # quoted title with a comma, mean exactly 5, exactly 4, above 4, unrated.
    _write(workdir, "movies.csv", MOVIES)
    _write(workdir, "ratings.csv", RATINGS)
    movies = src.read_csv(spark, os.path.join(workdir, "movies.csv"), header=True,
                          schema="movieId INT, title STRING, genres STRING")
    ratings = src.read_csv(spark, os.path.join(workdir, "ratings.csv"), header=True,
                           schema="userId INT, movieId INT, rating DOUBLE")
    assert movies.count() == 5 and ratings.count() == 7   # header never counted
    means = rel.mean_per_key(ratings, "movieId", "rating", "avg_rating")
    assert [r["movieId"] for r in rel.having(means, "avg_rating", "=", 5).collect()] == [1]
    above = rel.having(means, "avg_rating", ">", 4)
    joined = rel.join_on_key(movies, above, "movieId").orderBy("movieId").collect()
    assert [(r["movieId"], r["title"]) for r in joined] == [
        (1, "Weather Report: 5/7, Rain"), (3, "Anna K (1985)")]
    genres = rel.multivalue_distinct(movies, "genres", "|").collect()[0][0]
    assert genres == 5
    counts = {r["movieId"]: r["n"] for r in rel.count_per_key(ratings, "movieId").collect()}
    assert counts == {1: 2, 2: 2, 3: 2, 5: 1}
    users = {r["userId"]: r["avg_value"] for r in rel.mean_per_key(ratings, "userId", "rating").collect()}
    assert users == {10: 4.5, 11: 4.5, 12: 4.0}


def test_text_line_separator_and_whole_file(spark, workdir):
    # F7 people.txt
    path = _write(workdir, "people.txt", "Michael, 29\nAndy, 30\nJustin, 19\n")
    plain = [r["value"] for r in src.read_text_lines(spark, path).collect()]
    assert plain == ["Michael, 29", "Andy, 30", "Justin, 19"]
    by_comma = [r["value"] for r in src.read_text_lines(spark, path, line_sep=",").collect()]
    assert by_comma == ["Michael", " 29\nAndy", " 30\nJustin", " 19\n"]
    whole = src.read_whole_files(spark, path).collect()
    assert len(whole) == 1 and whole[0]["value"] == "Michael, 29\nAndy, 30\nJustin, 19\n"


def test_csv_options(spark, workdir):
    # F7 people.csv
    path = _write(workdir, "people.csv", "name;age;job\nJorge;30;Developer\nBob;32;Developer\n")
    plain = src.read_csv(spark, path)
    assert plain.columns == ["_c0"] and plain.count() == 3
    split = src.read_csv(spark, path, sep=";")
    assert split.columns == ["_c0", "_c1", "_c2"] and split.count() == 3
    header = src.read_csv(spark, path, header=True, sep=";", infer_schema=True)
    assert header.columns == ["name", "age", "job"]
    assert sorted((r["name"], r["age"]) for r in header.collect()) == [("Bob", 32), ("Jorge", 30)]


def test_json_people_and_nested(spark, workdir):
    path = _write(workdir, "people.json",
                  '{"name":"Michael"}\n{"name":"Andy", "age":30}\n{"name":"Justin", "age":19}\n')
    people = src.read_json(spark, path)
    assert dict((f.name, f.dataType.simpleString()) for f in people.schema.fields) == {
        "age": "bigint", "name": "string"}
    people.createOrReplaceTempView("people_fixture")
    teen = spark.sql("SELECT name FROM people_fixture WHERE age BETWEEN 13 AND 19").collect()
    assert [r["name"] for r in teen] == ["Justin"]
    strings = spark.createDataFrame(
        [('{"name":"Yin","address":{"city":"Columbus","state":"Ohio"}}',)], "value STRING")
    parsed = src.parse_json_column(strings, "value",
                                   "name STRING, address STRUCT<city: STRING, state: STRING>")
    row = parsed.select("parsed.name", "parsed.address.city", "parsed.address.state").first()
    assert tuple(row) == ("Yin", "Columbus", "Ohio")


def test_merge_schema_squares_cubes(spark, workdir):
    base = os.path.join(workdir, "test_table")
    spark.range(1, 6).select(F.col("id").alias("single"), (F.col("id") ** 2).cast("long").alias("double")) \
        .write.parquet(os.path.join(base, "key=1"))
    spark.range(6, 11).select(F.col("id").alias("single"), (F.col("id") ** 3).cast("long").alias("triple")) \
        .write.parquet(os.path.join(base, "key=2"))
    merged = src.read_parquet(spark, base, merge_schema=True)
    assert sorted((f.name, f.dataType.simpleString()) for f in merged.schema.fields) == [
        ("double", "bigint"), ("key", "int"), ("single", "bigint"), ("triple", "bigint")]
    assert merged.count() == 10


def test_corrupt_recursive_glob_modified(spark, workdir):
    dir1 = os.path.join(workdir, "dir1")
    spark.createDataFrame([("file1.parquet",)], "file STRING").write.parquet(os.path.join(dir1, "a"))
    spark.createDataFrame([("file2.parquet",)], "file STRING").write.parquet(
        os.path.join(dir1, "dir2", "b"))
    _write(dir1, "file3.json", '{"file": "corrupt"}\n')
    schema = "file STRING"
    skipped = src.read_skipping_corrupt(spark, [os.path.join(dir1, "a"), os.path.join(dir1, "dir2", "b"),
                                                os.path.join(dir1, "file3.json")], schema)
    assert sorted(r["file"] for r in skipped.collect()) == ["file1.parquet", "file2.parquet"]
    with src.session_conf(spark, "spark.sql.files.ignoreCorruptFiles", "true"):
        rec = src.read_recursive(spark, dir1, "parquet", schema)
        assert sorted(r["file"] for r in rec.collect()) == ["file1.parquet", "file2.parquet"]
    assert spark.conf.get("spark.sql.files.ignoreCorruptFiles") == "false"
    globbed = src.read_glob(spark, os.path.join(dir1, "a"), "*.parquet", schema=schema)
    assert [r["file"] for r in globbed.collect()] == ["file1.parquet"]
    before = src.read_modified_window(spark, os.path.join(dir1, "a"), schema,
                                      modified_before="2050-07-01T08:30:00")
    after = src.read_modified_window(spark, os.path.join(dir1, "a"), schema,
                                     modified_after="2050-06-01T08:30:00")
    assert before.count() == 1 and after.count() == 0


def test_drop_table(spark, sf_dir):
    import __spark_entry__ as entry

    rows = [tuple(r) for r in entry.queries()["cat_drop_table"](spark, sf_dir).collect()]
    assert rows == [("created", True, 5), ("dropped", False, None)]


def test_processing_time_trigger_keeps_running(spark, workdir):
    # STR-02 / STR-10: a 1 s trigger runs until stopped and picks up new files
    src_dir = os.path.join(workdir, "in")
    _write(os.path.join(src_dir, "period=a"), "f1.txt", "spark streaming\n")
    sink, ck = scratch_path(spark, "pt-sink"), scratch_path(spark, "pt-ck")
    query = fs.start_batch_word_counts(fs.text_stream(spark, src_dir), sink, ck, trigger_seconds=1)
    try:
        query.processAllAvailable()
        _write(os.path.join(src_dir, "period=a"), "f2.txt", "spark\n")
        query.processAllAvailable()
        assert query.isActive
    finally:
        query.stop()
    counts = {r["word"]: r["count"] for r in fs.period_word_counts(spark, sink).collect()}
    assert counts == {"spark": 2, "streaming": 1}


def test_append_mode_emits_closed_windows(spark, workdir):
    # watermark + append: a window is written once the watermark passes its end
    from corvid.streaming import windows as win

    schema = "ts TIMESTAMP_NTZ, kind STRING, value DOUBLE"
    folder = os.path.join(workdir, "events")
    first = spark.createDataFrame(
        [("2024-01-01 00:05:00", "a", 1.0), ("2024-01-01 00:50:00", "a", 2.0),
         ("2024-01-01 01:10:00", "b", 4.0)], "t STRING, kind STRING, value DOUBLE")
    second = spark.createDataFrame([("2024-01-01 03:00:00", "a", 8.0)],
                                   "t STRING, kind STRING, value DOUBLE")
    for i, df in enumerate([first, second]):
        df.select(F.to_timestamp_ntz("t").alias("ts"), "kind", "value").coalesce(1) \
            .write.parquet(os.path.join(folder, f"part{i}"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1) \
        .option("recursiveFileLookup", "true").parquet(folder)
    agg = win.windowed_aggregate(stream, "ts", "1 hour", keys=["kind"], value_col="value",
                                 watermark="10 minutes")
    sink, ck = scratch_path(spark, "ap-sink"), scratch_path(spark, "ap-ck")
    fs.await_query(win.start_append(agg, sink, ck), 300)
    rows = sorted((str(r["window_start"]), r["kind"], r["n"], r["total"])
                  for r in spark.read.parquet(sink).collect())
    # the 03:00 window is still open (watermark 02:50) and not written yet
    assert rows == [("2024-01-01 00:00:00", "a", 2, 3.0), ("2024-01-01 01:00:00", "b", 1, 4.0)]


def test_a_file_for_each_record_as_spark_lays_them_out(spark, workdir):
    # odd topics and texts, written by tasks and by Spark's writer; a second
    # look at the folder finds no checksum files and no renamed attempts
    rows = [(topic, text) for topic in ("a", "b=c/d", "1%2:3", " ", "", None, "src\n1")
            for text in ("one", "two\nlines", "", None, "é", "one")]
    df = spark.createDataFrame(rows, "topic STRING, value STRING").repartition(3)
    ours, theirs = os.path.join(workdir, "ours"), os.path.join(workdir, "theirs")
    sinks.write_text(df, ours, "errorifexists", partition_by=["topic"], records_per_file=1)
    df.write.option("maxRecordsPerFile", 1).partitionBy("topic").text(theirs)

    def found(path):
        files = src.read_whole_files(spark, path, levels=1).collect()
        return sorted((f["path"].rsplit("/", 2)[1], f["value"]) for f in files)

    assert found(ours) == found(theirs) and len(found(ours)) == len(rows)
    names = [n for _, _, files in os.walk(ours) for n in files]
    assert sorted(n for n in names if not n.startswith("part-")) == ["_SUCCESS"] and len(names) == len(rows) + 1
    with pytest.raises(Exception, match="already exists"):
        sinks.write_text(df, ours, "errorifexists", partition_by=["topic"], records_per_file=1)


def test_many_small_files_share_tasks(spark, workdir):
    path = os.path.join(workdir, "many")
    sinks.write_text(spark.range(3000).select(F.col("id").cast("string").alias("value")).repartition(8), path,
                     "errorifexists", records_per_file=1)
    files = src.read_whole_files(spark, path)
    assert files.rdd.getNumPartitions() <= 2 * spark.sparkContext.defaultParallelism
    assert {int(f["value"]) for f in files.collect()} == set(range(3000))


def test_tasks_list_whole_files_as_spark_does(spark, workdir):
    # the driver keeps no entry for any file; rows and paths are those of Spark's reader
    base = os.path.join(workdir, "t")
    for name in ("a b", "c%d", "é", "t=1", "_hidden", ".dot", "_h=1", "q?", "[z]", " s", "tab\t"):
        for file in ("f é%.txt", "_no", "_yes=1", ".no", "no._COPYING_", "_metadata", "g"):
            _write(os.path.join(base, name), file, name)
        _write(os.path.join(base, name), "empty", "")
    _write(base, "top.txt", "top\n")
    _write(base, "_SUCCESS", "")
    with open(os.path.join(base, "t=1", "bytes"), "wb") as f:
        f.write(b"\xff\xfe\x00")

    def rows(df):
        return sorted(tuple(r) for r in df.select("path", F.hex(F.col("value").cast("binary"))).collect())

    def spark_reads(path, **options):
        text = spark.read.options(**options).text(path, wholetext=True)
        return rows(text.select(F.col("_metadata.file_path").alias("path"), "value"))

    topics = src.read_whole_files(spark, base, levels=1)
    assert topics.inputFiles() == [] and rows(topics) == spark_reads(base + "/*") and topics.count() > 30
    every = src.read_whole_files(spark, base, recursive=True)
    assert every.inputFiles() == [] and rows(every) == spark_reads(base, recursiveFileLookup="true")
    deep = src.read_whole_files(spark, workdir, levels=2)
    assert deep.inputFiles() == [] and rows(deep) == spark_reads(workdir + "/*/*")
    one = src.read_whole_files(spark, os.path.join(base, "t=1"))
    assert one.inputFiles() == [] and rows(one) == spark_reads(os.path.join(base, "t=1"))
    globbed = src.read_whole_files(spark, os.path.join(base, "[at]*"))
    assert globbed.inputFiles() == [] and rows(globbed) == spark_reads(os.path.join(base, "[at]*"))


def test_whole_files_left_to_sparks_reader(spark, workdir):
    # compressed files, partition folders below, nothing to read
    spark.createDataFrame([("x",), ("y",)], "value STRING").coalesce(1).write.text(
        os.path.join(workdir, "gz"), compression="gzip")
    assert [r["value"] for r in src.read_whole_files(spark, os.path.join(workdir, "gz")).collect()] == ["x\ny\n"]
    _write(os.path.join(workdir, "parts", "k=1"), "f", "1")
    _write(os.path.join(workdir, "parts", "k=2"), "f", "2")
    assert {r["value"] for r in src.read_whole_files(spark, os.path.join(workdir, "parts")).collect()} == {"1", "2"}
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        src.read_whole_files(spark, os.path.join(workdir, "none"))
    os.makedirs(os.path.join(workdir, "empty"))
    assert src.read_whole_files(spark, os.path.join(workdir, "empty")).collect() == []


def test_whole_files_match_their_checksums(spark, workdir):
    path = os.path.join(workdir, "sums")
    spark.createDataFrame([("a" * 2000,)], "value STRING").coalesce(1).write.text(path)
    assert [r["value"] for r in src.read_whole_files(spark, path).collect()] == ["a" * 2000 + "\n"]
    part, = (n for n in os.listdir(path) if n.startswith("part-"))
    with open(os.path.join(path, part), "r+b") as f:
        f.seek(1500)
        f.write(b"b")
    with pytest.raises(Exception, match="Checksum error"):
        src.read_whole_files(spark, path).collect()


def test_records_dealt_out_to_tasks(spark, workdir):
    rows = [(i % 3, topic, text) for i, topic in enumerate(("a", "", None, "b=c"))
            for text in ("one", "two\nlines", "", None, "é" * 5000, "one")]
    df = spark.createDataFrame(rows, "id INT, size STRING, value STRING").coalesce(1)
    dealt, plain, theirs = (os.path.join(workdir, x) for x in ("dealt", "plain", "theirs"))
    sinks.write_text(df, dealt, "errorifexists", partition_by=["size"], records_per_file=1, deal=(4, "id"))
    sinks.write_text(df.drop("id"), plain, "errorifexists", partition_by=["size"], records_per_file=1)
    sinks.write_text(df, theirs, "overwrite", partition_by=["size"], records_per_file=1, deal=(4, "id"))

    def found(path):
        files = src.read_whole_files(spark, path, levels=1).collect()
        return sorted((f["path"].rsplit("/", 2)[1], f["value"]) for f in files)

    assert found(dealt) == found(plain) == found(theirs) and len(found(dealt)) == len(rows)
    tasks = {n.split("-")[1] for _, _, files in os.walk(dealt) for n in files if n.startswith("part-")}
    assert len(tasks) > 1
