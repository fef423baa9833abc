"""Physical-plan shape: pruning, pushdown, partial aggregation, shuffle-free
bucketed joins, bounded top-k."""

from pyspark.sql import functions as F

import __spark_entry__ as entry
from corvid.session import scratch_path, table
from corvid.sinks.files import save_bucketed_table

Q = entry.queries()


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_is_pruned_and_filtered(spark, sf_dir):
    plan = _plan(Q["flt_row_threshold"](spark, sf_dir))
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThanOrEqual(l_quantity,45.0)]" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double>" in plan


def test_prefix_filter_pushed_as_starts_with(spark, sf_dir):
    plan = _plan(Q["flt_like_prefix"](spark, sf_dir))
    assert "StringStartsWith(p_type,S)" in plan


def test_join_reads_only_needed_columns(spark, sf_dir):
    plan = _plan(entry.entry(spark))
    assert "ReadSchema: struct<l_partkey:bigint,l_quantity:double>" in plan
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string>" in plan


def test_word_count_aggregates_before_the_shuffle(spark, sf_dir):
    plan = _plan(Q["wordcount"](spark, sf_dir))
    assert plan.count("HashAggregate") >= 2   # partial + final
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_top5_is_take_ordered(spark, sf_dir):
    plan = _plan(Q["sql_topic_top5"](spark, sf_dir))
    assert "TakeOrderedAndProject" in plan


def test_bucketed_tables_join_without_shuffle(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    lineitem = table(spark, sf_dir, "lineitem")
    a, b = "corvid_t_orders_b", "corvid_t_lineitem_b"
    spark.sql(f"DROP TABLE IF EXISTS {a}")
    spark.sql(f"DROP TABLE IF EXISTS {b}")
    save_bucketed_table(orders.withColumnRenamed("o_orderkey", "k"), a,
                        scratch_path(spark, a), 8, "k")
    save_bucketed_table(lineitem.withColumnRenamed("l_orderkey", "k"), b,
                        scratch_path(spark, b), 8, "k", sort_col="k")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table(a).join(spark.table(b), "k").groupBy("k").agg(F.count("*"))
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan
        assert joined.count() == orders.join(lineitem, orders.o_orderkey == lineitem.l_orderkey) \
            .select("o_orderkey").distinct().count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))


def test_bucketed_write_splits_a_hot_key(spark, sf_dir):
    # a bucket that holds most rows is written by several tasks, and the table
    # still reads without a shuffle and keeps every row
    # (split by the writing tasks' input, so the table comes from several files)
    lineitem = table(spark, sf_dir, "lineitem")
    copy = scratch_path(spark, "hot-input")
    (lineitem.withColumn("k", F.when(F.col("l_linenumber") <= 4, F.lit(0)).otherwise(F.col("l_orderkey")))
     .repartition(6).write.parquet(copy))
    name = "corvid_t_hot_b"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    conf = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "4k",
            "spark.sql.files.maxPartitionBytes": "64k", "spark.sql.files.openCostInBytes": "64k"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        hot = spark.read.parquet(copy)
        save_bucketed_table(hot, name, scratch_path(spark, name), 8, "k")
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    back = spark.table(name)
    assert back.count() == lineitem.count()
    assert back.filter(F.col("k") == 0).count() == hot.filter(F.col("k") == 0).count()
    files = back.select(F.input_file_name().alias("f")).filter(F.col("k") == 0).distinct().count()
    assert files > 1
    plan = back.groupBy("k").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_tfidf_shuffles_tokens_once_and_spreads_a_term_of_every_document(spark):
    # without broadcasts, the term frequencies are read from their buckets by
    # aggregate and join, and the term that all documents have is in several
    from corvid.operators.text import LEAST_SALTS, tfidf_terms

    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        docs = spark.range(0, 60000, 1, 8).select(
            F.col("id").alias("doc_id"), F.array(F.lit("hot"), F.concat(F.lit("t"), F.col("id") % 997)).alias("terms"))
        out = tfidf_terms(docs, "doc_id", "terms")
        rows = out.withColumn("part", F.spark_partition_id()).collect()
        assert len(rows) == 120000
        assert {r.df for r in rows if r.term == "hot"} == {60000}
        spread = [r.part for r in rows if r.term == "hot"]
        assert len(set(spread)) > LEAST_SALTS / 2 and max(map(spread.count, set(spread))) < 60000 / 2
        plan = out._jdf.queryExecution().executedPlan().toString()
        # the document frequencies alone travel: to be added up by term, and to the join
        exchanges = [line for line in plan.split("Initial Plan")[-1].splitlines() if "Exchange hashpartitioning" in line]
        assert len(exchanges) == 2 and "SortMergeJoin" in plan
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
