"""Properties of the queries whose values depend on seeds or fitting, and
brute-force checks of the custom operators."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import __spark_entry__ as entry
from corvid.operators import relational as rel
from corvid.session import table

Q = entry.queries()


def test_sample_n_exact_and_repeatable(spark, sf_dir):
    a = Q["smp_n_rows"](spark, sf_dir)
    b = Q["smp_n_rows"](spark, sf_dir)
    keys = ["l_orderkey", "l_linenumber"]
    assert a.count() == 100
    assert a.select(*keys).exceptAll(b.select(*keys)).count() == 0
    lineitem = table(spark, sf_dir, "lineitem")
    assert a.join(lineitem, keys, "left_anti").count() == 0


def test_sample_fraction_is_a_subset(spark, sf_dir):
    lineitem = table(spark, sf_dir, "lineitem")
    s = Q["smp_fraction"](spark, sf_dir)
    n, total = s.count(), lineitem.count()
    assert 0 < n < 0.05 * total
    assert s.exceptAll(lineitem).count() == 0


def test_train_test_split_disjoint_complete(spark, sf_dir):
    split = Q["smp_train_test_split"](spark, sf_dir)
    docs = table(spark, sf_dir, "documents")
    assert split.count() == docs.count()
    assert split.select("doc_id").distinct().count() == docs.count()
    train = split.filter(F.col("split") == "train").count()
    assert 0.7 < train / docs.count() < 0.9
    again = Q["smp_train_test_split"](spark, sf_dir)
    assert split.exceptAll(again).count() == 0


def _brute_top_k(df, k):
    w = Window.partitionBy("g").orderBy(F.col("v").desc(), F.col("id"))
    return df.withColumn("rank", F.row_number().over(w).cast("bigint")).filter(F.col("rank") <= k)


def test_top_k_per_group_with_a_hot_group(spark):
    # one group holds most of the rows; the salted two-stage top-k must agree
    # with ranking every group whole
    df = spark.range(0, 20000).select(
        F.when(F.col("id") % 3 == 0, F.lit("other")).otherwise(F.lit("hot")).alias("g"),
        F.col("id"), (F.col("id") * 7919 % 1000).alias("v"))
    got = rel.top_k_per_group(df, ["g"], [F.col("v").desc(), F.col("id")], 5, ["id"], buckets=16)
    assert sorted(got.collect()) == sorted(_brute_top_k(df, 5).collect())


def test_text_kmeans_predictions(spark, sf_dir):
    pred = Q["ml_text_kmeans"](spark, sf_dir)
    values = [r["prediction"] for r in pred.collect()]
    assert values and all(0 <= v < 3 for v in values)
    test_docs = Q["smp_train_test_split"](spark, sf_dir).filter(F.col("split") == "test").count()
    assert len(values) == test_docs


def test_cluster_centers(spark, sf_dir):
    centers = Q["ml_cluster_centers"](spark, sf_dir).collect()
    assert len(centers) == 3 and all(len(r["center"]) == 1000 for r in centers)


def test_k_sweep(spark, sf_dir):
    rows = Q["ml_k_sweep"](spark, sf_dir).orderBy("k").collect()
    assert [r["k"] for r in rows] == list(range(2, 10))
    for r in rows:
        assert r["silhouette"] is None or -1.0 <= r["silhouette"] <= 1.0
    costs = [r["training_cost"] for r in rows]
    assert costs[-1] >= 0 and all(a >= b for a, b in zip(costs, costs[1:], strict=False))


def test_idf_vectors(spark, sf_dir):
    # ln((N + 1) / (df + 1)) per bucket, recomputed in SQL from the hashed
    # term frequencies of every document
    from pyspark.ml.functions import vector_to_array

    from corvid.operators.text import filtered_tokens, hashed_tf

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    tf = hashed_tf(filtered_tokens(docs, "text"), "filtered", 1000)
    cells = (tf.select("doc_id", F.posexplode(vector_to_array("rawFeatures")).alias("bucket", "tf"))
             .filter("tf > 0"))
    idf = cells.groupBy("bucket").agg(F.log((docs.count() + 1) / (F.count(F.lit(1)) + 1)).alias("idf"))
    want = (cells.join(idf, "bucket").groupBy("doc_id")
            .agg(F.sum(F.when(F.col("idf") != 0, 1).otherwise(0)).alias("n"),
                 F.sum(F.col("tf") * F.col("idf")).alias("s")))
    got = Q["txt_idf_vectors"](spark, sf_dir)
    assert got.count() == docs.count()
    both = got.join(want, "doc_id", "left")
    wrong = (F.col("n_nonzero") != F.coalesce("n", F.lit(0))) | (
        F.abs(F.col("tfidf_sum") - F.coalesce("s", F.lit(0.0))) > 1e-6 * (1 + F.abs(F.col("tfidf_sum"))))
    assert both.filter(wrong).count() == 0


def _test_features(spark, sf_dir):
    """TF-IDF vectors of the test split, with IDF of the training split, by numpy."""
    import numpy as np
    from pyspark.ml.functions import vector_to_array

    from corvid.operators.relational import train_test
    from corvid.operators.text import filtered_tokens, hashed_tf

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    tf = hashed_tf(filtered_tokens(docs, "text"), "filtered", 1000)
    train, test = (x.select("doc_id", vector_to_array("rawFeatures").alias("tf")).collect()
                   for x in train_test(tf, ["doc_id"], 0.8, 12345))
    x = np.array([r.tf for r in train])
    idf = np.log((len(x) + 1) / ((x > 0).sum(axis=0) + 1))
    return {r.doc_id: np.array(r.tf) * idf for r in test}


def test_every_document_is_in_its_nearest_cluster(spark, sf_dir):
    import numpy as np

    centers = np.array([r["center"] for r in Q["ml_cluster_centers"](spark, sf_dir).orderBy("cluster").collect()])
    features = _test_features(spark, sf_dir)
    for r in Q["ml_text_kmeans"](spark, sf_dir).collect():
        apart = ((centers - features[r.doc_id]) ** 2).sum(axis=1)
        assert apart[r.prediction] <= apart.min() * (1 + 1e-9)


def test_fits_do_not_follow_the_partitioning(spark, sf_dir):
    # the same rows dealt over 1, 2 and 7 partitions give the same centres
    from pyspark.ml.feature import IDF

    from corvid.operators import ml
    from corvid.operators.text import filtered_tokens, hashed_tf

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    tf = hashed_tf(filtered_tokens(docs, "text"), "filtered", 1000).select("doc_id", "rawFeatures")
    found = []
    for parts in (1, 2, 7):
        rows = ml.in_fit_order(tf.repartition(parts), "doc_id")
        model = ml.fit_staged([IDF(inputCol="rawFeatures", outputCol="features"), ml.kmeans(3, 1)], rows)
        found.append(model.stages[-1].clusterCenters())
    for other in found[1:]:
        assert all(abs(a - b).max() <= 1e-9 * max(1.0, abs(a).max()) for a, b in zip(found[0], other))


def test_plain_clusters(spark, sf_dir):
    rows = Q["ml_text_kmeans_plain"](spark, sf_dir).collect()
    assert len(rows) == table(spark, sf_dir, "documents").count()
    assert {r.prediction for r in rows} <= set(range(5))
    score = Q["ml_text_silhouette_plain"](spark, sf_dir).first()["silhouette"]
    assert -1.0 <= score <= 1.0


def test_silhouette_of_one_cluster_is_undefined(spark, sf_dir):
    from corvid.operators import ml

    emb = ml.array_features(table(spark, sf_dir, "embeddings"), "embedding", "features")
    assert ml.silhouette(emb.withColumn("prediction", F.lit(0.0))) is None


def test_logistic_predictions(spark, sf_dir):
    rows = Q["ml_logistic"](spark, sf_dir).collect()
    assert rows
    for r in rows:
        assert r["prediction"] in (0.0, 1.0)
        assert 0.0 <= r["p_positive"] <= 1.0
        assert r["prediction"] == (1.0 if r["p_positive"] > 0.5 else 0.0)


@pytest.mark.slow
def test_grid_cv_and_gain(spark, sf_dir):
    grid = Q["ml_grid_cv"](spark, sf_dir).collect()
    assert len(grid) == 9
    assert all(0.0 <= r["avg_auc"] <= 1.0 for r in grid)
    gain = Q["ml_tuning_gain"](spark, sf_dir).collect()
    assert len(gain) == 1 and 0.0 <= gain[0]["auc_tuned"] <= 1.0


def _same_rows(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_stream_word_counts_equal_batch(spark, sf_dir):
    # the streamed per-period counts equal the batch word count per source
    from corvid.operators.text import word_counts

    streamed = Q["str_batch_wordcount"](spark, sf_dir)
    docs = table(spark, sf_dir, "documents").select(F.col("source").alias("period"), "text")
    assert _same_rows(streamed.select("period", "word", "count"),
                      word_counts(docs, "text", ["period"]).select("period", "word", "count"))


def test_stream_windows_equal_batch(spark, sf_dir):
    from corvid.streaming.windows import flatten_window, windowed_aggregate

    events = table(spark, sf_dir, "events")
    streamed = Q["str_window_key_count_sliding"](spark, sf_dir)
    batch = flatten_window(windowed_aggregate(events, "ts", "1 hour", "30 minutes", ["event_type"]))
    cols = ["window_start", "window_end", "event_type", "n"]
    assert _same_rows(streamed.select(*cols), batch.select(*cols))


def test_updated_windows_keep_their_last_values(spark, workdir):
    # two batches change the same window; a replayed batch replaces itself
    from corvid.streaming import windows as win

    rows = spark.createDataFrame([(1, 5), (2, 7)], "batch_id int, n long").selectExpr(
        "batch_id", "n", "timestamp_ntz'2024-01-01 00:00:00' AS window_start",
        "timestamp_ntz'2024-01-01 01:00:00' AS window_end")
    for _ in range(2):
        for batch in (1, 2):
            (rows.filter(F.col("batch_id") == batch).drop("batch_id").write.mode("overwrite")
             .parquet(f"{workdir}/out/updates/batch_id={batch}"))
    assert [r["n"] for r in win.latest_windows(spark, f"{workdir}/out").collect()] == [7]


def test_missing_counts_are_empty_but_other_errors_are_not(spark, workdir):
    from pyspark.errors import AnalysisException

    from corvid.streaming import folder_stream as fs

    assert fs.batch_counts(spark, workdir).count() == 0
    spark.createDataFrame([("x",)], "value string").write.text(f"{workdir}/counts")
    with pytest.raises(Exception) as caught:
        fs.batch_counts(spark, workdir).count()
    assert not isinstance(caught.value, AnalysisException) or caught.value.getCondition() != "PATH_NOT_FOUND"


def test_fit_staged_matches_pipeline_fit(spark, sf_dir):
    # persisting before the first estimator changes the cost, not the model
    from pyspark.ml import Pipeline

    from corvid.operators import ml
    from corvid.operators.text import text_feature_stages

    docs = ml.in_fit_order(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    stages = [*text_feature_stages("text", 1000), ml.kmeans(3, 1)]
    plain = Pipeline(stages=stages).fit(docs).stages[-1].clusterCenters()
    staged = ml.fit_staged(stages, docs).stages[-1].clusterCenters()
    # per-partition sums merge in task-completion order, so allow rounding noise
    assert len(plain) == len(staged)
    assert all(abs(a - b).max() <= 1e-9 * max(1.0, abs(a).max()) for a, b in zip(plain, staged))
