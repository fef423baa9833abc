"""Grid search, kept results and label ranks against plain versions."""

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import IDF, HashingTF
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from corvid.operators import ml
from corvid.plans import text_models
from corvid.sinks import folders


def labelled(spark, rows=240):
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa rare1 rare2 rare3".split()
    data = []
    for i in range(rows):
        tokens = [words[(i * 7 + j * j) % 10] for j in range(3 + i % 5)] + ([words[10 + i % 3]] if i % 17 == 0 else [])
        data.append((i, float((i * 7919) % 5 > 1), tokens))
    return spark.createDataFrame(data, "doc_id long, label double, filtered array<string>")


def test_grid_search_equals_a_cross_validator(spark):
    train, sizes, least = labelled(spark), (8, 64), (0, 5, 60)
    got = {(r.num_features, r.min_doc_freq): r.avg_auc
           for r in ml.grid_search(train, "filtered", "doc_id", sizes, least, folds=2, seed=1).collect()}
    tf, idf = HashingTF(inputCol="filtered", outputCol="rawFeatures"), IDF(inputCol="rawFeatures", outputCol="features")
    grid = ParamGridBuilder().addGrid(tf.numFeatures, list(sizes)).addGrid(idf.minDocFreq, list(least)).build()
    cv = CrossValidator(estimator=Pipeline(stages=[tf, idf, ml.logistic()]), estimatorParamMaps=grid, numFolds=2, foldCol="fold",
                        evaluator=BinaryClassificationEvaluator(metricName="areaUnderROC", numBins=0))
    rows = ml.in_fit_order(train, "doc_id").withColumn("fold", ml.fold_of("doc_id", 2, 1)).cache()
    model = cv.fit(rows)
    want = {(p[tf.numFeatures], p[idf.minDocFreq]): m for p, m in zip(model.getEstimatorParamMaps(), model.avgMetrics, strict=True)}
    rows.unpersist()
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want)


def test_masked_idf_equals_a_fitted_one(spark):
    tf = HashingTF(inputCol="filtered", outputCol="rawFeatures", numFeatures=32).transform(labelled(spark))
    whole = IDF(inputCol="rawFeatures", outputCol="features").fit(tf)
    for least in (0, 3, 15, 1000):
        want = IDF(inputCol="rawFeatures", outputCol="features", minDocFreq=least).fit(tf).transform(tf)
        got = ml.masked_idf(whole, least).transform(tf)
        pairs = got.select("doc_id", "features").join(want.select("doc_id", F.col("features").alias("w")), "doc_id").collect()
        assert all((abs(p.features.toArray() - p.w.toArray()) < 1e-12).all() for p in pairs)


@pytest.mark.parametrize("rows", ["spread", "few", "dense"])
def test_sweep_equals_fits_one_by_one_in_shared_passes(spark, monkeypatch, rows):
    import numpy as np
    from pyspark.ml.linalg import Vectors

    random = np.random.default_rng(7)
    if rows == "few":           # fewer different rows than centres, one of them zero
        found = [Vectors.sparse(6, {}) if i % 3 else Vectors.sparse(6, {1: 0.1, 4: 3.7}) for i in range(60)]
    elif rows == "dense":
        found = [Vectors.dense(random.normal(size=6) + i % 4) for i in range(400)]
    else:
        found = [Vectors.sparse(6, sorted(random.choice(6, i % 4, replace=False).tolist()), (random.random(i % 4) * (1 + i % 9)).tolist())
                 for i in range(600)]
    data = spark.createDataFrame(list(enumerate(found)), ["doc_id", "features"])
    train = ml.in_fit_order(data.where("doc_id % 5 > 0"), "doc_id", 3)
    test, ks, passes, one = data.where("doc_id % 5 = 0"), (2, 3, 4, 5), [], ml.lloyd_pass
    monkeypatch.setattr(ml, "lloyd_pass", lambda *a: passes.append(len(a[1])) or one(*a))
    monkeypatch.setattr(ml, "BLOCK_CELLS", 60)
    got = ml.kmeans_sweep(spark, train, test, ks).orderBy("k").collect()

    train.cache()
    below, want = float("inf"), []
    for k in ks:
        fits = []
        for start in range(ml.MOST_STARTS):
            if start >= ml.STARTS and min(f[:2] for f in fits)[0] <= below:
                break
            model = ml.kmeans(k, 1 + start).fit(train)
            fits.append((model.summary.trainingCost, start, model))
        below, _, model = min(fits, key=lambda f: f[:2])
        want.append((k, ml.silhouette(model.transform(test)), below))
    train.unpersist()
    assert [r.k for r in got] == list(ks)
    for r, (_, score, cost) in zip(got, want, strict=True):
        assert r.training_cost == pytest.approx(cost, rel=1e-9, abs=1e-12)
        assert r.silhouette == (None if score is None else pytest.approx(score, rel=1e-9))
    assert passes[0] == len(ks) * ml.STARTS             # all fits in one pass


def test_the_tuning_query_reads_the_written_search(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(text_models, "GRID_NUM_FEATURES", (50, 100))
    monkeypatch.setattr(text_models, "GRID_MIN_DOC_FREQ", (0,))
    searches = []
    search = ml.grid_search
    monkeypatch.setattr(ml, "grid_search", lambda *a, **k: searches.append(1) or search(*a, **k))
    first = text_models.ml_grid_cv(spark, sf_dir).orderBy("num_features").collect()
    gain = text_models.ml_tuning_gain(spark, sf_dir).collect()
    assert len(searches) == 1 and len(first) == 2 and len(gain) == 1
    assert text_models.ml_grid_cv(spark, sf_dir).orderBy("num_features").collect() == first and len(searches) == 1


def test_kept_results_follow_their_identity_and_survive_a_crash(spark, workdir):
    calls = []

    def compute(value):
        def run():
            calls.append(value)
            return spark.createDataFrame([(value,)], "x int")
        return run

    label = workdir.rsplit("-", 1)[-1]
    assert [folders.kept_result(spark, label, "a", compute(1)).first().x for _ in range(2)] == [1, 1] and calls == [1]
    assert folders.kept_result(spark, label, "b", compute(2)).first().x == 2
    # a folder whose job was never committed doesn't count
    base = f"{folders.shared_dir(spark)}/corvid/kept"
    for name in folders.children(spark, base):
        if name.startswith(f"{label}-"):
            folders.delete(spark, f"{base}/{name}/_SUCCESS")
    assert folders.kept_result(spark, label, "a", compute(3)).first().x == 3
    spark.range(3).write.parquet(f"{workdir}/t")
    before = folders.files_identity(spark.read.parquet(f"{workdir}/t"))
    assert before == folders.files_identity(spark.read.parquet(f"{workdir}/t"))
    spark.range(4).write.mode("overwrite").parquet(f"{workdir}/t")
    assert before != folders.files_identity(spark.read.parquet(f"{workdir}/t"))


def test_label_ranks_of_a_million_labels(spark, monkeypatch):
    monkeypatch.setattr(ml, "LABEL_ROWS", 100_000)
    # a hot label with a third of the rows, and counts 2 and 1 below it
    rows = spark.range(1_500_000).select(
        F.when(F.col("id") < 500_000, F.lit("hot")).otherwise(F.concat(F.lit("w"), F.lpad((F.col("id") % 1_000_000).cast("string"), 7, "0"))).alias("name"))
    rows = rows.unionByName(spark.createDataFrame([("w0999999",), (None,)], "name string"))
    found = ml.string_index(rows, "name", "label")
    ranks = found.select("name", "label").distinct()
    want = (rows.where("name is not null").groupBy("name").count().orderBy(F.desc("count"), "name").limit(3).collect())
    assert [r.name for r in want[:2]] == ["hot", "w0999999"]
    got = {r.label: r.name for r in ranks.where("label < 3").collect()}
    assert got == {float(i): r.name for i, r in enumerate(want)}
    labels = ranks.where("label is not null").agg(F.count("label"), F.count_distinct("label"), F.max("label")).first()
    assert labels[0] == labels[1] == labels[2] + 1 == 1_000_000 + 1
    assert found.count() == 1_500_002 and found.where("label is null").count() == 1


def test_string_index_equals_spark_ml(spark):
    from pyspark.ml.feature import StringIndexer

    rows = spark.createDataFrame([(w,) for w in "b a c a b d e e".split()], "name string")
    want = StringIndexer(inputCol="name", outputCol="label", stringOrderType="frequencyDesc").fit(rows).transform(rows)
    assert sorted(ml.string_index(rows, "name").collect()) == sorted(want.collect())
