"""Models on DataFrames: string indexing, k-means with silhouette and a sweep
over k, logistic regression, ROC area and grid search with cross-validation.

All fitting is Spark ML: each iteration is a distributed pass that returns
only model-sized summaries (centres, gradients) to the driver. Metrics are
scalars; they come back as one-row DataFrames.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from typing import Iterable, Sequence

import numpy as np
import pandas as pd
from py4j.protocol import Py4JJavaError
from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator, ClusteringEvaluator
from pyspark.ml.feature import IDF, ElementwiseProduct, HashingTF, IDFModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark import StorageLevel

from corvid.session import scratch_path

# Partitions of a fit's input: k-means seeding follows partitions and row
# order, so both follow the rows instead of the cluster.
FIT_ROWS = 50_000
# Rows in a file of a sweep's input; numbers in a block of its matrix products.
FILE_ROWS = 8192
BLOCK_CELLS = 2_000_000
# Labels that one range holds when they are ranked.
LABEL_ROWS = 500_000
# Seeded starts of each k of a sweep, and at most.
STARTS = 3
MOST_STARTS = 16


def fit_partitions(rows: int) -> int:
    """As many partitions as the rows ask for, the same on every cluster."""
    return max(1, -(-rows // FIT_ROWS))


def in_fit_order(features: DataFrame, key: str, partitions: int | None = None) -> DataFrame:
    """The feature rows by hash of ``key`` and sorted in each partition, so
    that a fit sees the same rows in the same places whatever the number of
    cores or the file splits. ``features`` should be a written table: its rows
    are counted first."""
    return features.repartition(partitions or fit_partitions(features.count()), key).sortWithinPartitions(key)


def fit_staged(stages: Sequence, df: DataFrame,
               storage: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> PipelineModel:
    """Fit a chain of stages like ``Pipeline.fit``, with the input of the
    first estimator persisted (memory, spilling to disk; a lost block is
    recomputed from lineage), so the transformers before it run once."""
    stages = list(stages)
    first = next((i for i, st in enumerate(stages) if isinstance(st, Estimator)), len(stages))
    data = df
    for stage in stages[:first]:
        data = stage.transform(data)
    cached = data.persist(storage)
    data = cached
    fitted = list(stages[:first])
    try:
        for i, stage in enumerate(stages[first:], start=first):
            model = stage.fit(data) if isinstance(stage, Estimator) else stage
            fitted.append(model)
            if i < len(stages) - 1:
                data = model.transform(data)
    finally:
        cached.unpersist()
    return PipelineModel(fitted)


def label_ranks(df: DataFrame, input_col: str, output_col: str = "label") -> DataFrame:
    """Every distinct label with its index by descending frequency, ties
    alphabetical (0.0 = most frequent), as a written table.

    Labels are ranked where they stand: sorted by ranges, numbered inside each
    range and offset by the ranges before (a row for each range); no label
    reaches the driver."""
    spark = df.sparkSession

    def written(table: DataFrame, name: str) -> DataFrame:
        path = scratch_path(spark, name)
        table.write.parquet(path)
        return spark.read.parquet(path)

    counts = written(df.where(F.col(input_col).isNotNull()).groupBy(input_col).agg(F.count(F.lit(1)).alias("_n")), "label-counts")
    order = [F.desc("_n"), F.col(input_col)]
    ranges = max(2, -(-counts.count() // LABEL_ROWS))
    dealt = written(counts.repartitionByRange(ranges, *order).sortWithinPartitions(*order).select(
        input_col, F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_row")), "label-ranges")
    parts = dealt.groupBy("_part").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_size"))
    shift = F.sum("_size").over(Window.orderBy("_part")) - F.col("_size") - F.col("_first")
    shifts = parts.select("_part", shift.alias("_shift"))
    return written(dealt.join(shifts, "_part").select(input_col, (F.col("_row") + F.col("_shift")).cast("double").alias(output_col)),
                   "label-ranks")


def string_index(df: DataFrame, input_col: str, output_col: str = "label") -> DataFrame:
    """``df`` with the index of each row's label (see ``label_ranks``; a null
    label has a null index).

    The ranks are joined back as a table: Spark broadcasts it if it is small,
    and otherwise splits the partitions of hot labels, since both sides are
    shuffled for the join alone."""
    return df.join(label_ranks(df, input_col, output_col), input_col, "left").select(*df.columns, output_col)


def kmeans(k: int, seed: int = 1, features_col: str = "features",
           prediction_col: str = "prediction", max_iter: int = 20) -> KMeans:
    return KMeans(k=k, seed=seed, featuresCol=features_col, predictionCol=prediction_col,
                  maxIter=max_iter)


def silhouette(predictions: DataFrame, features_col: str = "features",
               prediction_col: str = "prediction") -> float | None:
    """Mean silhouette with squared Euclidean distance; ``None`` when the
    rows fall into fewer than two clusters (the score is undefined there).

    Spark's evaluator is linear in the rows: one pass builds per-cluster
    (count, feature sum, squared-norm sum), which is k vectors, and a second
    pass scores every point against them. It finds out itself if there is one
    cluster only.
    """
    evaluator = ClusteringEvaluator(featuresCol=features_col, predictionCol=prediction_col,
                                    metricName="silhouette", distanceMeasure="squaredEuclidean")
    try:
        return evaluator.evaluate(predictions)
    except Py4JJavaError as e:
        if "Number of clusters must be greater than one" in str(e.java_exception):
            return None
        raise


def array_features(df: DataFrame, array_col: str, output_col: str = "features") -> DataFrame:
    """``array<float>`` column → ML dense vector column."""
    return df.withColumn(output_col, array_to_vector(F.col(array_col)))


def cluster_centers(spark: SparkSession, model: KMeansModel) -> DataFrame:
    """Cluster centres as rows ``(cluster, center array)``; k rows."""
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    return spark.createDataFrame(rows, "cluster INT, center ARRAY<DOUBLE>")


def sparse_rows(features: DataFrame, features_col: str = "features") -> DataFrame:
    """The vectors as a written table of their entries other than zero: the
    ``places`` (int32) and ``amounts`` (double) of a row as bytes. Passes read
    whole batches of it as arrays; a file holds ``FILE_ROWS`` rows, so that a
    pass spreads over more tasks than a fit's input has partitions."""
    def pack(batches):
        import pyarrow as pa

        def cells(data, width, ends):
            offsets = (ends * width).astype(np.int32)
            return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)])

        for batch in batches:
            if batch.num_rows:
                dense = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                row, place = np.nonzero(dense)
                ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(dense)))])
                yield pa.RecordBatch.from_arrays([cells(place.astype(np.int32), 4, ends),
                                                  cells(np.ascontiguousarray(dense[row, place]), 8, ends)],
                                                 ["places", "amounts"])

    path = scratch_path(features.sparkSession, "sparse-rows")
    packed = features.select(vector_to_array(F.col(features_col))).mapInArrow(pack, "places BINARY, amounts BINARY")
    packed.write.option("maxRecordsPerFile", FILE_ROWS).parquet(path)
    return features.sparkSession.read.parquet(path)


def lloyd_pass(rows: DataFrame, models: Sequence[np.ndarray]) -> list[tuple[float, np.ndarray, np.ndarray]]:
    """For each model (its centres as rows) the cost of all ``rows`` at their
    nearest centres, and the number and the sum of every centre's rows.

    One pass serves all models: distances and sums are two matrix products for
    each block. Sums are added up by centre, and a row for each centre reaches
    the driver."""
    dims = models[0].shape[1]
    ends = np.cumsum([len(m) for m in models])
    shared = rows.sparkSession.sparkContext.broadcast(np.vstack(models))
    block = max(1, BLOCK_CELLS // dims)

    def assign(batches):
        import pyarrow as pa

        centers = shared.value
        squares = np.einsum("ij,ij->i", centers, centers)
        sums, sizes, costs = np.zeros_like(centers), np.zeros(len(centers)), np.zeros(len(centers))

        def cells(column, kind):
            offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
            data = column.buffers()[2]
            return np.frombuffer(data, kind, offsets[-1] // kind().itemsize) if data and offsets[-1] else np.zeros(0, kind), offsets // kind().itemsize

        for batch in batches:
            if not batch.num_rows:
                continue
            (places, starts), (amounts, first) = (cells(c, k) for c, k in zip(batch.columns, (np.int32, np.float64), strict=True))
            for top in range(0, batch.num_rows, block):
                at, start = starts[top:top + block + 1], first[top:top + block + 1]
                n = len(at) - 1
                x = np.zeros((n, dims))
                x[np.repeat(np.arange(n), np.diff(at)), places[at[0]:at[-1]]] = amounts[start[0]:start[-1]]
                norms = np.einsum("ij,ij->i", x, x)
                far = x @ centers.T
                far *= -2
                far += norms[:, None]
                far += squares
                member = np.zeros((len(centers), n))
                for low, high in zip(np.concatenate([[0], ends[:-1]]), ends, strict=True):
                    own = low + far[:, low:high].argmin(axis=1)
                    cost = far[np.arange(n), own]
                    # the difference of large numbers says little about a row near its centre
                    near = np.flatnonzero(cost <= 1e-6 * (norms + squares[own]))
                    cost[near] = ((x[near] - centers[own[near]]) ** 2).sum(axis=1)
                    member[own, np.arange(n)] = 1
                    costs += np.bincount(own, cost, len(centers))
                sums += member @ x
                sizes += member.sum(axis=1)
        yield pa.RecordBatch.from_pydict({"center": pa.array(np.arange(len(centers)), pa.int32()), "n": sizes, "cost": costs,
                                          "total": pa.array([r.tobytes() for r in sums], pa.binary())})

    def add(parts):
        import pyarrow as pa
        import pyarrow.compute as pc

        total = np.sum([np.frombuffer(t) for t in parts["total"].to_pylist()], axis=0)
        return pa.table({"center": parts["center"][:1], "n": [pc.sum(parts["n"])], "cost": [pc.sum(parts["cost"])],
                         "total": pa.array([total.tobytes()], pa.binary())})

    kind = "center INT, n DOUBLE, cost DOUBLE, total BINARY"
    found = rows.mapInArrow(assign, kind).groupBy("center").applyInArrow(add, kind).toArrow().sort_by("center")
    shared.destroy()
    sizes, costs = found["n"].to_numpy(), found["cost"].to_numpy()
    sums = np.stack([np.frombuffer(t) for t in found["total"].to_pylist()])
    return [(float(costs[e - len(m):e].sum()), sizes[e - len(m):e], sums[e - len(m):e]) for m, e in zip(models, ends, strict=True)]


def lloyd(rows: DataFrame, models: Sequence[np.ndarray], max_iter: int, tol: float) -> list[tuple[float, np.ndarray]]:
    """``(training cost, centres)`` of each model after k-means iterations as
    Spark's ``KMeans`` does them: until no centre moves by more than ``tol`` or
    for ``max_iter`` passes; a centre without rows stays; the cost is that of the
    last assignment. All models that still move share a pass."""
    fits = [(0.0, m) for m in models]
    moving = list(range(len(models)))
    for _ in range(max_iter):
        if not moving:
            break
        found = lloyd_pass(rows, [fits[i][1] for i in moving])
        still = []
        for i, (cost, sizes, sums) in zip(moving, found, strict=True):
            old = fits[i][1]
            new = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], old)
            fits[i] = cost, new
            if (((new - old) ** 2).sum(axis=1) > tol * tol).any():
                still.append(i)
        moving = still
    return fits


def nearest_centers(features: DataFrame, models: Sequence[np.ndarray], features_col: str = "features",
                    prediction_col: str = "predictions") -> DataFrame:
    """``features`` with the number of its nearest centre in each model."""
    @F.pandas_udf("array<int>")
    def nearest(vectors: pd.Series) -> pd.Series:
        own = []
        for top in range(0, len(vectors), 1000):
            x = np.stack(vectors.iloc[top:top + 1000].to_numpy())
            own.append(np.stack([((m * m).sum(axis=1) - 2 * (x @ m.T)).argmin(axis=1) for m in models], axis=1))
        return pd.Series(list(np.concatenate(own).astype(np.int32)) if own else [])

    return features.withColumn(prediction_col, nearest(vector_to_array(F.col(features_col))))


def kmeans_sweep(spark: SparkSession, train_features: DataFrame, test_features: DataFrame,
                 ks: Iterable[int], seed: int = 1, parallelism: int = 8, starts: int = STARTS) -> DataFrame:
    """``(k, silhouette, training_cost)`` for each k: of ``starts`` seeded
    fits the cheapest counts, since a single start may end in a poor optimum.
    While a k costs more than the one before, which its optimum never does,
    it gets another start, up to ``MOST_STARTS``.

    The text features are computed once and persisted (memory, spilling to
    disk; a lost block is recomputed from lineage). Every start's first centres
    are Spark's (k-means||), of as many starts at once as keep the cores busy,
    up to ``parallelism``: each holds a copy of the vectors. The iterations of
    all starts of all k share their passes over the rows (``lloyd``), so the
    passes don't grow in number with the fits.
    """
    train_features = train_features.persist(StorageLevel.MEMORY_AND_DISK)
    test_features = test_features.persist(StorageLevel.MEMORY_AND_DISK)
    fits: dict[tuple[int, int], tuple[float, np.ndarray]] = {}

    def first_centers(k: int, start: int) -> np.ndarray:
        return np.stack(kmeans(k, seed + start, max_iter=0).setSolver("row").fit(vectors).clusterCenters())

    def cheapest(more: int) -> tuple[dict[int, tuple[float, int]], list[tuple[int, int]]]:
        """The cheapest ``(cost, start)`` of each k, and the next ``more``
        starts of every k that asks for some which are not fitted yet."""
        best, wanted, below = {}, [], float("inf")
        for k in ks:
            best[k] = min((fits[k, start][0], start) for start in range(starts))
            for start in range(starts, MOST_STARTS):
                if best[k][0] <= below:
                    break
                if (k, start) not in fits:
                    wanted += [(k, s) for s in range(start, min(start + more, MOST_STARTS))]
                    break
                best[k] = min(best[k], (fits[k, start][0], start))
            below = best[k][0]
        return best, wanted

    ks = sorted(ks)
    try:
        rows, settings = sparse_rows(train_features), kmeans(2)
        # a projection counts as not persisted, so that a fit holds the vectors
        # themselves while it runs, and decodes its input once, not in each pass
        vectors = train_features.select("features")
        busy = 2 * spark.sparkContext.defaultParallelism // fit_partitions(rows.count())
        at_once = max(1, min(parallelism, busy))
        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool, ThreadPoolExecutor(max_workers=at_once) as first:
            wanted, more = [(k, start) for k in ks for start in range(starts)], 1
            while wanted:
                models = list(first.map(lambda fit: first_centers(*fit), wanted))
                fits.update(zip(wanted, lloyd(rows, models, settings.getMaxIter(), settings.getTol()), strict=True))
                best, wanted = cheapest(more)
                more *= 2
            placed = nearest_centers(test_features, [fits[k, best[k][1]][1] for k in ks]).persist(StorageLevel.MEMORY_AND_DISK)

            def score(at: int) -> float | None:
                found = silhouette(placed.select("features", F.col("predictions")[at].cast("double").alias("prediction")))
                return None if found is None else float(found)

            found = [(int(k), s, best[k][0]) for k, s in zip(ks, pool.map(score, range(len(ks))), strict=True)]
            placed.unpersist()
    finally:
        train_features.unpersist()
        test_features.unpersist()
    return spark.createDataFrame(found, "k INT, silhouette DOUBLE, training_cost DOUBLE")


def logistic(reg_param: float = 0.01, threshold: float = 0.5) -> LogisticRegression:
    return LogisticRegression(regParam=reg_param, threshold=threshold, labelCol="label", featuresCol="features")


def area_under_roc(df: DataFrame, score_col: str, label_col: str = "label",
                   num_bins: int = 0) -> float:
    """Exact ROC area when ``num_bins`` is 0: scores are sorted and the curve
    is built and integrated as distributed data; ties count one half."""
    evaluator = BinaryClassificationEvaluator(rawPredictionCol=score_col, labelCol=label_col,
                                              metricName="areaUnderROC", numBins=num_bins)
    return evaluator.evaluate(df)


def fold_of(key: str, folds: int, seed: int) -> Column:
    """A seeded hash of ``key``, so that a recomputed partition falls into the
    same folds."""
    return F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(folds)).cast("int")


def masked_idf(model: IDFModel, min_doc_freq: int) -> ElementwiseProduct:
    """The transformer that an ``IDF`` fitted with ``min_doc_freq`` would be,
    from one fitted with 0: the same weights, zero for rarer terms."""
    weights = np.where(np.asarray(model.docFreq) >= min_doc_freq, model.idf.toArray(), 0.0)
    return ElementwiseProduct(scalingVec=Vectors.dense(weights), inputCol="rawFeatures", outputCol="features")


def grid_search(train: DataFrame, tokens_col: str, key: str, num_features_grid: Sequence[int],
                min_doc_freq_grid: Sequence[int], folds: int = 2, seed: int = 1,
                parallelism: int = 8) -> DataFrame:
    """``num_features, min_doc_freq, avg_auc`` of every grid point, by k-fold
    cross-validation (area under ROC) of hashed TF, IDF and logistic regression.

    What grid points share is worked out once: tokens are hashed once for each
    ``numFeatures`` and written, document frequencies are taken once for each
    of these and fold, and every ``minDocFreq`` is a mask over them. Only the
    regressions differ; up to ``parallelism`` of them run at once."""
    spark = train.sparkSession
    rows = train.select(key, "label", tokens_col, fold_of(key, folds, seed).alias("_fold"))
    scores: dict[tuple[int, int], list[float]] = {}

    def one(training: DataFrame, validation: DataFrame, idf: IDFModel, least: int) -> float:
        scale = masked_idf(idf, least)
        model = logistic().fit(scale.transform(training).select("label", "features"))
        return area_under_roc(model.transform(scale.transform(validation)), "rawPrediction")

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        for size in num_features_grid:
            hashed = HashingTF(inputCol=tokens_col, outputCol="rawFeatures", numFeatures=size).transform(rows)
            path = scratch_path(spark, "grid-tf")
            hashed.select(key, "label", "_fold", "rawFeatures").write.parquet(path)
            staged = in_fit_order(spark.read.parquet(path), key).persist(StorageLevel.MEMORY_AND_DISK)
            waiting = []
            for fold in range(folds):
                training, validation = staged.where(F.col("_fold") != fold), staged.where(F.col("_fold") == fold)
                idf = IDF(inputCol="rawFeatures", outputCol="features").fit(training)
                waiting += [(least, pool.submit(one, training, validation, idf, least)) for least in min_doc_freq_grid]
            for least, score in waiting:
                scores.setdefault((size, least), []).append(score.result())
            staged.unpersist()
    found = [(size, least, float(sum(v) / len(v))) for (size, least), v in scores.items()]
    return spark.createDataFrame(found, "num_features INT, min_doc_freq INT, avg_auc DOUBLE")
