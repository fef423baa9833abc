"""Queries over text features and models."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import IDF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvid.operators import ml
from corvid.operators.relational import train_test
from corvid.operators.text import (
    filtered_tokens,
    hashed_tf,
    hashing_tf,
    text_feature_stages,
    tfidf_terms,
    tokens,
    vector_sum,
)
from corvid.plans.registry import SQL_TOKENS, register, sql_filtered_tokens
from corvid.session import scratch_path, table
from corvid.sinks.folders import files_identity, kept_result

# Fixed parameters, as in the reference runs.
NUM_FEATURES = 1000
KMEANS_K = 3
KMEANS_SEED = 1
PLAIN_NUM_FEATURES = 20
PLAIN_K = 5
SWEEP_KS = range(2, 10)
SPLIT_SEED = 12345
TRAIN_FRACTION = 0.8
GRID_NUM_FEATURES = (1000, 10000, 100000)
GRID_MIN_DOC_FREQ = (0, 10, 100)
CV_FOLDS = 2


def _doc_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("double").alias("label"))


def _staged(df: DataFrame, label: str) -> DataFrame:
    """Written once to the shared folder: every fit, evaluation and transform
    reads it instead of tokenizing the texts again."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _term_frequencies(spark: SparkSession, sf_dir: str, num_features: int = NUM_FEATURES,
                      remove_stop_words: bool = True) -> DataFrame:
    """``doc_id, source, rawFeatures`` of all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    stages = text_feature_stages("text", num_features, 0, remove_stop_words=remove_stop_words)[:-1]
    return _staged(PipelineModel(stages).transform(docs).select("doc_id", "source", "rawFeatures"), "tf")


def _labelled_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, label, filtered`` of the labelled documents."""
    docs = filtered_tokens(_doc_text(spark, sf_dir), "text").select("doc_id", "filtered")
    return _staged(docs.join(_labels(spark, sf_dir), "doc_id"), "tokens")


def _idf(min_doc_freq: int = 0) -> IDF:
    return IDF(inputCol="rawFeatures", outputCol="features", minDocFreq=min_doc_freq)


def _split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return train_test(df, ["doc_id"], TRAIN_FRACTION, SPLIT_SEED)


@register("txt_tokens", f"""
SELECT doc_id, CAST(len({SQL_TOKENS}) AS BIGINT) AS n_tokens FROM documents
""")
def txt_tokens(spark, sf_dir):
    words = tokens(_doc_text(spark, sf_dir), "text")
    return words.select("doc_id", F.size("words").cast("bigint").alias("n_tokens"))


def _sql_filtered_count(alias: str, cast: str) -> str:
    return f"SELECT doc_id, CAST(len({sql_filtered_tokens()}) AS {cast}) AS {alias} FROM documents"


@register("txt_stopwords", _sql_filtered_count("n_filtered", "BIGINT"))
def txt_stopwords(spark, sf_dir):
    filtered = filtered_tokens(_doc_text(spark, sf_dir), "text")
    return filtered.select("doc_id", F.size("filtered").cast("bigint").alias("n_filtered"))


@register("txt_hashing_tf", _sql_filtered_count("tf_sum", "DOUBLE"))
def txt_hashing_tf(spark, sf_dir):
    """Hashed term frequencies (1000 buckets); a document's vector sums to
    its number of kept tokens whatever the hash collisions."""
    filtered = filtered_tokens(_doc_text(spark, sf_dir), "text")
    tf = hashed_tf(filtered, "filtered", NUM_FEATURES, "rawFeatures")
    return tf.select("doc_id", vector_sum("rawFeatures").alias("tf_sum"))


@register("txt_hashing_tf_plain", f"""
SELECT doc_id, CAST(len({SQL_TOKENS}) AS DOUBLE) AS tf_sum FROM documents
""")
def txt_hashing_tf_plain(spark, sf_dir):
    """Hashed term frequencies in 20 buckets, stop words left in."""
    tf = hashed_tf(tokens(_doc_text(spark, sf_dir), "text"), "words", PLAIN_NUM_FEATURES, "rawFeatures")
    return tf.select("doc_id", vector_sum("rawFeatures").alias("tf_sum"))


@register("txt_idf_vectors")
def txt_idf_vectors(spark, sf_dir):
    """TF-IDF vectors: IDF fitted over all documents (one distributed pass
    for document frequencies), then applied."""
    tf = _term_frequencies(spark, sf_dir)
    out = _idf().fit(tf).transform(tf)
    values = vector_to_array("features")
    return out.select("doc_id",
                      F.size(F.filter(values, lambda x: x != 0)).alias("n_nonzero"),
                      F.aggregate(values, F.lit(0.0), lambda a, x: a + x).alias("tfidf_sum"))


@register("txt_tfidf_terms", f"""
WITH toks AS (SELECT doc_id, unnest({sql_filtered_tokens()}) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM toks GROUP BY doc_id, term),
dfq AS (SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf FROM tf GROUP BY term),
n AS (SELECT count(*) AS n FROM documents)
SELECT tf.doc_id, tf.term, tf.tf, dfq.df, dfq.cf,
       round(ln((n.n + 1.0) / (dfq.df + 1.0)), 6) AS idf,
       round(tf.tf * ln((n.n + 1.0) / (dfq.df + 1.0)), 6) AS tfidf
FROM tf JOIN dfq ON tf.term = dfq.term CROSS JOIN n
""")
def txt_tfidf_terms(spark, sf_dir):
    """TF-IDF per (document, term) over the exact vocabulary of kept tokens."""
    docs = filtered_tokens(_doc_text(spark, sf_dir), "text")
    # N straight from the table scan (a row count reads no columns)
    n_docs = table(spark, sf_dir, "documents").select(F.count(F.lit(1))).scalar()
    terms = tfidf_terms(docs, "doc_id", "filtered", n_docs)
    return terms.select("doc_id", "term", "tf", "df", "cf", F.round("idf", 6).alias("idf"),
                        F.round("tfidf", 6).alias("tfidf"))


@register("ml_string_index", """
WITH f AS (SELECT event_type, count(*) AS c FROM events GROUP BY event_type),
r AS (SELECT event_type, CAST(row_number() OVER (ORDER BY c DESC, event_type) - 1 AS DOUBLE) AS label
      FROM f)
SELECT e.event_id, e.event_type, r.label FROM events e JOIN r ON e.event_type = r.event_type
""")
def ml_string_index(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    return ml.string_index(events, "event_type", "label")


def _fit_text_kmeans(spark, sf_dir):
    train, test = _split(_term_frequencies(spark, sf_dir))
    stages = [_idf(), ml.kmeans(KMEANS_K, KMEANS_SEED)]
    return ml.fit_staged(stages, ml.in_fit_order(train, "doc_id")), test


@register("ml_text_kmeans")
def ml_text_kmeans(spark, sf_dir):
    """k-means (k=3, seed 1) on TF-IDF features: fitted on the training
    split, predicting every test document."""
    model, test = _fit_text_kmeans(spark, sf_dir)
    return model.transform(test).select("doc_id", "source", "prediction")


@register("ml_cluster_centers")
def ml_cluster_centers(spark, sf_dir):
    model, _ = _fit_text_kmeans(spark, sf_dir)
    return ml.cluster_centers(spark, model.stages[-1])


def _plain_clusters(spark, sf_dir) -> DataFrame:
    tf = _term_frequencies(spark, sf_dir, PLAIN_NUM_FEATURES, remove_stop_words=False)
    model = ml.fit_staged([_idf(), ml.kmeans(PLAIN_K, KMEANS_SEED)], ml.in_fit_order(tf, "doc_id"))
    return model.transform(tf)


@register("ml_text_kmeans_plain")
def ml_text_kmeans_plain(spark, sf_dir):
    """k-means (k=5) on 20 buckets with stop words left in, fitted on and
    predicting the same documents."""
    return _plain_clusters(spark, sf_dir).select("doc_id", "source", "prediction")


@register("ml_text_silhouette_plain")
def ml_text_silhouette_plain(spark, sf_dir):
    """Silhouette of that clustering on the rows it was fitted on."""
    score = ml.silhouette(_plain_clusters(spark, sf_dir).select("features", "prediction"))
    return spark.createDataFrame([(score,)], "silhouette DOUBLE")


SQL_SILHOUETTE = """
WITH el AS (
  SELECT vec_id, label, t.i, CAST(embedding[t.i] AS DOUBLE) AS v
  FROM embeddings, generate_series(1, len(embedding)) AS t(i)),
pn AS (SELECT vec_id, label, sum(v * v) AS norm2 FROM el GROUP BY vec_id, label),
cs AS (SELECT label, i, sum(v) AS s FROM el GROUP BY label, i),
cn AS (SELECT label, count(*) AS n, sum(norm2) AS psi FROM pn GROUP BY label),
dots AS (
  SELECT el.vec_id, cs.label AS c, sum(el.v * cs.s) AS dot
  FROM el JOIN cs ON el.i = cs.i GROUP BY el.vec_id, cs.label),
dist AS (
  SELECT pn.vec_id, pn.label, dots.c, cn.n AS n_c,
         pn.norm2 + cn.psi / cn.n - 2 * dots.dot / cn.n AS d
  FROM pn JOIN dots ON pn.vec_id = dots.vec_id JOIN cn ON cn.label = dots.c),
per_point AS (
  SELECT vec_id,
         max(CASE WHEN c = label THEN d * n_c / (n_c - 1) END) AS a,
         min(CASE WHEN c <> label THEN d END) AS b,
         max(CASE WHEN c = label THEN n_c END) AS n_own
  FROM dist GROUP BY vec_id),
s AS (
  SELECT CASE WHEN n_own = 1 THEN 0.0
              WHEN a < b THEN 1 - a / b
              WHEN a > b THEN b / a - 1
              ELSE 0.0 END AS s
  FROM per_point)
SELECT round(avg(s), 6) AS silhouette FROM s
"""


@register("ml_silhouette", SQL_SILHOUETTE)
def ml_silhouette(spark, sf_dir):
    """Silhouette (squared Euclidean) of the embeddings under their labels."""
    emb = ml.array_features(table(spark, sf_dir, "embeddings"), "embedding", "features")
    score = ml.silhouette(emb.withColumn("prediction", F.col("label").cast("double")))
    return spark.createDataFrame([(None if score is None else round(score, 6),)], "silhouette DOUBLE")


@register("ml_k_sweep")
def ml_k_sweep(spark, sf_dir):
    """(k, silhouette, training cost) for k = 2..9, features computed once."""
    train, test = _split(_term_frequencies(spark, sf_dir))
    train = ml.in_fit_order(train, "doc_id")
    idf = _idf().fit(train)
    return ml.kmeans_sweep(spark, idf.transform(train).select("doc_id", "features"),
                           idf.transform(test).select("doc_id", "features"),
                           SWEEP_KS, KMEANS_SEED)


@register("ml_logistic")
def ml_logistic(spark, sf_dir):
    """Logistic regression (regParam 0.01, threshold 0.5) on TF-IDF of the
    document text, label = quality. Texts are hashed before the join with the
    labels, which so shuffles vectors, not texts."""
    docs = filtered_tokens(_doc_text(spark, sf_dir), "text")
    tf = hashed_tf(docs, "filtered", NUM_FEATURES).select("doc_id", "rawFeatures")
    train, test = _split(_staged(tf.join(_labels(spark, sf_dir), "doc_id"), "labelled-tf"))
    model = ml.fit_staged([_idf(), ml.logistic()], ml.in_fit_order(train, "doc_id"))
    return model.transform(test).select("doc_id", "label", "prediction",
                                        vector_to_array("probability")[1].alias("p_positive"))


@register("ml_auc", """
WITH d AS (
  SELECT CAST(d.n_chars AS DOUBLE) AS s, CAST(l.quality AS DOUBLE) AS y
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
r AS (
  SELECT y, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0 AS rk FROM d),
t AS (
  SELECT sum(CASE WHEN y = 1 THEN rk ELSE 0 END) AS rsum,
         CAST(sum(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS p,
         CAST(sum(CASE WHEN y = 1 THEN 0 ELSE 1 END) AS DOUBLE) AS n FROM r)
SELECT round((rsum - p * (p + 1) / 2) / (p * n), 6) AS auc FROM t
""")
def ml_auc(spark, sf_dir):
    """Exact area under ROC of ``n_chars`` as a score for quality."""
    sizes = table(spark, sf_dir, "documents").select("doc_id", F.col("n_chars").cast("double").alias("score"))
    docs = sizes.join(_labels(spark, sf_dir), "doc_id").select("score", "label")
    auc = ml.area_under_roc(docs, "score", "label", num_bins=0)
    return spark.createDataFrame([(round(auc, 6),)], "auc DOUBLE")


def _grid_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``num_features, min_doc_freq, avg_auc`` of the grid, searched once for
    the tables' present contents: both keys below read the written result."""
    sources = files_identity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    parameters = (GRID_NUM_FEATURES, GRID_MIN_DOC_FREQ, CV_FOLDS, SPLIT_SEED, TRAIN_FRACTION)

    def search() -> DataFrame:
        train, _ = _split(_labelled_tokens(spark, sf_dir))
        return ml.grid_search(train, "filtered", "doc_id", GRID_NUM_FEATURES, GRID_MIN_DOC_FREQ, CV_FOLDS)

    return kept_result(spark, "grid", f"{sources} {parameters}", search)


@register("ml_grid_cv")
def ml_grid_cv(spark, sf_dir):
    """2-fold cross-validation over numFeatures × minDocFreq; one row per point."""
    return _grid_results(spark, sf_dir)


def _test_auc(train: DataFrame, test: DataFrame, num_features: int, min_doc_freq: int) -> float:
    stages = [hashing_tf("filtered", num_features), _idf(min_doc_freq), ml.logistic()]
    return ml.area_under_roc(ml.fit_staged(stages, ml.in_fit_order(train, "doc_id")).transform(test), "rawPrediction")


@register("ml_tuning_gain")
def ml_tuning_gain(spark, sf_dir):
    """Test-set AUC of the untuned pipeline vs that of the grid's best point
    (of equals the first in the grid's order), and the gain in percent."""
    train, test = _split(_labelled_tokens(spark, sf_dir))
    points = {(r.num_features, r.min_doc_freq): r.avg_auc for r in _grid_results(spark, sf_dir).collect()}     # the grid
    best = max(((n, m) for n in GRID_NUM_FEATURES for m in GRID_MIN_DOC_FREQ), key=lambda p: points[p])
    untuned, tuned = _test_auc(train, test, NUM_FEATURES, 0), _test_auc(train, test, *best)
    gain = (tuned - untuned) * 100.0 / untuned if untuned else None
    return spark.createDataFrame([(untuned, tuned, gain)],
                                 "auc_untuned DOUBLE, auc_tuned DOUBLE, gain_pct DOUBLE")
