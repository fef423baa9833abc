"""Text operators: word counts and TF-IDF features.

Word counts are ``explode`` + ``groupBy().count()``: the partial aggregate
combines each task's tokens before the shuffle, so a very frequent token
(even the empty one) costs one row per task, not one per occurrence.
"""

from __future__ import annotations

import uuid
from typing import Sequence

from pyspark.ml.feature import IDF, HashingTF, StopWordsRemover, Tokenizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.functions.text import split_keep_empty, split_tokens_of_lines
from corvid.session import scratch_path


def words(df: DataFrame, text_col: str, keep: Sequence[str] = (), sep: str = " ",
          by_lines: bool = True, drop_empty: bool = False, alias: str = "word") -> DataFrame:
    """One row per token, splitting each line on a literal separator.

    Empty tokens are kept by default (``"a  b"`` yields ``a``, ``""``, ``b``),
    which is what a plain ``line.split(" ")`` word count reports.
    """
    text = F.col(text_col)
    tokens = split_tokens_of_lines(text, sep) if by_lines else split_keep_empty(text, sep)
    # explode_outer + a null filter equals explode here, and keeps the
    # optimizer from adding a size(tokens) > 0 filter that would evaluate
    # the split a second time
    out = df.select(*keep, F.explode_outer(tokens).alias(alias)).filter(F.col(alias).isNotNull())
    return out.filter(F.col(alias) != "") if drop_empty else out


def word_counts(df: DataFrame, text_col: str, group_cols: Sequence[str] = (), sep: str = " ",
                by_lines: bool = True, drop_empty: bool = False) -> DataFrame:
    """``(group…, word, count)``."""
    tokens = words(df, text_col, group_cols, sep, by_lines, drop_empty)
    return tokens.groupBy(*group_cols, "word").agg(F.count(F.lit(1)).alias("count"))


def tokenizer(input_col: str, output_col: str = "words") -> Tokenizer:
    """Lower-case and split on single whitespace characters."""
    return Tokenizer(inputCol=input_col, outputCol=output_col)


def stop_words_remover(input_col: str = "words", output_col: str = "filtered",
                       case_sensitive: bool = False, language: str = "english") -> StopWordsRemover:
    return StopWordsRemover(inputCol=input_col, outputCol=output_col, caseSensitive=case_sensitive,
                            stopWords=StopWordsRemover.loadDefaultStopWords(language))


def text_feature_stages(input_col: str, num_features: int = 1000, min_doc_freq: int = 0,
                        features_col: str = "features", remove_stop_words: bool = True) -> list:
    """Tokenizer → stop words (unless left in) → hashed term frequencies → IDF."""
    kept = "filtered" if remove_stop_words else "words"
    return [
        tokenizer(input_col, "words"),
        *([stop_words_remover("words", "filtered")] if remove_stop_words else []),
        HashingTF(inputCol=kept, outputCol="rawFeatures", numFeatures=num_features),
        IDF(inputCol="rawFeatures", outputCol=features_col, minDocFreq=min_doc_freq),
    ]


def tokens(df: DataFrame, text_col: str, output_col: str = "words") -> DataFrame:
    return tokenizer(text_col, output_col).transform(df)


def filtered_tokens(df: DataFrame, text_col: str) -> DataFrame:
    """Adds ``words`` (tokens) and ``filtered`` (stop words removed)."""
    return stop_words_remover("words", "filtered").transform(tokens(df, text_col, "words"))


def hashing_tf(tokens_col: str, num_features: int = 1000, output_col: str = "rawFeatures") -> HashingTF:
    return HashingTF(inputCol=tokens_col, outputCol=output_col, numFeatures=num_features)


def hashed_tf(df: DataFrame, tokens_col: str, num_features: int = 1000,
              output_col: str = "rawFeatures") -> DataFrame:
    return hashing_tf(tokens_col, num_features, output_col).transform(df)


def vector_sum(c: str):
    """Sum of a vector column's entries (JVM-side, via ``vector_to_array``)."""
    from pyspark.ml.functions import vector_to_array
    return F.aggregate(vector_to_array(F.col(c)), F.lit(0.0), lambda acc, x: acc + x)


# Documents whose rows of one term may share a bucket; fewest parts of a term.
SALT_DOCS = 1_000_000
LEAST_SALTS = 8


def tfidf_terms(docs: DataFrame, doc_col: str, tokens_col: str, n_docs=None) -> DataFrame:
    """Exact-vocabulary TF-IDF per ``(document, term)``, with the term's
    document frequency ``df`` and total count ``cf``.

    ``idf = ln((N + 1) / (df + 1))`` as in Spark's ``IDF`` with
    ``minDocFreq`` 0; ``N`` counts every document row (a scalar subquery over
    ``docs`` unless the caller passes a cheaper ``n_docs`` column).

    Tokens are shuffled once, by term and a part of the documents (a hash of
    the document, so that a term of nearly every document is spread over
    several buckets). Term frequencies come from that partitioning and are
    written bucketed by it: document frequencies are added up from the buckets
    (a row for each term and part), and the join reads the buckets again.
    Neither shuffles the term frequencies a second time.
    """
    spark = docs.sparkSession
    if n_docs is None:
        n_docs = docs.select(F.count(F.lit(1))).scalar()
    salts = max(LEAST_SALTS, -(-docs.select(doc_col).count() // SALT_DOCS))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    terms = (docs.select(doc_col, F.explode_outer(tokens_col).alias("term"))
             .filter(F.col("term").isNotNull())
             .withColumn("_salt", F.pmod(F.xxhash64(doc_col), F.lit(salts)).cast("int")))
    name = f"term_frequencies_{uuid.uuid4().hex}"
    (terms.repartition(buckets, "term", "_salt").groupBy("term", "_salt", doc_col).agg(F.count(F.lit(1)).alias("tf"))
     .write.bucketBy(buckets, "term", "_salt").option("path", scratch_path(spark, "term-frequencies"))
     .format("parquet").saveAsTable(name))
    tf = spark.table(name)
    parts = tf.groupBy("term", "_salt").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf"))
    doc_freq = parts.groupBy("term").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf"), F.collect_list("_salt").alias("salts"))
    doc_freq = doc_freq.select("term", F.explode("salts").alias("_salt"), "df", "cf")
    idf = F.log((n_docs + F.lit(1.0)) / (F.col("df") + F.lit(1.0)))
    return (tf.join(doc_freq, ["term", "_salt"]).drop("_salt")
            .withColumn("idf", idf)
            .withColumn("tfidf", F.col("tf") * F.col("idf")))
