"""A training-data pipeline over ``documents``.

``STAGES`` are (name, function); each function takes ``(spark, docs,
sf_dir)`` and returns a DataFrame, which is written as Parquet and reread as
the next one's ``docs``. All but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corvid.llm import decontaminate, langid, packing, simhash, substring
from corvid.llm.common import written
from corvid.session import table


# Texts that a task of the substring stage holds: its workers have the other
# stages behind them, so smaller blocks than the operator's own.
BLOCK_BYTES = 4 << 20


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language go (null texts and texts without a
    letter); ``lang`` becomes the predicted one where it is null or that is certain."""
    model = langid.train(docs.where(langid.learned_from()))
    return langid.keep_identified(docs, model)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each SimHash group stays: the one of the smallest id."""
    return simhash.drop_near_duplicates(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Windows of words that start earlier in the corpus are cut out."""
    return substring.cut_documents(docs, block_bytes=BLOCK_BYTES)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold question and answer of a test item go."""
    return decontaminate.drop_leaked(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, each with its place in a sequence."""
    import public_tokenizers

    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language id", language_id),
    ("simhash near-dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("benchmark decontamination", decontamination),
    ("best-fit packing", best_fit_packing),
]

# Tokenizing, fingerprints and alignment have no SQL form; the stages are
# tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over the table ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
