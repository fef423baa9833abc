"""The entry module imports on its own, wherever it runs."""

import subprocess
import sys

from conftest import ROOT

from corvid.functions.stopwords import ENGLISH
from corvid.plans import registry

BLOCKED = """
import glob, zipfile
def refuse(*a, **k):
    raise AssertionError("no file may be looked up at import")
glob.glob = refuse
zipfile.ZipFile = refuse
import __spark_entry__ as entry
from pyspark.sql import SparkSession
queries, oracles = entry.queries(), entry.oracle_sql()
assert SparkSession.getActiveSession() is None
assert "wordcount" in queries and "txt_tfidf_terms" in oracles
assert set(oracles) <= set(queries)
print(len(queries), len(oracles))
"""


def test_entry_imports_in_a_fresh_process_without_file_lookups():
    done = subprocess.run([sys.executable, "-c", BLOCKED], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr


def test_stop_words_are_the_library_defaults(spark):
    from pyspark.ml.feature import StopWordsRemover

    assert list(ENGLISH) == StopWordsRemover.loadDefaultStopWords("english")


def test_queries_do_not_depend_on_an_oracle():
    def broken():
        raise RuntimeError("this oracle cannot be built")

    name = "_test_lazy_oracle"
    try:
        registry.register(name, broken)(lambda spark, sf_dir: None)
        from corvid import plans

        assert name in plans.queries()
    finally:
        registry.QUERIES.pop(name, None)
        registry.ORACLES.pop(name, None)
