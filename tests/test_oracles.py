"""Every query with an oracle equals DuckDB on the same tables."""

import pytest

import __spark_entry__ as entry
from corvid.testing import compare_frames, duckdb_connection

ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duckdb_connection(sf_dir)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(entry.queries())


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["p_partkey", "p_name", "avg_qty"]
    assert df.count() > 0


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_matches_duckdb(spark, con, sf_dir, key):
    result = entry.queries()[key](spark, sf_dir).toPandas()
    expected = con.execute(ORACLES[key]).fetchdf()
    ok, why = compare_frames(result, expected)
    assert ok, why
