"""Registry of named queries and their DuckDB oracle SQL.

A query is a callable ``(spark, sf_dir) -> DataFrame`` over the given
tables. The oracle is the same result in SQL over the same tables; queries
whose result depends on seeds, model initialisation or partitioning have
none and are checked by properties in the tests instead.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from corvid.functions.stopwords import ENGLISH

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str | Callable[[], str]] = {}


def register(name: str, sql: str | Callable[[], str] | None = None):
    """Register a query. ``sql`` may be a callable; it is resolved only when
    the oracles are asked for, so queries never depend on an oracle."""
    def wrap(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query key {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return wrap


def sql_string_list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def oracle_text(sql: str | Callable[[], str]) -> str:
    return (sql() if callable(sql) else sql).strip()


# SQL fragments shared by the oracles (DuckDB dialect).
SQL_LINES = r"regexp_split_to_array(text, '\r\n|\r|\n')"
SQL_TOKENS = r"regexp_split_to_array(regexp_replace(lower(text), '\s+$', ''), '\s')"


def sql_filtered_tokens() -> str:
    stop = sql_string_list(ENGLISH)
    return f"list_filter({SQL_TOKENS}, lambda x: NOT list_contains({stop}, x))"
