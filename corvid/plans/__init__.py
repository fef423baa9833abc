"""Named queries over the given tables and their oracle SQL."""

from corvid.plans import io, relational, streams, text_models  # noqa: F401  (registers)
from corvid.plans.registry import ORACLES, QUERIES, oracle_text


def queries():
    return dict(QUERIES)


def oracle_sql():
    return {name: oracle_text(sql) for name, sql in ORACLES.items()}


__all__ = ["oracle_sql", "queries"]
