"""Helpers to check a Spark result against DuckDB on the same parquet tables."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter

try:
    from pandas import NA as _NA
except ImportError:  # pragma: no cover
    _NA = object()

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duckdb_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _canon(v):
    if v is None or v is _NA:
        return None
    if isinstance(v, float) and math.isnan(v):
        return None
    if hasattr(v, "item") and not isinstance(v, (list, tuple, dict)):  # numpy scalar
        try:
            v = v.item()
        except (ValueError, AttributeError):
            pass
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, int):
        return ("n", float(v))
    if isinstance(v, float):
        return ("n", v)
    if isinstance(v, decimal.Decimal):
        return ("n", float(v))
    if isinstance(v, (dt.datetime, dt.date)):
        return ("t", v.isoformat())
    if hasattr(v, "isoformat"):
        return ("t", v.isoformat())
    if isinstance(v, (list, tuple)) or hasattr(v, "tolist"):
        seq = v.tolist() if hasattr(v, "tolist") else v
        return ("l", tuple(_canon(x) for x in seq))
    if isinstance(v, dict):
        return ("d", tuple(sorted((k, _canon(x)) for k, x in v.items())))
    return ("s", str(v))


def _kind(dtype) -> str:
    k = getattr(dtype, "kind", "O")
    return {"i": "num", "u": "num", "f": "num", "b": "bool", "M": "time", "m": "interval"}.get(k, "obj")


def compare_frames(spark_pdf, oracle_pdf) -> tuple[bool, str]:
    """Same column names, same row count, same multiset of rows."""
    s_cols, o_cols = sorted(spark_pdf.columns), sorted(oracle_pdf.columns)
    if s_cols != o_cols:
        return False, f"columns differ: spark={s_cols} oracle={o_cols}"
    if len(spark_pdf) != len(oracle_pdf):
        return False, f"row count differs: spark={len(spark_pdf)} oracle={len(oracle_pdf)}"
    kinds = [(c, _kind(spark_pdf[c].dtype), _kind(oracle_pdf[c].dtype)) for c in s_cols]
    s_rows = Counter(tuple(_canon(v) for v in row)
                     for row in spark_pdf[s_cols].itertuples(index=False, name=None))
    o_rows = Counter(tuple(_canon(v) for v in row)
                     for row in oracle_pdf[s_cols].itertuples(index=False, name=None))
    if s_rows != o_rows:
        only_s = list((s_rows - o_rows).elements())[:3]
        only_o = list((o_rows - s_rows).elements())[:3]
        return False, f"values differ: spark-only={only_s} oracle-only={only_o}"
    odd = [f"{c}:{a}/{b}" for c, a, b in kinds if a != b and "obj" not in (a, b)]
    return True, f"{len(spark_pdf)} rows" + (f" (kind differs: {odd})" if odd else "")
