"""Relational operators: filters, keyed aggregates, joins, top-k and sampling.

All of them are declarative DataFrame plans: aggregations run as partial
(map-side) plus final hash aggregates, filters and projections reach the
parquet scan, and the join strategy is left to Catalyst and AQE, which
broadcast a side only when its measured size is under
``spark.sql.autoBroadcastJoinThreshold`` and fall back to a shuffled
sort-merge join (with skew splitting) beyond it.
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvid.functions.text import split_multivalue

_OPS = {
    ">": lambda c, t: c > t,
    ">=": lambda c, t: c >= t,
    "<": lambda c, t: c < t,
    "<=": lambda c, t: c <= t,
    "=": lambda c, t: c == t,
    "==": lambda c, t: c == t,
    "!=": lambda c, t: c != t,
}


def compare(c: Column | str, op: str, threshold) -> Column:
    """``c <op> threshold`` as a predicate column."""
    column = F.col(c) if isinstance(c, str) else c
    return _OPS[op](column, F.lit(threshold))


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Column projection; pruned down to the scan's ReadSchema."""
    return df.select(*columns)


def filter_threshold(df: DataFrame, column: str, threshold, op: str = ">=") -> DataFrame:
    """Row filter ``column <op> threshold``, pushed to the scan as a PushedFilter."""
    return df.filter(compare(column, op, threshold))


def filter_prefix(df: DataFrame, column: str, prefix: str) -> DataFrame:
    """``column LIKE 'prefix%'`` (pushed to parquet as StringStartsWith)."""
    return df.filter(F.col(column).startswith(prefix))


def mean_per_key(df: DataFrame, key: str | Sequence[str], value: str,
                 alias: str = "avg_value") -> DataFrame:
    """Mean of ``value`` per key: a (sum, count) partial aggregate per task,
    merged after one shuffle on the key, then divided."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.avg(value).alias(alias))


def count_per_key(df: DataFrame, key: str | Sequence[str], alias: str = "n") -> DataFrame:
    """Row count per key (partial counts per task, then one shuffle)."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(alias))


def having(df_agg: DataFrame, column: str, op: str, threshold) -> DataFrame:
    """Filter on an aggregate (``HAVING``); default use is strict ``>``."""
    return df_agg.filter(compare(column, op, threshold))


def join_on_key(dimension: DataFrame, facts: DataFrame, on: str | Sequence[str],
                how: str = "inner") -> DataFrame:
    """Equi-join of a dimension with (usually aggregated) facts.

    No hint: the optimizer sees the filtered aggregate's size and AQE picks a
    broadcast hash join only under the size threshold, else sort-merge.
    """
    return dimension.join(facts, on=on, how=how)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """``(table_name, n_rows)`` for several tables, one small job each, unioned."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def category_counts(df: DataFrame, column: Column | str, alias: str = "category") -> DataFrame:
    """Count per category, largest first (ties by category)."""
    c = F.col(column) if isinstance(column, str) else column
    return (df.groupBy(c.alias(alias)).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.col("count").desc(), F.col(alias)))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def drop_duplicates(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Remove duplicate rows on the executors (partial dedup before the shuffle)."""
    return df.dropDuplicates(list(subset)) if subset else df.dropDuplicates()


def explode_multivalue(df: DataFrame, column: str, sep: str = "|", alias: str = "value") -> DataFrame:
    """One row per element of a delimited multi-value field."""
    return df.select(F.explode(split_multivalue(column, sep)).alias(alias))


def multivalue_counts(df: DataFrame, column: str, sep: str = "|", alias: str = "value") -> DataFrame:
    """Count per element of a delimited multi-value field."""
    return count_per_key(explode_multivalue(df, column, sep, alias), alias, "n")


def multivalue_distinct(df: DataFrame, column: str, sep: str = "|",
                        alias: str = "n_distinct") -> DataFrame:
    """Number of distinct elements over a delimited multi-value field."""
    values = explode_multivalue(df, column, sep, "value")
    return values.agg(F.count_distinct("value").alias(alias))


def grand_total(df: DataFrame, column: str, label: str = "all_times:",
                alias: str = "total") -> DataFrame:
    """Sum of keyed counts as one ``(label, total)`` row."""
    return df.agg(F.sum(column).cast("bigint").alias(alias)).select(
        F.lit(label).alias("label"), alias)


def first_n(df: DataFrame, n: int, order: Sequence[Column | str]) -> DataFrame:
    """First ``n`` rows under a total order (TakeOrderedAndProject: each task
    keeps its own best ``n``, the driver merges at most tasks * n rows)."""
    return df.orderBy(*order).limit(n)


def top_k_per_group(df: DataFrame, group_cols: Sequence[str], order: Sequence[Column],
                    k: int, spread_cols: Sequence[str], buckets: int = 32,
                    rank_alias: str = "rank") -> DataFrame:
    """Exact top-``k`` rows per group without sending a whole group to one task.

    Stage 1 ranks inside ``(group, bucket)`` sub-groups, the bucket being a
    hash of ``spread_cols``; Spark inserts a per-task group limit before the
    shuffle, and only each sub-group's best ``k`` survive. Stage 2 then ranks
    at most ``buckets * k`` rows per group. ``order`` must be a total order
    within a group for the result to be exact and repeatable.
    """
    bucket = F.pmod(F.xxhash64(*[F.col(c) for c in spread_cols]), F.lit(buckets))
    w1 = Window.partitionBy(*group_cols, "_bucket").orderBy(*order)
    candidates = (df.withColumn("_bucket", bucket)
                  .withColumn("_r", F.row_number().over(w1))
                  .filter(F.col("_r") <= k)
                  .drop("_bucket", "_r"))
    w2 = Window.partitionBy(*group_cols).orderBy(*order)
    return (candidates.withColumn(rank_alias, F.row_number().over(w2).cast("bigint"))
            .filter(F.col(rank_alias) <= k))


def hash_text(key_cols: Iterable[str], seed: int) -> Column:
    """A repeatable pseudo-random hex text from the row's key, the same in
    every engine that has MD5: of ``seed:key:key...``."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(c).cast("string") for c in key_cols]))


def hash_below(fraction: float) -> str:
    """The hex text that a ``fraction`` of all hash texts is below."""
    share = round(fraction * 16 ** 8)
    return f"{max(share, 0):08x}" if share < 16 ** 8 else "g"


def sample_n(df: DataFrame, n: int, seed: int, key_cols: Sequence[str]) -> DataFrame:
    """Exactly ``min(n, count)`` rows at random without replacement, repeatable.

    Orders by a seeded hash of the key and keeps the first ``n``: a top-n,
    so each task keeps ``n`` rows and one task merges them. Meant for an
    ``n`` that fits in a task's memory; a share of a large table is
    ``sample_fraction``.
    """
    return (df.withColumn("_u", hash_text(key_cols, seed))
            .orderBy("_u", *key_cols).limit(n).drop("_u"))


def sample_fraction(df: DataFrame, fraction: float, seed: int, key_cols: Sequence[str]) -> DataFrame:
    """Bernoulli sample without replacement: a row is drawn by a seeded hash
    of its key, so the draw doesn't depend on partitions or row order."""
    return df.filter(hash_text(key_cols, seed) < F.lit(hash_below(fraction)))


def hash_split(df: DataFrame, key_cols: Sequence[str], train_fraction: float = 0.8,
               seed: int = 12345, alias: str = "split") -> DataFrame:
    """Label each row ``train`` or ``test`` from a seeded hash of its key.

    Unlike ``randomSplit`` the split does not depend on partitioning or row
    order, so reruns and retried tasks give the same sets.
    """
    train = hash_text(key_cols, seed) < F.lit(hash_below(train_fraction))
    return df.withColumn(alias, F.when(train, F.lit("train")).otherwise(F.lit("test")))


def train_test(df: DataFrame, key_cols: Sequence[str], train_fraction: float = 0.8,
               seed: int = 12345) -> tuple[DataFrame, DataFrame]:
    labelled = hash_split(df, key_cols, train_fraction, seed, "_split")
    train = labelled.filter(F.col("_split") == "train").drop("_split")
    test = labelled.filter(F.col("_split") == "test").drop("_split")
    return train, test
