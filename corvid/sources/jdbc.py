"""JDBC tables: options form, method form, type override and parallel reads.

Not exercised by the registered queries: it needs a database, and no
database may be started here. At scale always give ``partition_column`` with
bounds so the read runs as ``num_partitions`` parallel range queries instead
of one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict[str, str] | None = None,
              custom_schema: str | None = None, partition_column: str | None = None,
              lower_bound: int | None = None, upper_bound: int | None = None,
              num_partitions: int | None = None, fetch_size: int = 10000) -> DataFrame:
    """Read a table; ``custom_schema`` overrides column types, e.g.
    ``"id DECIMAL(38, 0), name STRING"``."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    reader = reader.option("fetchsize", str(fetch_size))
    for key, value in (properties or {}).items():
        reader = reader.option(key, value)
    if custom_schema:
        reader = reader.option("customSchema", custom_schema)
    if partition_column:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("partition_column needs lower_bound, upper_bound and num_partitions")
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", str(lower_bound))
                  .option("upperBound", str(upper_bound))
                  .option("numPartitions", str(num_partitions)))
    return reader.load()


def read_jdbc_method(spark: SparkSession, url: str, table: str,
                     properties: dict[str, str] | None = None) -> DataFrame:
    """The method form ``spark.read.jdbc(url, table, properties=…)``."""
    return spark.read.jdbc(url, table, properties=properties or {})
