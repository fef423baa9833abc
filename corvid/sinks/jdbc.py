"""JDBC writes: options form, method form and column-type override.

Not exercised by the registered queries (it needs a database). Each task
writes its partition over its own connection, so ``num_partitions`` bounds
the concurrent connections; ``batch_size`` sets rows per insert batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None,
               mode: str = "errorifexists", create_table_column_types: str | None = None,
               num_partitions: int | None = None, batch_size: int = 10000) -> None:
    """``create_table_column_types`` e.g. ``"name CHAR(64), comments VARCHAR(1024)"``."""
    writer = (df.write.format("jdbc").mode(mode).option("url", url).option("dbtable", table)
              .option("batchsize", str(batch_size)))
    for key, value in (properties or {}).items():
        writer = writer.option(key, value)
    if create_table_column_types:
        writer = writer.option("createTableColumnTypes", create_table_column_types)
    if num_partitions:
        writer = writer.option("numPartitions", str(num_partitions))
    writer.save()


def write_jdbc_method(df: DataFrame, url: str, table: str,
                      properties: dict[str, str] | None = None, mode: str = "errorifexists") -> None:
    """The method form ``df.write.jdbc(url, table, properties=…)``."""
    df.write.jdbc(url, table, mode=mode, properties=properties or {})
