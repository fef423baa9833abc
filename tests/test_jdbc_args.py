"""JDBC needs a database, which cannot be started here; only the argument
checks that run before any connection are tested."""

import pytest

from corvid.sources.jdbc import read_jdbc


def test_partitioned_read_needs_bounds(spark):
    with pytest.raises(ValueError):
        read_jdbc(spark, "jdbc:none://nowhere", "t", partition_column="id", num_partitions=4)
