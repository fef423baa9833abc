"""Session defaults, table loading and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the operators rely on. AQE re-plans joins and aggregations at run
# time: it turns a sort-merge join into a broadcast join only when the
# measured side is under the broadcast threshold, coalesces small shuffle
# partitions and splits skewed ones.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
    "spark.sql.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "corvid",
    checkpoint_dir: str | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the defaults above. The master and
    the number of shuffle partitions stay as submitted unless given here.

    On a cluster, ``spark.checkpoint.dir`` names a shared folder and must be
    set by the deployment; ``checkpoint_dir`` is only for local runs and tests.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if checkpoint_dir:
        conf["spark.checkpoint.dir"] = checkpoint_dir
        conf["spark.sql.warehouse.dir"] = f"{checkpoint_dir.rstrip('/')}/warehouse"
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session; only when it is unset (local runs, tests) a fresh
    folder is created and registered as the checkpoint directory.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="corvid-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unique folder name under the shared directory (not created).

    Spark gives each application its own folder below ``spark.checkpoint.dir``,
    so everything a session staged lies under one parent; whoever runs the
    session removes that parent once its results have been read."""
    return f"{shared_dir(spark).rstrip('/')}/corvid/{label}-{uuid.uuid4().hex}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given parquet tables, e.g. ``table(spark, dir, "lineitem")``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
