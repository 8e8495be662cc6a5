"""Session settings the jobs rely on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Runtime SQL settings. AQE picks broadcast joins from measured sizes, splits skewed join and
# rebalance partitions and coalesces small ones, so no operator carries a partition count.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # A task writes its output folders side by side up to this number, without sorting its rows by them first.
    "spark.sql.maxConcurrentOutputFileWriters": "64",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for name, value in RUNTIME_CONF.items():
        spark.conf.set(name, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the session's checkpoint directory.

    Only a local session without one gets a temporary folder; on a cluster a missing setting is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="paperloom-checkpoint-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def durable(df, eager: bool = True):
    """Reliable checkpoint: used where a value must not change if a task is run again."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager)
