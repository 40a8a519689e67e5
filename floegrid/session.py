"""Session settings shared by every job."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the operators rely on. Shuffle partition counts and file split
# sizes are deliberately left to the cluster: AQE coalesces and splits from there.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Pin the runtime settings on an existing session."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def get_session(app: str = "floegrid", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def spread(frame: DataFrame, *cols: str) -> DataFrame:
    """Place small rows over all shuffle partitions ahead of heavy per-row work.

    The runtime sizes partitions by bytes and would run compact rows with costly expressions
    in a few tasks; a fixed partition count is left alone.
    """
    n = int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return frame.repartition(n, *cols)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    A local temporary folder is used only where the session names none, which is the
    case in tests on a single machine.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if named is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    sc.setCheckpointDir(named)
    return named
