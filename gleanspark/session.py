"""Session settings and the place where lineage is cut."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # an extra shuffle costs less than one task holding a hot key
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.checkpoint.compress": "true",
    # recording the Python line of every expression makes large plans several times slower to build
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def session(app: str = "gleanspark", **conf: str) -> SparkSession:
    """A session with the library's settings; `conf` adds or overrides."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def spread_small(df: DataFrame) -> DataFrame:
    """Spread input that has fewer partitions than there are cores, such as one file with one row group.

    Large inputs have more partitions than cores and come back as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder: the one the cluster names in spark.checkpoint.dir.

    All executors can reach it, so what is written there survives the loss of
    any of them. Only a local-mode session may fall back to a temporary folder.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if shared is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
            shared = tempfile.mkdtemp(prefix="gleanspark-checkpoint-")
        context.setCheckpointDir(shared)
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write `df` to the checkpoint folder and go on from there."""
    shared_folder(df.sparkSession)
    return df.checkpoint()
