"""Session settings the operators are written for."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # keep splitting a skewed join even where that costs one more exchange above it
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # no Python call site per column expression: building the longer plans takes a third less time
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

#: application -> its temporary folder, where no shared one is named
_local_folders: dict[str, str] = {}


def spark_session(app: str = "tillwatch", master: str | None = None, **extra: str) -> SparkSession:
    """Build (or fetch) a session; ``extra`` holds further settings with ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and stream state.

    A cluster names it in ``spark.checkpoint.dir``.  Only one local process without that setting (tests)
    falls back to a temporary folder, and keeps it for the session.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    # a core setting cannot be changed in a running session
    application = spark.sparkContext.applicationId
    if application not in _local_folders:
        _local_folders[application] = tempfile.mkdtemp(prefix="tillwatch-")
    return _local_folders[application]


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder: read several times, it is computed once and survives lost executors."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(checkpoint_root(df.sparkSession))
    return df.checkpoint()
