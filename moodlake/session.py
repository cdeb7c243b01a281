"""Session settings shared by jobs, tests and the benchmark."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on: UTC wall clock (dates derived from timestamps
# must not move with the host zone), ANSI casts, adaptive execution for
# partition coalescing and skew splitting.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join partition even when that costs one more exchange later:
    # one key may hold a third of all rows
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "moodlake",
                  extra: dict | None = None) -> SparkSession:
    """Local or cluster session with the job settings applied."""
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in conf.items():
        if not k.startswith("spark.ui") and not k.startswith("spark.driver"):
            try:
                spark.conf.set(k, v)
            except Exception:  # static conf on a reused session
                pass
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in spark.checkpoint.dir.

    Only when the setting is absent on a single machine (tests) is a scratch
    folder created and registered; on a cluster its absence is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(configured)
        return spark.sparkContext.getCheckpointDir() or configured
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="moodlake-ckpt-", dir=os.environ.get("MOODLAKE_SCRATCH", "/tmp"))
    spark.sparkContext.setCheckpointDir(local)
    spark.conf.set("spark.checkpoint.dir", local)
    return spark.sparkContext.getCheckpointDir() or local


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written once as Parquet to a run-scoped folder in the shared folder
    and read back: lineage is cut, and later readers prune columns and push
    filters into the files."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/layers/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
