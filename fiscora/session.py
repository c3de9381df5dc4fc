"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# What the jobs count on; worth setting on any session (the first two are Spark's defaults). The last lets joins on
# the grain use rows that are stored in buckets by company; without it they are right, but shuffle.
SQL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and the benchmark. On a cluster, bring your own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("fiscora")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("FISCORA_DRIVER_MEMORY", "8g"))
    )
    for key, value in {**SQL_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_fallback_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session, where
    driver and executors are one machine, may fall back to a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _fallback_dirs:
        _fallback_dirs[context.applicationId] = tempfile.mkdtemp(prefix="fiscora-")
    return _fallback_dirs[context.applicationId]


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable, in the shared folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
