"""Session settings, shared checkpoint folder and the size check in front of a broadcast."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(app: str = "geoingest", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the jobs rely on: UTC, adaptive plans, split skewed joins."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        # A payload that repeats a key is still a payload; its last value counts.
        .config("spark.sql.variant.allowDuplicateKeys", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session without the setting gets a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if spark.sparkContext.master.partition("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    # One process on one machine: driver and executors share its folders.
    own = tempfile.mkdtemp(prefix="geoingest-")
    spark.conf.set("spark.checkpoint.dir", own)
    return own


def broadcast_if_small(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast hint only when ``df`` has at most ``max_rows`` rows; otherwise ``df`` as it is."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def spread(df: DataFrame) -> DataFrame:
    """Repartition a scan that has fewer splits than the session has cores, for costly work per row.

    A large input has more splits than that and is returned as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    splits = df._jdf.queryExecution().toRdd().getNumPartitions()
    return df.repartition(cores) if splits < cores else df
