"""Pacing and mirror health kept up to date over a stream of fetch attempts."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from geoingest.operators.fetchlog import mirror_state, pacing_state
from geoingest.plans.ingest import _delete
from geoingest.session import checkpoint_dir
from geoingest.sinks.tables import VersionedTable

PACING_STATE = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("current_interval_s", T.DoubleType()),
        T.StructField("last_ok_us", T.LongType()),
    ]
)

MIRROR_STATE = T.StructType(
    [
        T.StructField("mirror", T.StringType()),
        T.StructField("last_status", T.IntegerType()),
        T.StructField("last_success_ts", T.TimestampType()),
        T.StructField("last_attempt_ts", T.TimestampType()),
        T.StructField("consecutive_failures", T.LongType()),
        T.StructField("cooling_until_s", T.DoubleType()),
    ]
)


def pacing_table(spark: SparkSession, path: str) -> VersionedTable:
    return VersionedTable(spark, path, PACING_STATE)


def mirror_table(spark: SparkSession, path: str) -> VersionedTable:
    return VersionedTable(spark, path, MIRROR_STATE)


def stream_health(
    attempts: DataFrame,
    *,
    checkpoint: str,
    pacing: VersionedTable | None = None,
    mirrors: VersionedTable | None = None,
    base_interval: float = 0.5,
    tie: str = "event_id",
    query_name: str = "health",
    versions_kept: int = 3,
    available_now: bool = True,
) -> StreamingQuery:
    """Start a query that folds each micro-batch of ``attempts(source, mirror, ts, status, tie)`` onto the stored state.

    The state is one row per source and per mirror. A batch is folded as a log is, cut by range of source and time, so a
    source with a third of all attempts is no group of its own, as it would be in a keyed state store. Attempts are taken
    in time order within a batch, and batches in their order: an attempt that arrives a batch late counts as that batch's
    earliest. A batch without rows changes nothing; attempts without a time or a source (mirror) are left out of the
    pacing (the health of mirrors). Commits carry the batch's tag, so a replayed batch is folded in once.
    """
    wanted = [
        F.col("source").cast("string"), F.col("mirror").cast("string"), F.col("ts").cast("timestamp").alias("ts"),
        F.col("status").cast("int").alias("status"), F.col(tie).alias("_tie"),
    ]

    def one_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        tag = f"{query_name}-{spark.sparkContext.getLocalProperty('sql.streaming.queryId')}-{batch_id}"
        place = f"{checkpoint_dir(spark)}/health-{uuid4().hex}"
        try:
            narrow = batch.select(*wanted)
            narrow.write.parquet(place)
            log = spark.read.schema(narrow.schema).parquet(place)
            if pacing is not None and not pacing.has(tag):
                pacing.commit(pacing_state(log, pacing.read(), base_interval=base_interval, tie="_tie"), tag)
                pacing.prune(versions_kept)
            if mirrors is not None and not mirrors.has(tag):
                named = log.where("mirror IS NOT NULL AND ts IS NOT NULL")
                mirrors.commit(mirror_state(named, mirrors.read(), tie="_tie"), tag)
                mirrors.prune(versions_kept)
        finally:
            _delete(spark, place)

    writer = attempts.writeStream.queryName(query_name).option("checkpointLocation", checkpoint).foreachBatch(one_batch)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
