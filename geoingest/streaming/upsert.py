"""Runs over newly arrived files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from geoingest.plans.ingest import run_ingest


def stream_upsert(
    arrivals: DataFrame,
    reader: Callable[[DataFrame], DataFrame],
    *,
    source_name: str,
    checkpoint: str,
    now: Callable[[int], Column] = lambda batch_id: F.current_timestamp(),
    query_name: str = "ingest",
    available_now: bool = True,
    **run_options,
) -> StreamingQuery:
    """Start a query that carries each micro-batch of ``arrivals(value, ...)`` through a run.

    Every table commit of a batch carries the query's id, which lives in its checkpoint, and the batch number.
    When a batch is replayed after a crash, the tables that hold it already are left alone, so no attempt is
    counted twice; a query with another checkpoint starts anew whatever its name.
    """

    def one_batch(batch: DataFrame, batch_id: int) -> None:
        query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        tag = f"{query_name}-{query_id}-{batch_id}"
        located = batch.withColumn("_pos", F.monotonically_increasing_id())
        run_ingest(
            batch.sparkSession,
            located,
            reader,
            source_name=source_name,
            now=now(batch_id),
            run_id=tag,
            tag=tag,
            **run_options,
        )

    writer = (
        arrivals.writeStream.queryName(query_name)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(one_batch)
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def drop_repeated(arrivals: DataFrame, *, delay: str = "1 day") -> DataFrame:
    """Raw records with a key already seen within ``delay`` of event time left out, in bounded state."""
    return arrivals.withWatermark("fetched_at", delay).dropDuplicatesWithinWatermark(["source", "source_id"])
