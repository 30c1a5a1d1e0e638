"""Counters, error samples and the run log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from geoingest.functions.expr import json_string
from geoingest.schemas import FAILED, INSERTED, RUN_LOG, SKIPPED, UPDATED

COUNTERS = ["rows_total", "rows_inserted", "rows_updated", "rows_skipped", "rows_failed"]


def run_counters(outcomes: DataFrame, *, group: str = "source") -> DataFrame:
    """Counters per source from ``outcomes(<group>, _pos, outcome, sink_rank)``.

    Every sink counts its own outcome of a row; ``rows_total`` counts a row once, at ``sink_rank`` 0.
    """
    counted = lambda o: F.count_if(F.col("outcome") == o).alias(f"rows_{o}")
    rank = F.col("sink_rank") if "sink_rank" in outcomes.columns else F.lit(0)
    return outcomes.groupBy(group).agg(
        F.count_if(rank == 0).alias("rows_total"),
        *[counted(o) for o in (INSERTED, UPDATED, SKIPPED, FAILED)],
    )


def merge_counters(counters: DataFrame, *group: str) -> DataFrame:
    """Sum of the counters of several workers; the duration is their sum too."""
    present = [c for c in [*COUNTERS, "duration_ms"] if c in counters.columns]
    return counters.groupBy(*group).agg(*[F.sum(c).cast("bigint").alias(c) for c in present])


def first_error(errors: DataFrame, *, group: str = "source") -> DataFrame:
    """First error per source in input order."""
    return (
        errors.where("error is not null")
        .groupBy(group)
        .agg(F.min_by("error", "_pos").alias("error"))
    )


def errors_sample(errors: DataFrame, *, k: int = 3, group: str = "source") -> DataFrame:
    """The first ``k`` errors per source; a rank limit is applied before the shuffle."""
    ranked = errors.where("error is not null").withColumn(
        "rank", F.row_number().over(W.partitionBy(group).orderBy("_pos"))
    )
    return ranked.where(F.col("rank") <= k).select(group, "rank", "_pos", "error")


def run_log_row(
    counters: DataFrame,
    errors: DataFrame,
    *,
    run_id: Column,
    run_ts: Column,
    http_status: DataFrame | None = None,
    duration_ms: Column | None = None,
    group: str = "source",
) -> DataFrame:
    """Run log rows from counters and errors; ``http_status(<group>, http_status)`` is optional."""
    log = counters.join(first_error(errors, group=group), group, "left")
    if http_status is not None:
        log = log.join(http_status, group, "left")
    else:
        log = log.withColumn("http_status", F.lit(None).cast("int"))
    return log.select(
        run_id.cast("string").alias("run_id"),
        run_ts.cast("timestamp").alias("run_ts"),
        F.col(group).alias("source"),
        F.col("rows_inserted").alias("rows_added"),
        "rows_updated",
        F.col("http_status").cast("int").alias("http_status"),
        "error",
        (F.lit(None) if duration_ms is None else duration_ms).cast("bigint").alias("duration_ms"),
    ).select(*RUN_LOG.fieldNames())


def last_http_status(log: DataFrame, *, group: str = "source", tie: str | None = None) -> DataFrame:
    """Last status seen per source in a fetch log."""
    seen = log.where("status is not null")
    return seen.groupBy(group).agg(
        F.max_by("status", F.struct("ts", *([tie] if tie else []))).alias("http_status")
    )


def source_health(run_log: DataFrame, now: Column, *, days: int = 7) -> DataFrame:
    """Runs, rows and errors per source over the last ``days`` days of the run log."""
    since = now.cast("timestamp") - F.expr(f"INTERVAL {int(days)} DAYS")
    recent = run_log.where((F.col("run_ts") > since) & (F.col("run_ts") <= now.cast("timestamp")))
    return recent.groupBy("source").agg(
        F.count("*").alias("runs"),
        F.sum("rows_added").alias("rows_added"),
        F.sum("rows_updated").alias("rows_updated"),
        F.count("error").alias("runs_with_error"),
        F.max_by("http_status", "run_ts").alias("last_http_status"),
        F.max("run_ts").alias("last_run_ts"),
    )


def run_summary(counters: DataFrame) -> DataFrame:
    """Counters as one JSON text per row."""
    return counters.select(json_string(F.struct(*counters.columns)).alias("summary"))


def record_preview(records: DataFrame, *extra: str) -> DataFrame:
    """What a reader shows of each record before anything is stored, with further columns as they are."""
    body = F.get_json_object("raw", "$.body")
    return records.select(
        "source",
        "source_id",
        "raw_ref",
        "coord_hint",
        F.substring("text", 1, 200).alias("text_preview"),
        "fetched_at",
        F.octet_length(body).alias("raw_size"),
        *extra,
    )
