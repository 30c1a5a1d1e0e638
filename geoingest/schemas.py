"""Shapes shared by every stage: raw records, entities, failures, run log, fetch log."""

from __future__ import annotations

from pyspark.sql import types as T

LATLON = T.StructType([T.StructField("lat", T.DoubleType()), T.StructField("lon", T.DoubleType())])

# One row per landed record, `_pos` is the input order and unique within a run.
RAW_RECORD = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("source_id", T.StringType()),
        T.StructField("raw", T.StringType()),
        T.StructField("fetched_at", T.TimestampType()),
        T.StructField("raw_ref", T.StringType()),
        T.StructField("coord_hint", LATLON),
        T.StructField("text", T.StringType()),
        T.StructField("media_url", T.StringType()),
        T.StructField("_pos", T.LongType()),
    ]
)

# One row per normalized record; `attrs` is a JSON object kept as a string at rest.
ENTITY = T.StructType(
    [
        T.StructField("entity_type", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("source_id", T.StringType()),
        T.StructField("geom", LATLON),
        T.StructField("attrs", T.StringType()),
        T.StructField("bbox_country", T.StringType()),
        T.StructField("confidence", T.DoubleType()),
        T.StructField("_pos", T.LongType()),
    ]
)

# Stored entity table, keyed by (source, source_id); geom is a GeoJSON point.
ENTITY_TABLE = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("source_id", T.StringType()),
        T.StructField("entity_type", T.StringType()),
        T.StructField("geom", T.StringType()),
        T.StructField("attrs", T.StringType()),
        T.StructField("bbox_country", T.StringType()),
        T.StructField("confidence", T.DoubleType()),
        T.StructField("last_seen_at", T.TimestampType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("removed_at", T.TimestampType()),
    ]
)

FAILURE_TABLE = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("source_id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("geom", T.StringType()),
        T.StructField("failure_stage", T.StringType()),
        T.StructField("failure_detail", T.StringType()),
        T.StructField("attempts", T.LongType()),
        T.StructField("first_attempt_at", T.TimestampType()),
        T.StructField("last_attempt_at", T.TimestampType()),
    ]
)

RUN_LOG = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("run_ts", T.TimestampType()),
        T.StructField("source", T.StringType()),
        T.StructField("rows_added", T.LongType()),
        T.StructField("rows_updated", T.LongType()),
        T.StructField("http_status", T.IntegerType()),
        T.StructField("error", T.StringType()),
        T.StructField("duration_ms", T.LongType()),
    ]
)

# Landed attempts of a fetcher: one row per (url, attempt, strategy).
FETCH_LOG = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("strategy", T.StringType()),
        T.StructField("strategy_rank", T.IntegerType()),
        T.StructField("attempt", T.IntegerType()),
        T.StructField("status", T.IntegerType()),
        T.StructField("headers", T.MapType(T.StringType(), T.StringType())),
        T.StructField("body", T.BinaryType()),
        T.StructField("elapsed_ms", T.LongType()),
        T.StructField("ts", T.TimestampType()),
    ]
)

KEY = ["source", "source_id"]

INSERTED, UPDATED, SKIPPED, FAILED = "inserted", "updated", "skipped", "failed"

FAILURE_STAGES = ("fetch", "parse", "normalize", "enrich", "persist")
