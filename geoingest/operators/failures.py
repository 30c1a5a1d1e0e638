"""Failure table: one row per key with an attempts counter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoingest.functions.coords import geojson_point
from geoingest.functions.jsonmerge import keep_old
from geoingest.functions.text import DETAIL_LIMIT, TITLE_LIMIT, clip
from geoingest.operators.merge import given_pos
from geoingest.schemas import FAILURE_TABLE, KEY

UNKNOWN_KEY = "unknown"


def failure_projection(
    events: DataFrame, *, title_limit: int | None = TITLE_LIMIT, detail_limit: int | None = DETAIL_LIMIT
) -> DataFrame:
    """Failure events as they are stored.

    ``events(source, source_id, text, raw_ref, coord_hint, stage, detail, _pos)``; ``_pos`` may be any
    orderable column, and null in none. An event without a source or id is stored under ``unknown``. A limit of
    ``None`` keeps whole texts.
    """

    def cut(c: Column, limit: int | None) -> Column:
        return c if limit is None else clip(c, limit)

    return events.select(
        *[F.coalesce(F.col(k), F.lit(UNKNOWN_KEY)).alias(k) for k in KEY],
        F.when(F.col("text") != "", cut(F.col("text"), title_limit)).alias("title"),
        F.when(F.col("raw_ref").rlike("^https?://"), F.col("raw_ref")).alias("url"),
        geojson_point(F.col("coord_hint")).alias("geom"),
        F.col("stage").alias("failure_stage"),
        cut(F.col("detail"), detail_limit).alias("failure_detail"),
        given_pos().alias("_pos"),
    )


def fold_failures(projected: DataFrame) -> DataFrame:
    """One row per key: last stage and detail, last title, url and geometry given, number of events."""

    def last_given(name: str) -> Column:
        c = F.col(name)
        return F.max_by(c, F.when(c.isNotNull(), F.col("_pos"))).alias(name)

    return (
        projected.groupBy(*KEY)
        .agg(
            *[last_given(c) for c in ("title", "url", "geom")],
            F.max_by("failure_stage", "_pos").alias("failure_stage"),
            F.max_by("failure_detail", "_pos").alias("failure_detail"),
            F.count("*").alias("attempts"),
        )
    )


def record_failures(target: DataFrame, events: DataFrame, now: Column) -> DataFrame:
    """New failure table after all ``events``; rows stay when a later run of the key succeeds."""
    now = now.cast("timestamp")
    src = fold_failures(failure_projection(events))
    both = target.alias("t").join(
        src.alias("s"), [F.col(f"t.{k}") == F.col(f"s.{k}") for k in KEY], "full_outer"
    )
    hit = F.col("s.source").isNotNull()
    merged = {
        **{c: keep_old(F.col(f"s.{c}"), F.col(f"t.{c}")) for c in (*KEY, "title", "url", "geom")},
        **{
            c: F.when(hit, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}"))
            for c in ("failure_stage", "failure_detail")
        },
        "attempts": F.coalesce("t.attempts", F.lit(0)) + F.coalesce("s.attempts", F.lit(0)),
        "first_attempt_at": F.coalesce(F.col("t.first_attempt_at"), now),
        "last_attempt_at": F.when(hit, now).otherwise(F.col("t.last_attempt_at")),
    }
    return both.select(*[merged[c].alias(c) for c in FAILURE_TABLE.fieldNames()])
