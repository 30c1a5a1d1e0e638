"""Common projection of every source to the raw record shape."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoingest.functions.coords import no_latlon
from geoingest.schemas import RAW_RECORD

NO_RECORD = "adapter_returned_none"


def to_raw_records(
    df: DataFrame,
    *,
    source: str,
    source_id: Column,
    raw: Column,
    raw_ref: Column,
    locator: Column,
    ok: Column,
    coord_hint: Column | None = None,
    text: Column | None = None,
    error: Column | None = None,
    keep_failed: bool = False,
) -> DataFrame:
    """Raw records of the rows that are ``ok``.

    With ``keep_failed`` every row stays and carries ``_locator`` and ``_error`` (null when ok), so a
    run can tell failed locators without joining them back; a text in ``_not_landed`` of the input goes first. ``fetched_at``, ``media_url`` and ``_pos``
    are taken over when the input has them.
    """
    have = set(df.columns)
    out = df.select(
        F.lit(source).alias("source"),
        source_id.alias("source_id"),
        raw.alias("raw"),
        (F.col("fetched_at") if "fetched_at" in have else F.current_timestamp())
        .cast("timestamp")
        .alias("fetched_at"),
        raw_ref.alias("raw_ref"),
        (no_latlon() if coord_hint is None else coord_hint).alias("coord_hint"),
        (F.lit(None) if text is None else text).cast("string").alias("text"),
        (F.col("media_url") if "media_url" in have else F.lit(None)).cast("string").alias("media_url"),
        (F.col("_pos") if "_pos" in have else F.lit(None)).cast("long").alias("_pos"),
        locator.alias("_locator"),
        F.coalesce(
            F.col("_not_landed") if "_not_landed" in have else F.lit(None),
            F.when(~F.coalesce(ok, F.lit(False)), F.lit(NO_RECORD) if error is None else error),
        ).alias("_error"),
    )
    if keep_failed:
        return out
    return out.where(F.col("_error").isNull()).select(*RAW_RECORD.fieldNames())


def union_sources(*records: DataFrame) -> DataFrame:
    """Stack raw records of several sources; a column missing in one of them is null there."""
    first, *rest = records
    for other in rest:
        first = first.unionByName(other, allowMissingColumns=True)
    return first
