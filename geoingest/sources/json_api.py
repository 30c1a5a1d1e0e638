"""Landed JSON responses as records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoingest.functions.expr import compute_once, json_string
from geoingest.sources.html import body_text, optional
from geoingest.sources.record import to_raw_records


def json_records(
    responses: DataFrame, *, url: str = "url", body: str = "body", keep_failed: bool = False
) -> DataFrame:
    """One record per response whose body is JSON; the payload is passed through."""
    df = compute_once(responses, "_json", F.try_parse_json(body_text(responses, body)))
    link = F.col(url)
    return to_raw_records(
        df,
        source="api",
        source_id=link,
        raw=json_string(
            F.struct(
                F.col("_json").alias("json"),
                optional(df, "headers", "map<string,string>").alias("headers"),
                optional(df, "strategy", "string").alias("strategy"),
            )
        ),
        raw_ref=link,
        locator=link,
        ok=F.col("_json").isNotNull(),
        keep_failed=keep_failed,
    )
