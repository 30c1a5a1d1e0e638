"""Landed OpenStreetMap query responses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoingest.functions.coords import osm_latlon
from geoingest.functions.expr import compute_once, json_string
from geoingest.functions.jsonmerge import starts_object
from geoingest.functions.text import QUERY_ID_LIMIT, clip, stable_id
from geoingest.sources.html import body_text
from geoingest.sources.record import to_raw_records

# Fixed value: every record names this service as its origin.
OSM_BASE_URL = "https://maps.mail.ru/osm/tools/overpass/api/interpreter"


def _parsed(responses: DataFrame, status: str, body: str) -> DataFrame:
    """Responses with their payload ``_json`` and its ``_elements``, parsed once; null where there is none."""
    readable = F.when((F.col(status) < 400) & starts_object(body_text(responses, body)), F.try_parse_json(body_text(responses, body)))
    df = compute_once(responses, "_json", readable)
    return compute_once(df, "_elements", F.try_variant_get("_json", "$.elements", "array<variant>"))


def osm_records(
    responses: DataFrame,
    *,
    query: str = "query",
    status: str = "status",
    body: str = "body",
    base_url: str = OSM_BASE_URL,
    prefix_ids: bool = False,
    keep_failed: bool = False,
) -> DataFrame:
    """One envelope per readable response with all of its elements; the first one gives the hint.

    The id is a digest of the whole query. ``prefix_ids`` takes the start of the query, as older tables do;
    long queries with a common start then share one key.
    """
    df = _parsed(responses, status, body)
    elements, q = F.col("_elements"), F.col(query)
    some = F.coalesce(F.size(elements) > 0, F.lit(False))
    filled = json_string(
        F.struct(
            q.alias("query"),
            elements.alias("elements"),
            F.size(elements).alias("n_elements"),
            F.col("_json").alias("raw_response"),
        )
    )
    empty = json_string(
        F.struct(
            q.alias("query"),
            F.array().cast("array<string>").alias("elements"),
            F.col("_json").alias("raw_response"),
        )
    )
    return to_raw_records(
        df,
        source="overpass",
        source_id=clip(q, QUERY_ID_LIMIT) if prefix_ids else stable_id(q, "overpass"),
        raw=F.when(some, filled).otherwise(empty),
        raw_ref=F.lit(base_url),
        locator=q,
        ok=F.col("_json").isNotNull(),
        coord_hint=osm_latlon(F.get(elements, F.lit(0))),
        keep_failed=keep_failed,
    )


def osm_elements(records: DataFrame) -> DataFrame:
    """One row per element of the envelopes: type, id, canonical point and tags."""
    items = F.try_variant_get(F.try_parse_json("raw"), "$.elements", "array<variant>")
    return _element_rows(records.select("source", "source_id", "_pos", F.posexplode(items).alias("element_pos", "_e")))


def osm_response_elements(responses: DataFrame, *, query: str = "query", status: str = "status", body: str = "body") -> DataFrame:
    """The rows of ``osm_elements`` straight from the responses, whose payloads are parsed once and not written as text again."""
    pos = (F.col("_pos") if "_pos" in responses.columns else F.lit(None)).cast("long").alias("_pos")
    key = stable_id(F.col(query), "overpass").alias("source_id")
    df = _parsed(responses, status, body)
    return _element_rows(df.select(F.lit("overpass").alias("source"), key, pos, F.posexplode("_elements").alias("element_pos", "_e")))


def _element_rows(rows: DataFrame) -> DataFrame:
    return rows.select(
        "source",
        "source_id",
        "_pos",
        "element_pos",
        F.try_variant_get("_e", "$.type", "string").alias("osm_type"),
        F.try_variant_get("_e", "$.id", "bigint").alias("osm_id"),
        osm_latlon(F.col("_e")).alias("geom"),
        F.try_variant_get("_e", "$.tags", "map<string,string>").alias("tags"),
    )
