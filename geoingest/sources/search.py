"""Landed web-search responses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoingest.functions.expr import compute_once, json_string, non_empty
from geoingest.functions.jsonmerge import starts_object
from geoingest.functions.text import stable_id
from geoingest.functions.urls import build_search_url
from geoingest.sources.html import body_text
from geoingest.sources.record import to_raw_records

MAX_RESULTS = 20
SEARCH_BASE_URL = "http://localhost:8080/search"

_RESULT = (
    "array<struct<url:string,title:string,content:string,engine:string,"
    "score:double,publishedDate:string,category:string>>"
)


def search_records(
    responses: DataFrame,
    *,
    query: str = "query",
    status: str = "status",
    body: str = "body",
    max_results: int = MAX_RESULTS,
    base_url: str = SEARCH_BASE_URL,
    keep_failed: bool = False,
    **url_options,
) -> DataFrame:
    """One envelope per readable response with its first ``max_results`` results.

    The text is the content of the first result when there is any.
    """
    readable = F.when(F.col(status) < 400, F.try_parse_json(body_text(responses, body)))
    df = compute_once(responses, "_json", readable)
    listed = F.coalesce(
        F.try_variant_get("_json", "$.results", "array<variant>"),
        F.array().cast("array<variant>"),
    )
    df = compute_once(df, "_results", F.slice(listed, 1, max_results))
    results, q = F.col("_results"), F.col(query)
    url = build_search_url(base_url, q, **url_options)
    return to_raw_records(
        df,
        source="searxng",
        source_id=stable_id(q),
        raw=json_string(
            F.struct(
                q.alias("query"),
                F.size(results).alias("n_results"),
                F.try_variant_get("_json", "$.number_of_results", "bigint").alias("number_of_results"),
                results.alias("results"),
                F.col("_json").alias("raw_response"),
                url.alias("engine_url"),
            )
        ),
        raw_ref=url,
        locator=q,
        ok=F.col("_json").isNotNull() & starts_object(body_text(responses, body)),
        text=non_empty(F.try_variant_get(F.get(results, F.lit(0)), "$.content", "string")),
        keep_failed=keep_failed,
    )


def search_results(records: DataFrame) -> DataFrame:
    """One row per result of the envelopes, in response order."""
    items = F.from_json(F.get_json_object("raw", "$.results"), _RESULT)
    rows = records.select("source", "source_id", "_pos", F.posexplode(items).alias("result_pos", "_r"))
    return rows.select("source", "source_id", "_pos", "result_pos", "_r.*")
