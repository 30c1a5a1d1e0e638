"""All queries of this subpackage."""

from __future__ import annotations

from geoingest.llm import chat, decontaminate, exact_dedup, html_text, importance, language_id, mixing, pieces, secret_scan, simhash, spelling, topk, url_filter  # noqa: F401
from geoingest.llm.registry import ORACLE, QUERIES, QueryFn


def all_queries() -> dict[str, QueryFn]:
    return dict(QUERIES)


def all_sql() -> dict[str, str]:
    return dict(ORACLE)
