"""All registered queries."""

from __future__ import annotations

from geoingest.plans import catalog_fetch, catalog_geo, catalog_media, catalog_merge, catalog_run  # noqa: F401
from geoingest.plans.registry import ORACLE, QUERIES, QueryFn


def all_queries() -> dict[str, QueryFn]:
    return dict(QUERIES)


def all_sql() -> dict[str, str]:
    return dict(ORACLE)
