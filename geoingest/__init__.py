"""Landed raw sources to clean, keyed geo-entities, as Spark DataFrame jobs."""

from geoingest.operators.accounts import account_health, assign_round_robin
from geoingest.operators.enrich import enrich, enrich_tracks, isolated, routable, route_url
from geoingest.operators.failures import failure_projection, record_failures
from geoingest.operators.fetchlog import (
    backoff_interval,
    cooldown_seconds,
    health_at,
    mirror_health,
    mirror_state,
    pacing_state,
    rank_mirrors,
    rate_stats,
    select_response,
    status_count_map,
    status_counts,
)
from geoingest.operators.merge import (
    dry_run,
    fold_batch,
    reject_invalid,
    row_outcomes,
    soft_delete_entities,
    upsert_entities,
)
from geoingest.operators.normalize import normalize, split_skipped, to_entity
from geoingest.operators.runlog import (
    errors_sample,
    first_error,
    merge_counters,
    record_preview,
    run_counters,
    run_log_row,
    run_summary,
    source_health,
)
from geoingest.plans.ingest import RunResult, Target, landed_reader, run_ingest
from geoingest.session import build_session, checkpoint_dir
from geoingest.sinks.buckets import BucketTable, bucketed_entities, bucketed_failures
from geoingest.sinks.tables import (
    VersionedTable,
    append_run_log,
    entity_table,
    failure_table,
    merge_into,
    read_entities,
    read_failures,
    read_run_log,
    save_bucketed,
    write_jdbc,
    write_rate_stats,
)
from geoingest.sources.gpx import gpx_records, gpx_track_points, gpx_waypoints, read_gpx
from geoingest.sources.gpx_rows import land_gpx, landed_documents, landed_points
from geoingest.sources.html import html_records
from geoingest.sources.json_api import json_records
from geoingest.sources.locators import inline_locators, read_locators
from geoingest.sources.map_urls import url_records
from geoingest.sources.media import media_geo, read_media
from geoingest.sources.osm import osm_elements, osm_records, osm_response_elements
from geoingest.sources.record import union_sources
from geoingest.sources.search import search_records, search_results
from geoingest.streaming.health import mirror_table, pacing_table, stream_health
from geoingest.streaming.upsert import drop_repeated, stream_upsert

__all__ = [name for name in dir() if not name.startswith("_")]
