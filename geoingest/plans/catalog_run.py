"""Registered queries: whole runs and streams over landed links, and the tables that they leave."""

from __future__ import annotations

from uuid import uuid4

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geoingest.functions.country import detect_country, with_country
from geoingest.operators import fetchlog
from geoingest.operators.enrich import isolated
from geoingest.operators.merge import DO_NOTHING
from geoingest.operators.normalize import to_entity
from geoingest.plans.catalog_fetch import _PACE, _SOON, _text_ts
from geoingest.plans.catalog_geo import _POINTS
from geoingest.plans.derived import COUNTRY_SQL, EARLIER, FETCH_SQL, GEO_SQL, NOW, fetch_log, geo_orders
from geoingest.plans.ingest import Target, run_ingest
from geoingest.plans.registry import ORACLE, query
from geoingest.session import checkpoint_dir
from geoingest.sinks.buckets import bucketed_entities, bucketed_failures
from geoingest.sinks.tables import (
    entity_table,
    failure_table,
    read_entities,
    read_failures,
    read_run_log,
    write_rate_stats,
)
from geoingest.sources.gpx_rows import land_gpx, landed_documents, landed_points
from geoingest.sources.locators import read_locators
from geoingest.sources.map_urls import url_records
from geoingest.streaming.health import mirror_table, pacing_table, stream_health
from geoingest.streaming.upsert import drop_repeated, stream_upsert


def _place(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark)}/runs/{name}-{uuid4().hex}"


def _at(text: str) -> Column:
    return F.lit(text).cast("timestamp")


def _reader(locators: DataFrame) -> DataFrame:
    return url_records(locators, keep_failed=True)


def _by_country(raw: DataFrame) -> DataFrame:
    """Entities of the known countries; points far north are failures, all others are skipped."""
    lat, lon = F.col("coord_hint.lat"), F.col("coord_hint.lon")
    far, country = lat > 80, detect_country(lat, lon)
    kept = to_entity(raw).withColumn("entity_type", F.when(~far & (country != "unknown"), country))
    return kept.withColumn("_problem", F.when(far, F.lit("too far north")))


def _listed(spark: SparkSession, sf_dir: str, path: str, part: str = "true", mode: str = "errorifexists") -> None:
    """The links of the orders as locator lists."""
    geo_orders(spark, sf_dir).where(part).select("url").write.mode(mode).text(path)


def _links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geo_orders(spark, sf_dir).select(F.col("url").alias("value"), F.col("k").alias("_pos"))


# What becomes of every link in a run with the normalizer above.
_OUTCOME = f"""{_POINTS}, hint AS (SELECT k, lat, lon, {COUNTRY_SQL} AS country FROM pts WHERE point_pos = 0),
told AS (SELECT geo.k, geo.url, hint.lat, hint.lon, country,
  CASE WHEN hint.k IS NULL THEN 'adapter_returned_none' WHEN hint.lat > 80 THEN 'normalize: ValueError: too far north'
    WHEN country = 'unknown' THEN 'normalizer_returned_none' END AS error,
  CASE WHEN hint.k IS NULL THEN 'fetch' ELSE 'normalize' END AS stage
FROM geo LEFT JOIN hint USING (k))"""


@query(f"""{_OUTCOME}, stored AS (SELECT DISTINCT 'url' AS source, url AS source_id, country AS entity_type, lat, lon FROM told WHERE error IS NULL)
SELECT 'versions' AS target, *, '2024-02-01' AS seen FROM stored UNION ALL SELECT 'buckets', *, '2024-01-01' FROM stored""")
def run_into_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Locator lists carried into two tables by two runs: one table is updated, the other keeps what it has."""
    lists, versions, buckets = (_place(spark, name) for name in ("lists", "entities", "entities"))
    _listed(spark, sf_dir, lists)
    targets = [
        Target(entity_table(spark, versions), "versions"),
        Target(bucketed_entities(spark, buckets), "buckets", on_conflict=DO_NOTHING),
    ]
    for when in (EARLIER, NOW):
        run_ingest(
            spark, read_locators(spark, lists), _reader, source_name="maps", now=_at(when), normalizer=_by_country, targets=targets
        )
    stored = [
        df.select(
            F.lit(name).alias("target"), "source", "source_id", "entity_type",
            F.get_json_object("geom", "$.coordinates[1]").cast("double").alias("lat"),
            F.get_json_object("geom", "$.coordinates[0]").cast("double").alias("lon"),
            F.date_format("last_seen_at", "yyyy-MM-dd").alias("seen"),
        )
        for name, df in (("versions", read_entities(spark, versions)), ("buckets", bucketed_entities(spark, buckets).read()))
    ]
    return stored[0].unionByName(stored[1])


@query(f"""{_OUTCOME}, lost AS (SELECT url AS source_id, CASE WHEN stage = 'fetch' THEN 'maps' ELSE 'url' END AS source,
  stage AS failure_stage, error AS failure_detail, 2 * count(*) AS attempts FROM told WHERE error IS NOT NULL GROUP BY ALL)
SELECT target, source, source_id, failure_stage, failure_detail, CAST(attempts AS BIGINT) AS attempts,
  '2024-01-01' AS first_day, '2024-02-01' AS last_day FROM lost, (VALUES ('versions'), ('buckets')) v(target)""")
def run_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failures of two runs over all links, the second of which is replayed, in either kind of table."""
    versions, buckets = _place(spark, "failures"), _place(spark, "failures")
    for table in (failure_table(spark, versions), bucketed_failures(spark, buckets)):
        for tag, when in (("a", EARLIER), ("b", NOW), ("b", NOW)):
            run_ingest(
                spark, _links(spark, sf_dir), _reader, source_name="maps", now=_at(when), normalizer=_by_country,
                failures=table, run_id=tag, tag=tag,
            )
    stored = [
        df.select(
            F.lit(name).alias("target"), "source", "source_id", "failure_stage", "failure_detail", "attempts",
            F.date_format("first_attempt_at", "yyyy-MM-dd").alias("first_day"),
            F.date_format("last_attempt_at", "yyyy-MM-dd").alias("last_day"),
        )
        for name, df in (("versions", read_failures(spark, versions)), ("buckets", bucketed_failures(spark, buckets).read()))
    ]
    return stored[0].unionByName(stored[1])


@query(f"""{_OUTCOME}, n AS (SELECT count(DISTINCT url) FILTER (WHERE error IS NULL) AS added, count(*) FILTER (WHERE error IS NULL) AS valid,
  arg_min(error, k) FILTER (WHERE error IS NOT NULL) AS error FROM told)
SELECT run_id, 'maps' AS source, CAST(CASE WHEN run_id = 'a' THEN added ELSE 0 END AS BIGINT) AS rows_added,
  CAST(CASE WHEN run_id = 'a' THEN valid - added ELSE valid END AS BIGINT) AS rows_updated, CAST(200 AS INT) AS http_status, error
FROM n, (VALUES ('a'), ('b')) v(run_id)""")
def run_log_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run log after a run and its replay, and another run that was told twice: one row each."""
    entities, log = _place(spark, "entities"), _place(spark, "log")
    for run_id, tag in (("a", "a"), ("a", "a"), ("b", None), ("b", None)):
        run_ingest(
            spark, _links(spark, sf_dir), _reader, source_name="maps", now=_at(NOW), normalizer=_by_country,
            targets=[Target(entity_table(spark, entities))], run_log_path=log, http_status=200, run_id=run_id, tag=tag,
        )
    return read_run_log(spark, log).select("run_id", "source", "rows_added", "rows_updated", "http_status", "error")


@query(f"""{_OUTCOME} SELECT DISTINCT url AS source_id, CAST(CASE WHEN country = 'BY' THEN 1.0 ELSE 0.5 END AS DOUBLE) AS confidence,
  country AS bbox_country FROM told WHERE stage <> 'fetch'""")
def isolated_enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities after an enricher that fails on the points of one country: they stay as they were."""
    def halve(rows: pd.DataFrame) -> pd.DataFrame:
        if (rows["bbox_country"] == "BY").any():
            raise ValueError("no source for BY")
        return rows.assign(confidence=rows["confidence"] / 2)

    path = _place(spark, "entities")
    run_ingest(
        spark, _links(spark, sf_dir), _reader, source_name="maps", now=_at(NOW),
        normalizer=lambda raw: with_country(to_entity(raw)),
        enrichers=[isolated(halve, ["bbox_country", "confidence"], "confidence double")],
        targets=[Target(entity_table(spark, path))],
    )
    return read_entities(spark, path).select("source_id", "confidence", "bbox_country")


@query(f"""{_OUTCOME} SELECT url AS source_id, any_value(country) AS entity_type,
  CASE WHEN max(k % 2) = 1 THEN '2024-02-01' ELSE '2024-01-01' END AS seen,
  CASE WHEN min(k % 2) = 0 THEN '2024-01-01' ELSE '2024-02-01' END AS created
FROM told WHERE error IS NULL GROUP BY url""")
def stream_into_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Locator lists carried into a table as they arrive, with a restart of the stream between them."""
    lists, entities, checkpoint = (_place(spark, name) for name in ("lists", "entities", "checkpoint"))
    for part, mode in (("k % 2 = 0", "errorifexists"), ("k % 2 = 1", "append")):
        _listed(spark, sf_dir, lists, part, mode)
        stream_upsert(
            spark.readStream.text(lists), _reader, source_name="maps", checkpoint=checkpoint, normalizer=_by_country,
            now=lambda batch_id: _at(EARLIER if batch_id == 0 else NOW), targets=[Target(entity_table(spark, entities))],
        ).awaitTermination()
    return read_entities(spark, entities).select(
        "source_id", "entity_type",
        F.date_format("last_seen_at", "yyyy-MM-dd").alias("seen"), F.date_format("created_at", "yyyy-MM-dd").alias("created"),
    )


@query(f"WITH {FETCH_SQL} SELECT DISTINCT source, url AS source_id FROM fetchlog")
def stream_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of a stream, each key once within event time, with a restart of the stream in the middle."""
    landed, out, checkpoint = (_place(spark, name) for name in ("landed", "distinct", "checkpoint"))
    log = fetch_log(spark, sf_dir).selectExpr("source", "url AS source_id", "CAST(ts AS TIMESTAMP) AS fetched_at", "event_id")
    for part, mode in (("event_id % 2 = 0", "errorifexists"), ("event_id % 2 = 1", "append")):
        log.where(part).drop("event_id").write.mode(mode).parquet(landed)
        arrivals = spark.readStream.schema("source string, source_id string, fetched_at timestamp").parquet(landed)
        kept = drop_repeated(arrivals, delay="400 days").writeStream.format("parquet").option("checkpointLocation", checkpoint)
        kept.trigger(availableNow=True).start(out).awaitTermination()
    return spark.read.parquet(out).select("source", "source_id")


@query(f"""WITH RECURSIVE {FETCH_SQL}, {_PACE.format(base='0.5')},
counts AS (SELECT source, status, CAST(count(*) AS BIGINT) AS n FROM fetchlog GROUP BY source, status)
SELECT source, CAST(2 AS DOUBLE) AS rate_per_sec, 4 AS burst, round(x, 4) AS current_interval_s, x > 0.525 AS backoff_active,
  '2024-02-01T00:00:00Z' AS ts, status, n FROM pace JOIN counts USING (source)""")
def rate_stats_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pacing state and status counts as the stored documents hold them."""
    path = _place(spark, "rates")
    write_rate_stats(fetchlog.rate_stats(fetch_log(spark, sf_dir), tie="event_id", now=_at(NOW)), path)
    fields = "source string, rate_per_sec double, burst int, current_interval_s double, backoff_active boolean, ts string"
    stored = spark.read.schema(f"{fields}, by_status map<string,bigint>").json(path)
    return stored.select(*stored.columns[:-1], F.explode("by_status").alias("status", "n")).withColumn("status", F.col("status").cast("int"))


def _streamed_log(spark: SparkSession, sf_dir: str, **tables) -> None:
    """The fetch log as it arrives: its first days, then the rest after a restart of the stream."""
    landed, checkpoint = _place(spark, "landed"), _place(spark, "checkpoint")
    log = fetch_log(spark, sf_dir).selectExpr("source", "mirror", "CAST(ts AS TIMESTAMP) AS ts", "status", "event_id")
    for part, mode in (("ts < '2024-01-16'", "errorifexists"), ("ts >= '2024-01-16'", "append")):
        log.where(part).write.mode(mode).parquet(landed)
        arrivals = spark.readStream.schema(log.schema).parquet(landed)
        stream_health(arrivals, checkpoint=checkpoint, base_interval=0.7, **tables).awaitTermination()


@query(ORACLE["backoff_interval"])
def stream_pacing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pacing interval of every source, kept over a stream of attempts."""
    pacing = pacing_table(spark, _place(spark, "pacing"))
    _streamed_log(spark, sf_dir, pacing=pacing)
    return pacing.read().select("source", F.round("current_interval_s", 6).alias("current_interval_s"))


@query(ORACLE["mirror_health"])
def stream_mirrors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State of every mirror, kept over a stream of attempts."""
    mirrors = mirror_table(spark, _place(spark, "mirrors"))
    _streamed_log(spark, sf_dir, mirrors=mirrors)
    health = fetchlog.health_at(mirrors.read(), _at(_SOON))
    return health.withColumn("last_success_ts", _text_ts("last_success_ts")).withColumn("last_attempt_ts", _text_ts("last_attempt_ts"))


# The first document holds a third of all points. The sixth is cut short, the seventh has a point without
# longitude, the eighth is no GPX.
_DOCUMENT = "CASE WHEN k % 3 = 0 THEN 0 ELSE k % 16 END"


def _long_tracks(spark: SparkSession, sf_dir: str) -> str:
    """A few long GPX files, each written by one task line by line: waypoints, then the points of a track."""
    points = geo_orders(spark, sf_dir).selectExpr(
        f"CAST({_DOCUMENT} AS INT) AS doc", "IF(k % 10 = 1, 1, 3) AS part", "k",
        """CASE WHEN k % 10 = 1 THEN concat('<wpt lat="', lat2_s, '" lon="', lon2_s, '"><name>w', k, '</name></wpt>')
          WHEN k % 100 = 22 THEN concat('</trkseg><trkseg><trkpt lon="', lon_s, '" lat="', lat_s, '"><ele>7</ele></trkpt>')
          ELSE concat('<trkpt lat="', lat_s, '" lon="', lon_s, '"/>') END AS value""",
    )
    frame = spark.range(16).selectExpr(
        "CAST(id AS INT) AS doc",
        """inline(array(
          struct(0 AS part, IF(id = 7, '<kml>', concat('<?xml version="1.0"?><gpx><metadata><name>G', id, '</name></metadata>')) AS value),
          struct(2 AS part, concat('<trk><trkseg>', IF(id = 6, '<trkpt lat="1"/>', '')) AS value),
          struct(4 AS part, CASE id WHEN 5 THEN '</trkseg>' WHEN 7 THEN '</trkseg></trk></kml>' ELSE '</trkseg></trk></gpx>' END AS value)))""",
    ).selectExpr("doc", "part", "0L AS k", "value")
    path = _place(spark, "tracks")
    lines = points.unionByName(frame).repartition(16, "doc").sortWithinPartitions("doc", "part", "k")
    lines.select("doc", "value").write.partitionBy("doc").text(path)
    return path


@query(f"""WITH {GEO_SQL}, used AS (SELECT *, {_DOCUMENT} AS d FROM geo WHERE {_DOCUMENT} NOT IN (5, 6, 7)), told AS (
  SELECT d, 'wpt' AS kind, CAST(row_number() OVER (PARTITION BY d ORDER BY k) - 1 AS INT) AS point_pos, lat2 AS lat, lon2 AS lon,
    concat('w', CAST(k AS STRING)) AS name FROM used WHERE k % 10 = 1
  UNION ALL SELECT d, 'trkpt', CAST(row_number() OVER (PARTITION BY d ORDER BY k) - 1 AS INT), lat, lon, '' FROM used WHERE k % 10 <> 1)
SELECT concat('G', CAST(d AS STRING)) AS document, kind, point_pos, lat, lon, name,
  count(*) FILTER (kind = 'wpt') OVER (PARTITION BY d) AS n_waypoints FROM told""")
def gpx_landed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long GPX files read as rows, in document order; files that are no usable GPX give none."""
    into = _place(spark, "landed-tracks")
    land_gpx(spark, _long_tracks(spark, sf_dir), into)
    kinds = {"wpt": landed_points(spark, into, "waypoints"), "trkpt": landed_points(spark, into).withColumn("name", F.lit(""))}
    rows = [df.select("path", F.lit(kind).alias("kind"), "point_pos", "lat", "lon", "name") for kind, df in kinds.items()]
    names = landed_documents(spark, into).select("path", F.col("name").alias("document"), "n_waypoints")
    return rows[0].unionByName(rows[1]).join(F.broadcast(names), "path").drop("path")
