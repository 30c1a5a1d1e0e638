"""Registered queries: upsert, soft delete, failures, counters, run log."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geoingest.functions.jsonmerge import json_map
from geoingest.functions.text import pack_diag
from geoingest.operators import failures, merge, runlog
from geoingest.plans.derived import (
    EARLIER,
    ENTITY_SQL,
    FETCH_SQL,
    NOW,
    TARGET_SQL,
    customer_table,
    fetch_log,
    order_entities,
)
from geoingest.plans.registry import query, table
from geoingest.session import checkpoint_dir
from geoingest.sinks.buckets import bucketed_entities, bucketed_failures


def _now() -> Column:
    return F.lit(NOW).cast("timestamp")


def _exploded(df: DataFrame) -> DataFrame:
    """Attributes as one row each, their order being of no meaning."""
    rows = df.select("source_id", F.explode(json_map(F.col("attrs"))).alias("ak", "v"))
    return rows.select("source_id", "ak", F.to_json("v").alias("av"))


def _day(c: str) -> Column:
    return F.date_format(c, "yyyy-MM-dd").alias(c)


_LAST_ATTR = "last_attr AS (SELECT source_id, ak, arg_max(av, pos) AS av FROM attr GROUP BY source_id, ak)"

_FOLD = """fold AS (SELECT source_id, count(*) AS n_rows, max(pos) AS last_pos, min(pos) AS first_pos,
  arg_max(entity_type, pos) AS entity_type, arg_max(confidence, pos) AS confidence,
  arg_max(bbox_country, pos) FILTER (WHERE bbox_country IS NOT NULL) AS bbox_country FROM ent GROUP BY source_id),
last_geom AS (SELECT f.source_id, e.g_lat, e.g_lon FROM fold f JOIN ent e ON e.source_id = f.source_id AND e.pos = f.last_pos)"""

_X = "$.coordinates[0]"
_Y = "$.coordinates[1]"


@query(f"WITH {ENTITY_SQL}, {_LAST_ATTR} SELECT source_id, ak, av FROM last_attr")
def fold_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attributes of every key after its rows are merged in order."""
    return _exploded(merge.fold_batch(merge.as_stored(order_entities(spark, sf_dir))))


@query(f"""WITH {ENTITY_SQL}, {_FOLD} SELECT source_id, entity_type, confidence, bbox_country, g_lat, g_lon,
  CAST(n_rows AS BIGINT) AS n_rows FROM fold JOIN last_geom USING (source_id)""")
def fold_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The other fields of every key after its rows are merged in order."""
    folded = merge.fold_batch(merge.as_stored(order_entities(spark, sf_dir)))
    return folded.select(
        "source_id", "entity_type", "confidence", "bbox_country",
        F.get_json_object("geom", _Y).cast("double").alias("g_lat"),
        F.get_json_object("geom", _X).cast("double").alias("g_lon"),
        "n_rows",
    )


@query(f"""WITH {ENTITY_SQL}, {TARGET_SQL}, {_LAST_ATTR}
SELECT coalesce(n.source_id, o.source_id) AS source_id, coalesce(n.ak, o.ak) AS ak, coalesce(n.av, o.av) AS av
FROM last_attr n FULL JOIN target_attr o ON n.source_id = o.source_id AND n.ak = o.ak""")
def upsert_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attributes of the table after the upsert."""
    merged, _ = merge.upsert_entities(customer_table(spark, sf_dir), order_entities(spark, sf_dir), _now())
    return _exploded(merged)


_FIELDS = f"""WITH {ENTITY_SQL}, {TARGET_SQL}, {_FOLD}
SELECT coalesce(f.source_id, t.source_id) AS source_id,
  CASE WHEN f.source_id IS NOT NULL THEN f.entity_type ELSE t.entity_type END AS entity_type,
  CASE WHEN f.source_id IS NOT NULL THEN g.g_lon WHEN t.geom IS NOT NULL THEN 1.5 END AS g_lon,
  coalesce(f.bbox_country, t.bbox_country) AS bbox_country,
  CASE WHEN f.source_id IS NOT NULL THEN f.confidence ELSE t.confidence END AS confidence,
  CASE WHEN f.source_id IS NOT NULL THEN '2024-02-01' ELSE '2024-01-01' END AS last_seen_at,
  CASE WHEN t.source_id IS NOT NULL THEN '2024-01-01' ELSE '2024-02-01' END AS created_at,
  CASE WHEN t.was_removed AND @still THEN '2024-01-01' END AS removed_at
FROM fold f JOIN last_geom g USING (source_id) FULL JOIN target t ON f.source_id = t.source_id"""


def _fields(merged: DataFrame) -> DataFrame:
    return merged.select(
        "source_id", "entity_type", F.get_json_object("geom", _X).cast("double").alias("g_lon"),
        "bbox_country", "confidence", _day("last_seen_at"), _day("created_at"), _day("removed_at"),
    )


@query(_FIELDS.replace("@still", "f.source_id IS NULL"))
def upsert_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed fields of the table after the upsert; removed rows that came in again are active."""
    merged, _ = merge.upsert_entities(customer_table(spark, sf_dir), order_entities(spark, sf_dir), _now())
    return _fields(merged)


@query(_FIELDS.replace("@still", "true"))
def upsert_keep_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The upsert without re-activation."""
    merged, _ = merge.upsert_entities(
        customer_table(spark, sf_dir), order_entities(spark, sf_dir), _now(), soft_delete=False
    )
    return _fields(merged)


@query(f"""WITH {ENTITY_SQL}, {TARGET_SQL}, {_FOLD} SELECT f.source_id,
  CAST(CASE WHEN t.source_id IS NULL THEN 1 ELSE 0 END AS BIGINT) AS n_inserted,
  CAST(n_rows - CASE WHEN t.source_id IS NULL THEN 1 ELSE 0 END AS BIGINT) AS n_updated
FROM fold f LEFT JOIN target t ON f.source_id = t.source_id""")
def upsert_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inserts and updates per key."""
    _, outcomes = merge.upsert_entities(customer_table(spark, sf_dir), order_entities(spark, sf_dir), _now())
    return outcomes.select("source_id", "n_inserted", "n_updated")


@query(f"""WITH {ENTITY_SQL}, {TARGET_SQL}, {_FOLD} SELECT e.pos, e.source_id,
  CASE WHEN t.source_id IS NULL AND e.pos = f.first_pos THEN 'inserted' ELSE 'updated' END AS outcome
FROM ent e JOIN fold f ON f.source_id = e.source_id LEFT JOIN target t ON t.source_id = e.source_id""")
def row_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcome of every incoming row."""
    rows = merge.row_outcomes(customer_table(spark, sf_dir), order_entities(spark, sf_dir))
    return rows.select(F.col("_pos").alias("pos"), "source_id", "outcome")


@query(f"""WITH {ENTITY_SQL}, {TARGET_SQL}, {_FOLD}
SELECT source_id, ak, av, NULL AS created_at FROM target_attr
UNION ALL SELECT a.source_id, a.ak, a.av, '2024-02-01' FROM attr a JOIN fold f ON f.source_id = a.source_id AND f.first_pos = a.pos
WHERE a.source_id NOT IN (SELECT source_id FROM target)""")
def upsert_do_nothing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Insert-only load: known keys stay, of a new key the first row counts."""
    merged, _ = merge.upsert_entities(
        customer_table(spark, sf_dir), order_entities(spark, sf_dir), _now(), on_conflict=merge.DO_NOTHING
    )
    created = F.when(F.col("created_at") == _now(), F.date_format("created_at", "yyyy-MM-dd"))
    return _exploded(merged).join(merged.select("source_id", created.alias("created_at")), "source_id")


@query(f"""WITH {ENTITY_SQL}, {TARGET_SQL}, {_FOLD} SELECT f.source_id,
  CAST(CASE WHEN t.source_id IS NULL THEN 1 ELSE 0 END AS BIGINT) AS n_inserted,
  CAST(n_rows - CASE WHEN t.source_id IS NULL THEN 1 ELSE 0 END AS BIGINT) AS n_skipped
FROM fold f LEFT JOIN target t ON f.source_id = t.source_id""")
def insert_only_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inserts and skips per key of the insert-only load."""
    _, outcomes = merge.upsert_entities(
        customer_table(spark, sf_dir), order_entities(spark, sf_dir), _now(), on_conflict=merge.DO_NOTHING
    )
    return outcomes.select("source_id", "n_inserted", "n_skipped")


def _deleted_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").where("o_orderkey % 3 = 0").selectExpr(
        "'crm' AS source", "CAST(o_custkey AS STRING) AS source_id"
    )


_GONE = f"""WITH {TARGET_SQL}, gone AS (SELECT DISTINCT CAST(o_custkey AS STRING) AS source_id FROM orders WHERE o_orderkey % 3 = 0)"""


@query(f"""{_GONE} SELECT t.source_id,
  CASE WHEN was_removed THEN '2024-01-01' WHEN g.source_id IS NOT NULL THEN '2024-02-01' END AS removed_at
FROM target t LEFT JOIN gone g USING (source_id)""")
def soft_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Removal time of every row after a soft delete."""
    updated, _ = merge.soft_delete_entities(
        customer_table(spark, sf_dir), _deleted_keys(spark, sf_dir), _now()
    )
    return updated.select("source_id", _day("removed_at"))


@query(f"{_GONE} SELECT t.source_id FROM target t JOIN gone g USING (source_id) WHERE NOT was_removed")
def soft_deleted_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys a soft delete changed."""
    _, changed = merge.soft_delete_entities(
        customer_table(spark, sf_dir), _deleted_keys(spark, sf_dir), _now()
    )
    return changed.select("source_id")


@query(f"""{_GONE}, back AS (SELECT DISTINCT CAST(o_custkey AS STRING) AS source_id FROM orders)
SELECT source_id, CASE WHEN b.source_id IS NULL AND was_removed THEN '2024-01-01' END AS removed_at
FROM target t FULL JOIN back b USING (source_id)""")
def reactivate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Soft delete, then an upsert: every row that comes in again is active."""
    removed, _ = merge.soft_delete_entities(
        customer_table(spark, sf_dir), _deleted_keys(spark, sf_dir), _now()
    )
    merged, _ = merge.upsert_entities(removed, order_entities(spark, sf_dir), _now())
    return merged.select("source_id", _day("removed_at"))


def _mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities of which some cannot be stored."""
    return (
        order_entities(spark, sf_dir)
        .withColumn("entity_type", F.expr("CASE WHEN _pos % 17 = 0 THEN NULL ELSE entity_type END"))
        .withColumn("attrs", F.expr("CASE WHEN _pos % 13 = 0 THEN '[1]' WHEN _pos % 11 = 0 THEN '{bad' ELSE attrs END"))
    )


@query("""SELECT CAST(o_orderkey AS BIGINT) AS pos,
  CASE WHEN o_orderkey % 17 = 0 THEN 'null value in column entity_type' ELSE 'attrs is not a JSON object' END AS reason
FROM orders WHERE o_orderkey % 17 = 0 OR o_orderkey % 13 = 0 OR o_orderkey % 11 = 0""")
def rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows the table refuses, with the reason."""
    _, refused = merge.reject_invalid(_mixed(spark, sf_dir))
    return refused.select(F.col("_pos").alias("pos"), "reason")


@query("SELECT 'inserted' AS outcome, CAST(count(*) AS BIGINT) AS n FROM orders")
def dry_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.dry_run(order_entities(spark, sf_dir)).groupBy("outcome").agg(F.count("*").alias("n"))


_EVENT = [
    "'feed' AS source",
    "concat('u', CAST(user_id AS STRING)) AS source_id",
    "CASE WHEN event_id % 4 = 0 THEN NULL ELSE concat(event_type, ' ', CAST(event_id AS STRING)) END AS text",
    "CASE WHEN event_id % 3 = 0 THEN concat('https://x.example/', CAST(event_id AS STRING)) ELSE 'local.gpx' END AS raw_ref",
    "event_id % 5 AS has_point",
    "CASE WHEN event_id % 2 = 0 THEN 'fetch' ELSE 'normalize' END AS stage",
    "concat('problem ', repeat('x', CAST(event_id % 3000 AS INT))) AS detail",
    "event_id AS _pos",
]
_FAILED_SQL = f"ev AS (SELECT {', '.join(_EVENT)} FROM events WHERE event_type = 'error')"


def _failure_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").where("event_type = 'error'").selectExpr(*_EVENT)
    point = "CASE WHEN has_point = 0 THEN named_struct('lat', CAST(_pos % 90 AS DOUBLE), 'lon', CAST(_pos % 180 AS DOUBLE)) END"
    return events.withColumn("coord_hint", F.expr(point)).drop("has_point")


_KNOWN_KEY = "concat(CASE WHEN user_id % 3 = 0 THEN 'u' ELSE 'former-u' END, CAST(user_id AS STRING))"


def _known_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored failures of all users; those whose number is no multiple of three go by another key."""
    users = table(spark, sf_dir, "events").select("user_id").distinct()
    return users.selectExpr(
        "'feed' AS source", f"{_KNOWN_KEY} AS source_id", "'old title' AS title",
        "CAST(NULL AS STRING) AS url", "CAST(NULL AS STRING) AS geom", "'parse' AS failure_stage",
        "'old' AS failure_detail", "CAST(user_id % 4 + 1 AS BIGINT) AS attempts",
        f"CAST('{EARLIER}' AS TIMESTAMP) AS first_attempt_at", f"CAST('{EARLIER}' AS TIMESTAMP) AS last_attempt_at",
    )


@query(f"""WITH {_FAILED_SQL} SELECT _pos AS pos, source_id, substr(text, 1, 200) AS title,
  CASE WHEN raw_ref LIKE 'https://%' THEN raw_ref END AS url, CAST(CASE WHEN has_point = 0 THEN _pos % 180 END AS DOUBLE) AS x,
  stage AS failure_stage, substr(detail, 1, 2000) AS failure_detail FROM ev""")
def failure_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failure events as they are stored."""
    return failures.failure_projection(_failure_events(spark, sf_dir)).select(
        F.col("_pos").alias("pos"), "source_id", "title", "url",
        F.get_json_object("geom", _X).cast("double").alias("x"), "failure_stage", "failure_detail",
    )


_FAILURES = f"""WITH {_FAILED_SQL}, s AS (SELECT source_id, count(*) AS n, arg_max(stage, _pos) AS st, arg_max(substr(detail, 1, 2000), _pos) AS de,
  arg_max(text, _pos) FILTER (WHERE text IS NOT NULL) AS ti, arg_max(raw_ref, _pos) FILTER (WHERE raw_ref LIKE 'https://%') AS ur,
  arg_max(_pos % 180, _pos) FILTER (WHERE has_point = 0) AS x FROM ev GROUP BY source_id),
t AS (SELECT DISTINCT {_KNOWN_KEY} AS source_id, user_id % 4 + 1 AS n FROM events)
SELECT coalesce(s.source_id, t.source_id) AS source_id, coalesce(ti, CASE WHEN t.source_id IS NOT NULL THEN 'old title' END) AS title, ur AS url,
  CAST(x AS DOUBLE) AS x, coalesce(st, 'parse') AS failure_stage, md5(coalesce(de, 'old')) AS detail_digest,
  CAST(coalesce(s.n, 0) + coalesce(t.n, 0) AS BIGINT) AS attempts,
  CASE WHEN t.source_id IS NULL THEN '2024-02-01' ELSE '2024-01-01' END AS first_attempt_at,
  CASE WHEN s.source_id IS NULL THEN '2024-01-01' ELSE '2024-02-01' END AS last_attempt_at
FROM s FULL JOIN t ON s.source_id = t.source_id"""


@query(_FAILURES)
def failure_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failure table after the events of a run."""
    return _shown_failures(failures.record_failures(_known_failures(spark, sf_dir), _failure_events(spark, sf_dir), _now()))


def _shown_failures(out: DataFrame) -> DataFrame:
    return out.select(
        "source_id", "title", "url", F.get_json_object("geom", _X).cast("double").alias("x"), "failure_stage",
        F.md5("failure_detail").alias("detail_digest"), "attempts", _day("first_attempt_at"), _day("last_attempt_at"),
    )


def _table_path(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark)}/tables/{name}-{uuid4().hex}"


@query(_FIELDS.replace("@still", "f.source_id IS NULL"))
def upsert_in_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored table after a commit that rewrites the touched buckets, and a replay of it."""
    stored = bucketed_entities(spark, _table_path(spark, "entities"))
    stored.apply(customer_table(spark, sf_dir), lambda _, batch: batch, "load")
    for _ in range(2):
        stored.upsert(order_entities(spark, sf_dir), _now(), tag="orders")
    return _fields(stored.read())


@query(f"""{_GONE} SELECT t.source_id,
  CASE WHEN was_removed THEN '2024-01-01' WHEN g.source_id IS NOT NULL THEN '2024-02-01' END AS removed_at
FROM target t LEFT JOIN gone g USING (source_id)""")
def soft_delete_in_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored table after a soft delete that rewrites the touched buckets."""
    stored = bucketed_entities(spark, _table_path(spark, "entities"))
    stored.apply(customer_table(spark, sf_dir), lambda _, batch: batch, "load")
    stored.soft_delete(_deleted_keys(spark, sf_dir), _now(), tag="gone")
    return stored.read().select("source_id", _day("removed_at"))


@query(_FAILURES)
def failures_in_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored failures after a run and its replay: no attempt is counted twice."""
    stored = bucketed_failures(spark, _table_path(spark, "failures"))
    stored.apply(_known_failures(spark, sf_dir), lambda _, batch: batch, "load")
    for _ in range(2):
        stored.record_failures(_failure_events(spark, sf_dir), _now(), tag="run")
    return _shown_failures(stored.read())


# Outcomes of a run with two sinks, one row per record and sink; sink 1 refuses some rows.
_RUN = [
    "concat('s', CAST(user_id % 8 AS STRING)) AS source",
    "event_id AS _pos",
    "CASE event_type WHEN 'signup' THEN 'inserted' WHEN 'error' THEN 'failed' WHEN 'purchase' THEN 'skipped' ELSE 'updated' END AS outcome",
    "CASE event_type WHEN 'error' THEN concat('persist[db]: E: ', CAST(event_id AS STRING)) WHEN 'purchase' THEN 'adapter_returned_none' END AS error",
]
_RUN_SQL = f"""r0 AS (SELECT {', '.join(_RUN)} FROM events), run AS (SELECT source, _pos, outcome, error, 0 AS sink_rank FROM r0
  UNION ALL SELECT source, _pos, CASE WHEN _pos % 6 = 0 THEN 'failed' ELSE 'inserted' END, NULL, 1 FROM r0 WHERE outcome <> 'skipped')"""


def _run(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = table(spark, sf_dir, "events").selectExpr(*_RUN).withColumn("sink_rank", F.lit(0))
    second = first.where("outcome <> 'skipped'").select(
        "source", "_pos", F.expr("CASE WHEN _pos % 6 = 0 THEN 'failed' ELSE 'inserted' END").alias("outcome"),
        F.lit(None).cast("string").alias("error"), F.lit(1).alias("sink_rank"),
    )
    return first.unionByName(second)


_COUNTS = """counts AS (SELECT source, count(*) FILTER (WHERE sink_rank = 0) AS rows_total,
  count(*) FILTER (WHERE outcome = 'inserted') AS rows_inserted, count(*) FILTER (WHERE outcome = 'updated') AS rows_updated,
  count(*) FILTER (WHERE outcome = 'skipped') AS rows_skipped, count(*) FILTER (WHERE outcome = 'failed') AS rows_failed FROM run GROUP BY source)"""


@query(f"WITH {_RUN_SQL}, {_COUNTS} SELECT * FROM counts")
def run_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters of a run per source."""
    return runlog.run_counters(_run(spark, sf_dir))


@query(f"""WITH {_RUN_SQL}, {_COUNTS} SELECT CAST(sum(rows_total) AS BIGINT) AS rows_total, CAST(sum(rows_inserted) AS BIGINT) AS rows_inserted,
  CAST(sum(rows_updated) AS BIGINT) AS rows_updated, CAST(sum(rows_skipped) AS BIGINT) AS rows_skipped,
  CAST(sum(rows_failed) AS BIGINT) AS rows_failed, CAST(sum(rows_total * 3) AS BIGINT) AS duration_ms FROM counts""")
def merge_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters of all workers together; durations add up."""
    counters = runlog.run_counters(_run(spark, sf_dir)).withColumn("duration_ms", F.col("rows_total") * 3)
    return runlog.merge_counters(counters)


@query(f"WITH {_RUN_SQL} SELECT source, arg_min(error, _pos) AS error FROM run WHERE error IS NOT NULL GROUP BY source")
def first_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runlog.first_error(_run(spark, sf_dir))


@query(f"""WITH {_RUN_SQL}, e AS (SELECT source, _pos, error, row_number() OVER (PARTITION BY source ORDER BY _pos) AS rank FROM run WHERE error IS NOT NULL)
SELECT source, CAST(rank AS INT) AS rank, _pos AS pos, error FROM e WHERE rank <= 3""")
def errors_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First three errors per source."""
    return runlog.errors_sample(_run(spark, sf_dir)).withColumnRenamed("_pos", "pos")


@query(f"""WITH {_RUN_SQL}, {_COUNTS}, {FETCH_SQL},
err AS (SELECT source, arg_min(error, _pos) AS error FROM run WHERE error IS NOT NULL GROUP BY source),
st AS (SELECT source, arg_max(status, event_id) AS http_status FROM fetchlog GROUP BY source)
SELECT 'r1' AS run_id, source, rows_inserted AS rows_added, rows_updated, http_status, error, CAST(1500 AS BIGINT) AS duration_ms
FROM counts LEFT JOIN err USING (source) LEFT JOIN st USING (source)""")
def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run log row of every source."""
    outcomes = _run(spark, sf_dir)
    return runlog.run_log_row(
        runlog.run_counters(outcomes), outcomes, run_id=F.lit("r1"), run_ts=_now(),
        http_status=runlog.last_http_status(fetch_log(spark, sf_dir), tie="event_id"), duration_ms=F.lit(1500),
    ).drop("run_ts")


@query(f"""WITH {_RUN_SQL}, {_COUNTS} SELECT source, concat('{{"source":"', source, '","rows_total":', CAST(rows_total AS STRING), ',"rows_inserted":', CAST(rows_inserted AS STRING),
  ',"rows_updated":', CAST(rows_updated AS STRING), ',"rows_skipped":', CAST(rows_skipped AS STRING), ',"rows_failed":', CAST(rows_failed AS STRING), '}}') AS summary FROM counts""")
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters as JSON."""
    return runlog.run_summary(runlog.run_counters(_run(spark, sf_dir))).select(
        F.get_json_object("summary", "$.source").alias("source"), "summary"
    )


@query("""SELECT event_id, concat(CASE WHEN event_id % 2 = 0 THEN concat(event_type, ' | ') ELSE '' END,
  'channels_ok=', CAST(user_id AS STRING), '|duration_s=', CAST(event_id % 60 AS STRING)) AS error FROM events""")
def diag_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Diagnostics packed for the error column."""
    diag = F.create_map(
        F.lit("channels_ok"), F.col("user_id").cast("string"),
        F.lit("duration_s"), (F.col("event_id") % 60).cast("string"),
    )
    prefix = F.expr("CASE WHEN event_id % 2 = 0 THEN event_type END")
    return table(spark, sf_dir, "events").select("event_id", pack_diag(diag, prefix).alias("error"))


@query(f"""WITH {FETCH_SQL}, log AS (SELECT source, ts, status, event_id % 9 AS added, event_id % 4 AS updated,
  CASE WHEN status >= 400 THEN concat('HTTP ', CAST(status AS STRING)) END AS error FROM fetchlog
  WHERE ts > TIMESTAMP '2024-01-21 00:00:00' AND ts <= TIMESTAMP '2024-01-28 00:00:00')
SELECT source, CAST(count(*) AS BIGINT) AS runs, CAST(sum(added) AS BIGINT) AS rows_added, CAST(sum(updated) AS BIGINT) AS rows_updated,
  CAST(count(error) AS BIGINT) AS runs_with_error, arg_max(status, ts) AS last_http_status FROM log GROUP BY source""")
def source_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last seven days of a run log per source."""
    log = fetch_log(spark, sf_dir).select(
        "source", F.col("ts").cast("timestamp").alias("run_ts"), (F.col("event_id") % 9).alias("rows_added"),
        (F.col("event_id") % 4).alias("rows_updated"), F.col("status").alias("http_status"),
        F.when(F.col("status") >= 400, F.concat(F.lit("HTTP "), F.col("status"))).alias("error"),
    )
    return runlog.source_health(log, F.lit("2024-01-28 00:00:00").cast("timestamp")).drop("last_run_ts")
