"""Inputs derived from the given tables with the same integer arithmetic in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from geoingest.plans.registry import table
from geoingest.session import spread


def _signed(m: str, div: str) -> str:
    return (
        f"concat(CASE WHEN {m} < 0 THEN '-' ELSE '' END, CAST(abs({m}) {div} 1000 AS STRING), '.', "
        f"lpad(CAST(abs({m}) % 1000 AS STRING), 3, '0'))"
    )


_LAT_M = "(k * 7919) % 200000 - 100000"
_LON_M = "(k * 104729) % 400000 - 200000"

_LINK = """CASE k % 6
  WHEN 0 THEN concat('https://yandex.ru/maps/?ll=', lon_s, '%2C', lat_s, '&z=10')
  WHEN 1 THEN concat('https://maps.google.com/?q=', lat_s, ',', lon_s)
  WHEN 2 THEN concat('https://www.google.com/maps/@', lat_s, ',', lon_s, ',15z')
  WHEN 3 THEN concat('https://www.openstreetmap.org/?mlat=', lat_s, '&mlon=', lon_s)
  WHEN 4 THEN concat('https://example.com/?q=', lat_s, ',', lon_s)
  ELSE concat('https://brouter.de/brouter/#lonlats=', lon_s, ',', lat_s, ';', lon2_s, ',', lat2_s, '&profile=river')
END"""


def geo_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with coordinates (some out of range), their texts, a second point and a map link."""
    base = spread(
        table(spark, sf_dir, "orders").selectExpr(
            "CAST(o_orderkey AS BIGINT) AS k", "o_custkey", "o_orderstatus", "o_orderpriority"
        )
    )
    metric = base.selectExpr(
        "*", f"{_LAT_M} AS lat_m", f"{_LON_M} AS lon_m",
        "(k * 31) % 90000 AS lat2_m", "(k * 57) % 180000 AS lon2_m",
    )
    return metric.selectExpr(
        "*",
        "CAST(lat_m AS DOUBLE) / 1000 AS lat",
        "CAST(lon_m AS DOUBLE) / 1000 AS lon",
        "CAST(lat2_m AS DOUBLE) / 1000 AS lat2",
        "CAST(lon2_m AS DOUBLE) / 1000 AS lon2",
        f"{_signed('lat_m', 'div')} AS lat_s",
        f"{_signed('lon_m', 'div')} AS lon_s",
        f"{_signed('lat2_m', 'div')} AS lat2_s",
        f"{_signed('lon2_m', 'div')} AS lon2_s",
    ).selectExpr("*", f"{_LINK} AS url")


GEO_SQL = f"""geo0 AS (
  SELECT CAST(o_orderkey AS BIGINT) AS k, o_custkey, o_orderstatus, o_orderpriority FROM orders
), geo1 AS (
  SELECT *, {_LAT_M} AS lat_m, {_LON_M} AS lon_m, (k * 31) % 90000 AS lat2_m, (k * 57) % 180000 AS lon2_m FROM geo0
), geo2 AS (
  SELECT *, CAST(lat_m AS DOUBLE) / 1000 AS lat, CAST(lon_m AS DOUBLE) / 1000 AS lon,
    CAST(lat2_m AS DOUBLE) / 1000 AS lat2, CAST(lon2_m AS DOUBLE) / 1000 AS lon2,
    {_signed('lat_m', '//')} AS lat_s, {_signed('lon_m', '//')} AS lon_s,
    {_signed('lat2_m', '//')} AS lat2_s, {_signed('lon2_m', '//')} AS lon2_s
  FROM geo1
), geo AS (
  SELECT *, {_LINK} AS url,
    abs(lat_m) <= 90000 AND abs(lon_m) <= 180000 AS ok
  FROM geo2
)"""

COUNTRY_SQL = """CASE
  WHEN lat BETWEEN 51 AND 56.5 AND lon BETWEEN 23 AND 33 THEN 'BY'
  WHEN lat BETWEEN 40 AND 56 AND lon BETWEEN 46 AND 88 THEN 'KZ'
  WHEN lat BETWEEN 44 AND 53 AND lon BETWEEN 22 AND 41 THEN 'UA'
  WHEN lat BETWEEN 41 AND 82 AND lon BETWEEN 19 AND 180 THEN 'RU'
  ELSE 'unknown' END"""

_STATUS = """CASE
  WHEN event_id % 13 = 0 THEN 0
  WHEN event_id % 11 = 0 THEN 406
  WHEN event_type IN ('view', 'click') THEN 200
  WHEN event_type = 'signup' THEN 304
  WHEN event_type = 'purchase' THEN 429
  ELSE 503 END"""

_FETCH = f"""event_id, ts, user_id, event_type, props,
  concat('https://s', CAST(user_id % 7 AS STRING), '.example/', CAST(event_id % 4001 AS STRING)) AS url,
  concat('s', CAST(user_id % 8 AS STRING)) AS source,
  concat('m', CAST(user_id % 3 AS STRING)) AS mirror,
  concat('strategy', CAST(event_id % 3 AS STRING)) AS strategy,
  CAST(event_id % 3 AS INT) AS strategy_rank,
  CAST((event_id {{div}} 7) % 5 + 1 AS INT) AS attempt,
  CAST({_STATUS} AS INT) AS status"""


def fetch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as attempts of a fetcher."""
    return spark.sql(
        f"SELECT {_FETCH.format(div='div')} FROM {{events}}", events=table(spark, sf_dir, "events")
    )


FETCH_SQL = f"fetchlog AS (SELECT {_FETCH.format(div='//')} FROM events)"

NOW = "2024-02-01 00:00:00"
EARLIER = "2024-01-01 00:00:00"

# Entities of one source: orders keyed by customer, in order of the order key.
_ENTITY_ATTRS = """concat('{"priority":"', o_orderpriority, '","status":',
  CASE WHEN k % 5 = 0 THEN 'null' ELSE concat('"', o_orderstatus, '"') END,
  ',"slot', CAST(k % 3 AS STRING), '":', CAST(k AS STRING), '}')"""


def order_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geo_orders(spark, sf_dir).selectExpr(
        "CASE WHEN k % 2 = 0 THEN 'station' ELSE 'stop' END AS entity_type",
        "'crm' AS source",
        "CAST(o_custkey AS STRING) AS source_id",
        "CASE WHEN k % 4 <> 0 THEN named_struct('lat', lat, 'lon', lon) END AS geom",
        f"{_ENTITY_ATTRS} AS attrs",
        f"CASE WHEN k % 7 = 0 THEN {COUNTRY_SQL} END AS bbox_country",
        "CAST(k % 10 AS DOUBLE) / 10 AS confidence",
        "k AS _pos",
    )


ENTITY_SQL = f"""{GEO_SQL}, ent AS (
  SELECT CASE WHEN k % 2 = 0 THEN 'station' ELSE 'stop' END AS entity_type, 'crm' AS source,
    CAST(o_custkey AS STRING) AS source_id,
    CASE WHEN k % 4 <> 0 THEN lat END AS g_lat, CASE WHEN k % 4 <> 0 THEN lon END AS g_lon,
    CASE WHEN k % 7 = 0 THEN {COUNTRY_SQL} END AS bbox_country,
    CAST(k % 10 AS DOUBLE) / 10 AS confidence, k AS pos,
    o_orderpriority, o_orderstatus, k
  FROM geo
), attr AS (
  SELECT source, source_id, pos, 'priority' AS ak, concat('"', o_orderpriority, '"') AS av FROM ent
  UNION ALL SELECT source, source_id, pos, 'status',
    CASE WHEN k % 5 = 0 THEN 'null' ELSE concat('"', o_orderstatus, '"') END FROM ent
  UNION ALL SELECT source, source_id, pos, concat('slot', CAST(k % 3 AS STRING)), CAST(k AS STRING) FROM ent
)"""


# Orders meet the even customers only, so that both known and new keys come in.
_STORED_KEY = "CASE WHEN c_custkey % 2 = 0 THEN c_custkey ELSE c_custkey + 1000000000 END"


def customer_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored entities: all customers, those with an odd key under another one, every tenth one removed."""
    return table(spark, sf_dir, "customer").selectExpr(
        "'crm' AS source",
        f"CAST({_STORED_KEY} AS STRING) AS source_id",
        "'customer' AS entity_type",
        "CASE WHEN c_custkey % 3 = 0 THEN '{\"type\":\"Point\",\"coordinates\":[1.5,2.5]}' END AS geom",
        "concat('{\"segment\":\"', c_mktsegment, '\",\"status\":\"old\",\"slot1\":', CAST(c_nationkey AS STRING), '}') AS attrs",
        "CASE WHEN c_custkey % 4 = 0 THEN 'UA' END AS bbox_country",
        "CAST(1 AS DOUBLE) AS confidence",
        f"CAST('{EARLIER}' AS TIMESTAMP) AS last_seen_at",
        f"CAST('{EARLIER}' AS TIMESTAMP) AS created_at",
        f"CASE WHEN c_custkey % 10 = 0 THEN CAST('{EARLIER}' AS TIMESTAMP) END AS removed_at",
    )


TARGET_SQL = f"""target AS (
  SELECT 'crm' AS source, CAST({_STORED_KEY} AS STRING) AS source_id, 'customer' AS entity_type,
    CASE WHEN c_custkey % 3 = 0 THEN '{{"type":"Point","coordinates":[1.5,2.5]}}' END AS geom,
    CASE WHEN c_custkey % 4 = 0 THEN 'UA' END AS bbox_country, CAST(1 AS DOUBLE) AS confidence,
    c_mktsegment, c_nationkey, CAST(c_custkey % 10 = 0 AS BOOLEAN) AS was_removed
  FROM customer
), target_attr AS (
  SELECT source, source_id, 'segment' AS ak, concat('"', c_mktsegment, '"') AS av FROM target
  UNION ALL SELECT source, source_id, 'status', '"old"' FROM target
  UNION ALL SELECT source, source_id, 'slot1', CAST(c_nationkey AS STRING) FROM target
)"""
