"""Registered queries: routed tracks and media."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoingest.functions import media as media_fn
from geoingest.functions.coords import latlon
from geoingest.functions.tracks import route_coordinates as line_of
from geoingest.functions.tracks import track_quality as quality_of
from geoingest.operators import enrich
from geoingest.plans.derived import GEO_SQL, geo_orders
from geoingest.plans.registry import query, table
from geoingest.sources.media import media_geo as geo_of


@query("""SELECT CAST(o_orderkey AS BIGINT) AS k, CAST(o_orderkey % 16 - 2 AS INT) AS npts,
  CASE WHEN o_orderkey % 16 - 2 <= 0 THEN 'unknown' WHEN o_orderkey % 16 - 2 = 2 THEN 'placeholder'
       WHEN o_orderkey % 16 - 2 <= 10 THEN 'sparse' ELSE 'real' END AS quality FROM orders""")
def track_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = (F.col("o_orderkey") % 16 - 2).cast("int")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("bigint").alias("k"), n.alias("npts"), quality_of(n).alias("quality")
    )


def _routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities with a finish on most rows; routes repeat, as only 500 start points exist."""
    return geo_orders(spark, sf_dir).selectExpr(
        "'raw' AS entity_type", "'web' AS source", "CAST(k AS STRING) AS source_id",
        "CASE WHEN k % 7 <> 0 THEN named_struct('lat', CAST(k % 500 AS DOUBLE) / 10, 'lon', CAST(k % 500 AS DOUBLE) / 4) END AS geom",
        """CASE WHEN k % 5 = 0 THEN '{"finish_lat":1}' ELSE concat('{"finish_lat":', k % 500, CASE k % 500 % 3 WHEN 0 THEN '' WHEN 1 THEN '.0' ELSE '.10' END, ',"finish_lon":', k % 500, '.5}') END AS attrs""",
        "CAST(NULL AS STRING) AS bbox_country", "CAST(1 AS DOUBLE) AS confidence", "k AS _pos",
    )


_URL = """concat('https://brouter.de/brouter?lonlats=', CAST(CAST(k % 500 AS DOUBLE) / 4 AS STRING), '%2C',
  CAST(CAST(k % 500 AS DOUBLE) / 10 AS STRING), '%7C', CAST(k % 500 AS STRING), '.5%2C', CAST(k % 500 AS STRING),
  CASE k % 500 % 3 WHEN 0 THEN '' WHEN 1 THEN '.0' ELSE '.1' END, '&profile=river&alternativeidx=0&format=geojson')"""


@query(f"WITH {GEO_SQL} SELECT k, {_URL} AS url FROM geo WHERE k % 7 <> 0 AND k % 5 <> 0")
def route_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Route requests of the entities that have two ends."""
    df = _routes(spark, sf_dir).where(enrich.routable(F.col("geom"), F.col("attrs")))
    return df.select(F.col("_pos").alias("k"), enrich.route_url(F.col("geom"), F.col("attrs")).alias("url"))


def _route_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One landed response per route: lines of r % 14 points, errors, empty and other geometries."""
    starts = geo_orders(spark, sf_dir).selectExpr("k % 500 AS k").distinct().withColumn("r", F.col("k"))
    line = """concat('{"features":[{"geometry":{"type":"', CASE WHEN r % 13 = 1 THEN 'Point' ELSE 'LineString' END, '","coordinates":[',
        array_join(transform(sequence(0, CAST(r % 14 AS INT)), i -> concat('[', i, '.25,', i, '.5]')), ','), ',[200,95]]}}]}')"""
    return starts.selectExpr(
        f"{_URL} AS url", "r",
        "CASE WHEN r % 11 = 0 THEN 400 ELSE 200 END AS status",
        f"CASE WHEN r % 17 = 0 THEN '{{\"features\":[]}}' WHEN r % 19 = 0 THEN 'busy' ELSE {line} END AS body",
    )


_USABLE = "r % 11 <> 0 AND r % 17 <> 0 AND r % 19 <> 0 AND r % 13 <> 1"


@query(f"""WITH {GEO_SQL}, starts AS (SELECT DISTINCT k % 500 AS r FROM geo)
SELECT r, CAST(i AS INT) AS point_pos, CAST(i + 0.5 AS DOUBLE) AS lat, CAST(i + 0.25 AS DOUBLE) AS lon
FROM (SELECT r, unnest(range(0, r % 14 + 1)) AS i FROM starts WHERE {_USABLE})""")
def route_coordinates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points of the usable route responses."""
    rows = _route_responses(spark, sf_dir).select(
        "r", F.posexplode(line_of(F.col("body"), F.col("status"))).alias("point_pos", "p")
    )
    return rows.select("r", "point_pos", "p.lat", "p.lon")


@query(f"""WITH {GEO_SQL}, e AS (SELECT k, k % 500 AS r, k % 7 <> 0 AND k % 5 <> 0 AS two_ends FROM geo),
t AS (SELECT *, CASE WHEN two_ends AND {_USABLE} AND r % 14 >= 1 THEN r % 14 + 1 END AS n FROM e)
SELECT k, CAST(n AS INT) AS npts, CASE WHEN n = 2 THEN 'placeholder' WHEN n <= 10 THEN 'sparse' WHEN n > 10 THEN 'real' END AS quality,
  CASE WHEN n IS NOT NULL THEN 'brouter' END AS track_source, CAST(CASE WHEN n IS NOT NULL THEN n - 1 + 0.5 END AS DOUBLE) AS last_lat,
  CASE WHEN k % 5 = 0 THEN 1 ELSE k % 500 END AS finish_lat FROM t""")
def enrich_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities with the routed track stamped on them where there is one."""
    out = enrich.enrich(
        _routes(spark, sf_dir), [lambda df: enrich.enrich_tracks(df, _route_responses(spark, sf_dir))]
    )
    v = F.parse_json("attrs")
    get = lambda path, kind: F.try_variant_get(v, path, kind)
    n = get("$.track_npts", "int")
    track = F.try_element_at(get("$.track", "array<array<double>>"), F.lit(-1))
    return out.select(
        F.col("_pos").alias("k"), n.alias("npts"), get("$.track_quality", "string").alias("quality"),
        get("$.track_source", "string").alias("track_source"), F.get(track, F.lit(0)).alias("last_lat"),
        get("$.finish_lat", "bigint").alias("finish_lat"),
    )


@query("""SELECT event_id, strftime(CASE WHEN event_id % 7 = 0 THEN NULL ELSE date_trunc('second', ts) END, '%Y-%m-%d %H:%M:%S') AS taken_at FROM events""")
def exif_datetime(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Capture texts to timestamps; short and impossible ones are null."""
    text = F.expr(
        "CASE WHEN event_id % 14 = 0 THEN '2024:13:01 00:00:00' WHEN event_id % 7 = 0 THEN '2024:01' "
        "ELSE concat(date_format(ts, 'yyyy:MM:dd HH:mm:ss'), '\\0 ') END"
    )
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.date_format(media_fn.exif_datetime(text), "yyyy-MM-dd HH:mm:ss").alias("taken_at"),
    )


_ISO = """concat(CASE WHEN k % 10 = 0 THEN '' WHEN lat_m < 0 THEN '' ELSE '+' END, lat_s, CASE WHEN lon_m < 0 THEN '' ELSE '+' END, lon_s,
  CASE WHEN k % 3 = 0 THEN '+150.0/' ELSE '/' END)"""


@query(f"WITH {GEO_SQL} SELECT k, lat, lon FROM geo WHERE NOT (k % 10 = 0 AND lat_m >= 0)")
def iso6709(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signed position texts, with and without altitude; a missing sign gives nothing."""
    df = geo_orders(spark, sf_dir).select("k", media_fn.iso6709(F.expr(_ISO)).alias("p"))
    return df.where("p is not null").select("k", "p.lat", "p.lon")


@query("""SELECT event_id, CAST(CASE WHEN event_id % 6 = 0 THEN 0.0 WHEN event_id % 6 IN (1, 2) THEN 0.5
  WHEN abs(event_id % 97 - 48) <= 24 THEN 0.9 ELSE 0.5 END AS DOUBLE) AS confidence FROM events""")
def confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trust in a media position by the time between capture and posting."""
    taken = F.expr("CASE WHEN event_id % 6 <> 1 THEN CAST(ts AS TIMESTAMP) END")
    posted = F.expr(
        "CASE WHEN event_id % 6 <> 2 THEN timestampadd(HOUR, CAST(event_id % 97 - 48 AS INT), CAST(ts AS TIMESTAMP)) END"
    )
    return table(spark, sf_dir, "events").select(
        "event_id",
        media_fn.geo_confidence(F.col("event_id") % 6 != 0, taken, posted).alias("confidence"),
    )


def _hex_le(n: str, size: int) -> str:
    """Hex text of an unsigned little-endian integer, as Spark SQL."""
    big = f"lpad(hex(CAST({n} AS BIGINT)), {2 * size}, '0')"
    return "concat(" + ", ".join(f"substring({big}, {2 * i + 1}, 2)" for i in reversed(range(size))) + ")"


def _rationals(a: str, b: str, c: str) -> str:
    """Three value/1000 rationals, the last one with its own divisor."""
    parts = [(a, "1"), (b, "1"), (c, "10")]
    return ", ".join(f"{_hex_le(n, 4)}, {_hex_le(d, 4)}" for n, d in parts)


def _entry(tag: int, kind: int, count: int, value: str) -> str:
    return f"{_hex_le(str(tag), 2)}, {_hex_le(str(kind), 2)}, {_hex_le(str(count), 4)}, {value}"


def _photos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as little-endian JPEG bytes with a position directory and a capture time."""
    # Offsets inside the TIFF block: header 8, root 2 + 2*12 + 4 = 38, position directory at 38.
    gps_at, exif_at = 38, 38 + 2 + 4 * 12 + 4
    lat_at = exif_at + 2 + 12 + 4
    lon_at, time_at = lat_at + 24, lat_at + 48
    ref = lambda cond, yes, no: f"CASE WHEN {cond} THEN '{yes:02x}000000' ELSE '{no:02x}000000' END"
    tiff = ", ".join(
        [
            "'49492A00'", _hex_le("8", 4),
            _hex_le("2", 2), _entry(0x8825, 4, 1, _hex_le(str(gps_at), 4)), _entry(0x8769, 4, 1, _hex_le(str(exif_at), 4)), "'00000000'",
            _hex_le("4", 2),
            _entry(1, 2, 2, ref("k % 2 = 0", ord("N"), ord("S"))), _entry(2, 5, 3, _hex_le(str(lat_at), 4)),
            _entry(3, 2, 2, ref("k % 3 = 0", ord("E"), ord("W"))), _entry(4, 5, 3, _hex_le(str(lon_at), 4)), "'00000000'",
            _hex_le("1", 2), _entry(0x9003, 2, 20, _hex_le(str(time_at), 4)), "'00000000'",
            _rationals("k % 90", "k % 60", "k % 600"), _rationals("k % 180", "k % 59", "k % 599"),
            "hex('2024:05:06 07:08:09')", "'00'",
        ]
    )
    # Every fourth photo has another APP1 segment in front, every fifth is cut before its EXIF data.
    jpeg = f"""concat('FFD8', CASE WHEN k % 4 = 0 THEN 'FFE1000868747470003A' ELSE '' END,
      CASE WHEN k % 5 = 0 THEN 'FFD9' ELSE concat('FFE1', lpad(hex(CAST(8 + length(t) / 2 AS BIGINT)), 4, '0'), '457869660000', t, 'FFD9') END)"""
    df = geo_orders(spark, sf_dir).selectExpr("*", f"concat({tiff}) AS t")
    return df.selectExpr("k", "'image/JPEG; q=1' AS mime", f"unhex({jpeg}) AS content")


@query(f"""WITH {GEO_SQL} SELECT k,
  round(CAST((CASE WHEN k % 2 = 0 THEN 1 ELSE -1 END) * (k % 90 + (k % 60) / 60.0 + (k % 600) / 10.0 / 3600.0) AS DOUBLE), 6) AS lat,
  round(CAST((CASE WHEN k % 3 = 0 THEN 1 ELSE -1 END) * (k % 180 + (k % 59) / 60.0 + (k % 599) / 10.0 / 3600.0) AS DOUBLE), 6) AS lon,
  'exif_gps' AS source, '2024-05-06 07:08:09' AS taken_at, 'LE' AS byte_order FROM geo WHERE k % 5 <> 0""")
def photo_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions and capture times read from JPEG bytes."""
    geo = geo_of(_photos(spark, sf_dir)).where("geo is not null")
    return geo.select(
        "k", F.round("geo.lat", 6).alias("lat"), F.round("geo.lon", 6).alias("lon"), "geo.source",
        F.date_format("geo.datetime", "yyyy-MM-dd HH:mm:ss").alias("taken_at"),
        F.try_element_at("geo.raw", F.lit("byte_order")).alias("byte_order"),
    )


@query(f"""WITH {GEO_SQL} SELECT k, lat, lon, 'quicktime_location' AS source FROM geo
WHERE k % 4 <> 0 AND k % 6 <> 5""")
def video_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions read from video bytes; other types and videos without a location give nothing."""
    sign = "CASE WHEN {m} < 0 THEN '' ELSE '+' END"
    text = f"concat({sign.format(m='lat_m')}, lat_s, {sign.format(m='lon_m')}, lon_s, '+012.5/')"
    videos = geo_orders(spark, sf_dir).selectExpr(
        "k",
        "CASE WHEN k % 4 = 0 THEN 'text/plain' WHEN k % 4 = 1 THEN 'video/mp4' ELSE 'video/QuickTime' END AS mime",
        f"""concat(X'00FF8166', CASE WHEN k % 6 = 5 THEN encode('no location', 'UTF-8') ELSE
            encode(concat('com.apple.quicktime.location.ISO', CASE WHEN k % 2 = 0 THEN '6709' ELSE '' END, {text}, 'tail'), 'UTF-8') END) AS content""",
    )
    geo = geo_of(videos).where("geo is not null")
    return geo.select("k", "geo.lat", "geo.lon", "geo.source")
