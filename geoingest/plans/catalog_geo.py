"""Registered queries: coordinates, links, countries, pages, payloads, responses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from geoingest.functions.coords import (
    coord_pairs as pairs_in,
    dms_to_decimal,
    geojson_point as point_json,
    latlon,
    linestring_points as line_points,
    valid_latlon as is_valid,
)
from geoingest.functions.country import country_join as join_country
from geoingest.functions.country import detect_country, in_supported_region, with_country
from geoingest.functions.html import html_text as text_of
from geoingest.functions.html import html_title as title_of
from geoingest.functions.jsonmerge import json_merge as merge_json
from geoingest.functions.text import clip, error_text as stage_error, retry_wait_s, stable_id as digest_id
from geoingest.functions.urls import build_osm_request, build_search_url, query_param
from geoingest.operators.normalize import normalize, split_skipped, to_entity
from geoingest.operators.runlog import record_preview as preview
from geoingest.plans.derived import COUNTRY_SQL, FETCH_SQL, GEO_SQL, fetch_log, geo_orders
from geoingest.plans.registry import ORACLE, query, table
from geoingest.session import spread
from geoingest.sources.gpx import gpx_records, gpx_track_points as track_rows, gpx_waypoints as waypoint_rows
from geoingest.sources.html import html_records as page_records
from geoingest.sources.html_tree import html_nodes
from geoingest.sources.json_api import json_records
from geoingest.sources.locators import inline_locators
from geoingest.sources.map_urls import url_records
from geoingest.sources.osm import osm_elements as element_rows
from geoingest.sources.osm import osm_records
from geoingest.sources.osm import osm_response_elements as response_elements
from geoingest.sources.record import union_sources as stack
from geoingest.sources.search import search_records, search_results


def _r6(c: Column | str) -> Column:
    return F.round(c, 6)


def _links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geo_orders(spark, sf_dir).select(F.col("url").alias("value"), F.col("k").alias("_pos"))


_POINTS = f"""WITH {GEO_SQL}, pts AS (
  SELECT k, 0 AS point_pos, lat, lon FROM geo WHERE (k % 6 IN (0, 1, 2, 5) AND ok) OR k % 6 = 3
  UNION ALL
  SELECT k, CASE WHEN ok THEN 1 ELSE 0 END, lat2, lon2 FROM geo WHERE k % 6 = 5
)"""


@query(f"{_POINTS} SELECT k, CAST(point_pos AS INT) AS point_pos, lat, lon FROM pts")
def url_dispatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points of every map link, by provider."""
    records = url_records(_links(spark, sf_dir))
    points = F.from_json(F.get_json_object("raw", "$.points"), "array<array<double>>")
    return records.select(F.col("_pos").alias("k"), F.posexplode(points).alias("point_pos", "p")).select(
        "k", "point_pos", F.get("p", F.lit(0)).alias("lat"), F.get("p", F.lit(1)).alias("lon")
    )


@query(f"""{_POINTS} SELECT k, 'url' AS source, url AS source_id, pts.lat AS hint_lat, pts.lon AS hint_lon
FROM pts JOIN geo USING (k) WHERE point_pos = 0""")
def url_hint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record per usable link, its first point as the hint."""
    return url_records(_links(spark, sf_dir)).select(
        F.col("_pos").alias("k"), "source", "source_id",
        F.col("coord_hint.lat").alias("hint_lat"), F.col("coord_hint.lon").alias("hint_lon"),
    )


@query(f"""{_POINTS} SELECT geo.k, geo.url AS value, 'adapter_returned_none' AS error FROM geo
WHERE geo.k NOT IN (SELECT k FROM pts)""")
def skipped_locators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links that gave no record."""
    links = _links(spark, sf_dir)
    return split_skipped(links, url_records(links)).select(F.col("_pos").alias("k"), "value", "error")


@query(f"""WITH {GEO_SQL} SELECT k,
  CASE WHEN k % 6 = 0 THEN concat(lon_s, ',', lat_s) WHEN k % 6 IN (1, 4) THEN concat(lat_s, ',', lon_s) END AS point_text
FROM geo""")
def link_parameter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoded query parameter of all links; null where the point is not in one."""
    q = F.regexp_extract("url", r"\?(.*)", 1)
    found = F.coalesce(query_param(q, "ll"), query_param(q, "q"))
    return geo_orders(spark, sf_dir).select("k", found.alias("point_text"))


_DMS = """SELECT k, abs(lat_m) // 1000 % 90 AS a, k % 60 AS am, k % 50 AS asec,
  abs(lon_m) // 1000 % 180 AS o, k % 47 AS om, k % 53 AS osec,
  CASE WHEN lat_m < 0 THEN -1 ELSE 1 END AS sa, CASE WHEN lon_m < 0 THEN -1 ELSE 1 END AS so FROM geo"""


@query(f"""WITH {GEO_SQL}, dms AS ({_DMS}), out AS (
  SELECT k, 0 AS pair_pos, lat AS lat, lon AS lon FROM geo WHERE k % 4 = 0 AND ok
  UNION ALL
  SELECT k, 0, sa * (a + am / 60.0 + (asec + 0.5) / 3600.0), so * (o + om / 60.0) FROM dms WHERE k % 4 = 1
  UNION ALL
  SELECT k, 0, lat, lon FROM geo WHERE k % 4 = 2 AND ok
  UNION ALL
  SELECT k, CASE WHEN ok THEN 1 ELSE 0 END, lat2, lon2 FROM geo WHERE k % 4 = 2 AND NOT (ok AND lat = lat2 AND lon = lon2)
) SELECT k, CAST(pair_pos AS INT) AS pair_pos, round(CAST(lat AS DOUBLE), 6) AS lat, round(CAST(lon AS DOUBLE), 6) AS lon FROM out""")
def coord_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coordinates in free text: decimal, DMS, repeated pairs, out of range."""
    text = F.expr(
        """CASE k % 4
        WHEN 0 THEN concat('at ', lat_s, ', ', lon_s, ' here')
        WHEN 1 THEN concat('pos ', abs(lat_m) div 1000 % 90, '°', k % 60, '\\'', k % 50, '.5"',
             CASE WHEN lat_m < 0 THEN 'S' ELSE 'N' END, ' ',
             abs(lon_m) div 1000 % 180, '° ', k % 47, '\\' ', CASE WHEN lon_m < 0 THEN 'w' ELSE 'E' END,
             ' and 10.500, 20.500')
        WHEN 2 THEN concat(lat_s, ' ', lon_s, ' / ', lat_s, ', ', lon_s, ' / ', lat2_s, ',', lon2_s)
        ELSE concat('2', lpad(CAST(k % 100 AS STRING), 2, '0'), '.500, 37.6173') END"""
    )
    found = geo_orders(spark, sf_dir).select("k", F.posexplode(pairs_in(text)).alias("pair_pos", "p"))
    return found.select("k", "pair_pos", _r6("p.lat").alias("lat"), _r6("p.lon").alias("lon"))


@query(f"""WITH {GEO_SQL}, dms AS ({_DMS})
SELECT k, round(CAST(sa * (a + am / 60.0 + asec / 3600.0) AS DOUBLE), 6) AS decimal_lat FROM dms""")
def dms_decimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Degrees, minutes, seconds and hemisphere to decimal degrees."""
    t = lambda e: F.expr(e).cast("string")
    value = dms_to_decimal(
        t("abs(lat_m) div 1000 % 90"), t("k % 60"), t("k % 50"),
        F.expr("CASE WHEN lat_m < 0 THEN 's' ELSE 'N' END"),
    )
    return geo_orders(spark, sf_dir).select("k", _r6(value).alias("decimal_lat"))


@query(f"WITH {GEO_SQL} SELECT k, ok AS is_valid FROM geo")
def valid_latlon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geo_orders(spark, sf_dir).select("k", is_valid(F.col("lat"), F.col("lon")).alias("is_valid"))


@query(f"""WITH {GEO_SQL}, c AS (SELECT {COUNTRY_SQL} AS country, lat FROM geo WHERE ok)
SELECT country, CAST(count(*) AS BIGINT) AS n, round(sum(lat), 3) AS sum_lat FROM c GROUP BY country""")
def country_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid points per country."""
    valid = geo_orders(spark, sf_dir).where(is_valid(F.col("lat"), F.col("lon")))
    return (
        valid.groupBy(detect_country(F.col("lat"), F.col("lon")).alias("country"))
        .agg(F.count("*").alias("n"), F.round(F.sum("lat"), 3).alias("sum_lat"))
    )


@query(f"WITH {GEO_SQL}, c AS (SELECT k, lat, lon, {COUNTRY_SQL} AS country FROM geo) SELECT k, lat, lon FROM c WHERE country <> 'unknown'")
def supported_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = geo_orders(spark, sf_dir)
    return df.where(in_supported_region(F.col("lat"), F.col("lon"))).select("k", "lat", "lon")


# One box per nation, in rank order; boxes overlap.
_BOX = """concat('N', CAST(n_nationkey AS STRING)) AS cc, CAST(n_nationkey AS INT) AS rank,
  CAST(n_nationkey * 5 - 60 AS DOUBLE) AS min_lat, CAST(n_nationkey * 11 - 150 AS DOUBLE) AS min_lon,
  CAST(n_nationkey * 5 - 60 AS DOUBLE) + 20.5 AS max_lat, CAST(n_nationkey * 11 - 150 AS DOUBLE) + 45.25 AS max_lon"""


@query(f"""WITH {GEO_SQL}, box AS (SELECT {_BOX} FROM nation),
hit AS (SELECT k, arg_min(cc, rank) AS cc FROM geo JOIN box
  ON lat BETWEEN min_lat AND max_lat AND lon BETWEEN min_lon AND max_lon WHERE ok GROUP BY k)
SELECT geo.k, coalesce(cc, 'unknown') AS country FROM geo LEFT JOIN hit USING (k) WHERE ok""")
def country_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points classified with a box table by a grid-cell join."""
    points = geo_orders(spark, sf_dir).where(is_valid(F.col("lat"), F.col("lon"))).select("k", "lat", "lon")
    boxes = spark.sql(f"SELECT {_BOX} FROM {{nation}}", nation=table(spark, sf_dir, "nation"))
    return join_country(points, boxes).select("k", "country")


@query("SELECT page_id, trim(replace(replace(regexp_extract(html, '<title>([^<]*)</title>', 1), '&quot;', '\"'), '&amp;', '&')) AS title FROM pages")
def html_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "pages")).select("page_id", title_of(F.col("html")).alias("title"))


_PAGE_TEXT = """bare AS (
  SELECT page_id, url, regexp_replace(regexp_replace(regexp_replace(html, '<!--.*?-->', chr(1), 'gs'),
    '<(?:script|style)[^>]*>.*?</(?:script|style)>', chr(1), 'gs'), '<[^>]*>', chr(1), 'gs') AS t FROM pages
), plain AS (
  SELECT page_id, url, list_filter(list_transform(string_split(t, chr(1)), lambda x:
    trim(replace(replace(replace(replace(x, '&copy;', '©'), '&middot;', '·'), '&quot;', '"'), '&amp;', '&'),
         concat(' ', chr(9), chr(10), chr(13)))), lambda x: x <> '') AS nodes FROM bare
), txt AS (SELECT page_id, url, nodes, array_to_string(nodes, chr(10)) AS body_text FROM plain)"""


@query(f"""WITH {_PAGE_TEXT} SELECT page_id, CAST(len(string_split(body_text, chr(10))) AS INT) AS n_lines,
  CAST(length(body_text) AS INT) AS n_chars, md5(body_text) AS digest FROM txt""")
def html_text_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visible text of every page."""
    text = spread(table(spark, sf_dir, "pages")).select("page_id", text_of(F.col("html")).alias("t"))
    return text.select(
        "page_id",
        F.size(F.split("t", "\n")).alias("n_lines"),
        F.length("t").alias("n_chars"),
        F.md5("t").alias("digest"),
    )


@query(f"""WITH {_PAGE_TEXT} SELECT url AS source_id, 'html' AS source, url AS raw_ref,
  md5(substr(body_text, 1, 50000)) AS text_digest,
  CAST(octet_length(encode(html)) AS INT) AS raw_size, substr(body_text, 1, 200) AS text_preview
FROM txt JOIN pages USING (page_id, url)""")
def record_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page records as a reader previews them."""
    pages = spread(table(spark, sf_dir, "pages")).withColumnRenamed("html", "body")
    shown = preview(page_records(pages).withColumn("text_digest", F.md5("text")), "text_digest")
    return shown.select("source", "source_id", "raw_ref", "raw_size", "text_preview", "text_digest")


# Behind the first heading's start tag, before the end of the article, or behind the page where it has none.
_BROKEN = "CAST(CASE WHEN page_id % 2 = 0 AND instr(html, '<h1>') > 0 THEN instr(html, '<h1>') + 3 WHEN instr(html, '</article>') > 0 THEN instr(html, '</article>') - 1 ELSE length(html) END AS INT)"


@query(f"""WITH whole AS (SELECT * FROM pages), changed AS (
  SELECT page_id, url, CASE WHEN page_id % 3 = 1 AND regexp_full_match(html, '(?s)[\\x00-\\x{{FF}}]*')
      THEN replace(html, 'charset="utf-8"', 'charset="iso-8859-1"')
    ELSE substr(html, 1, {_BROKEN}) || chr(65533) || substr(html, {_BROKEN} + 1) END AS html FROM whole),
{_PAGE_TEXT.replace("FROM pages", "FROM changed")}
SELECT page_id, md5(substr(body_text, 1, 50000)) AS text_digest, md5(html) AS body_digest FROM txt JOIN changed USING (page_id, url)""")
def html_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole pages as bytes: one byte that is no UTF-8 at a place of its own, or another encoding, which the page declares."""
    pages = spread(table(spark, sf_dir, "pages").where("html IS NOT NULL"))
    latin = "page_id % 3 = 1 AND html RLIKE '^[\\\\x00-\\\\xFF]*$'"
    broken = f"encode(substr(html, 1, {_BROKEN}), 'UTF-8') || X'FF' || encode(substr(html, {_BROKEN} + 1), 'UTF-8')"
    declared = "encode(replace(html, 'charset=\"utf-8\"', 'charset=\"iso-8859-1\"'), 'ISO-8859-1')"
    bytes_ = pages.selectExpr("page_id AS _pos", "url", f"CASE WHEN {latin} THEN {declared} ELSE {broken} END AS body")
    return page_records(bytes_).select(
        F.col("_pos").alias("page_id"), F.md5("text").alias("text_digest"), F.md5(F.get_json_object("raw", "$.body")).alias("body_digest")
    )


# The given pages leave paragraphs and bold text open; the twin follows these two by hand and nests the rest by counting tags.
@query("""WITH bare AS (
  SELECT page_id, regexp_replace(regexp_replace(html, '<!--.*?-->', '', 'gs'), '<(?:script|style)[^>]*>.*?</(?:script|style)>', '', 'gs') AS t FROM pages
), cut AS (SELECT page_id, regexp_extract_all(t, '<[^>]*>|[^<]+') AS tokens FROM bare),
told AS (SELECT page_id, generate_subscripts(tokens, 1) AS i, unnest(tokens) AS token FROM cut),
named AS (SELECT page_id, i, token, CASE WHEN token[1] = '<' THEN lower(regexp_extract(token, '^</?([A-Za-z0-9]+)', 1)) ELSE '' END AS name,
  token[1:2] = '</' AS ends FROM told),
kinds AS (SELECT *, CASE WHEN token[1] <> '<' THEN 'text' WHEN name IN ('', 'br', 'meta', 'link', 'img') THEN 'none'
  WHEN name IN ('p', 'b') THEN name WHEN ends THEN 'end' ELSE 'start' END AS kind FROM named),
nested AS (SELECT *, sum(CASE kind WHEN 'start' THEN 1 WHEN 'end' THEN -1 ELSE 0 END) OVER w AS base,
  count(CASE WHEN kind = 'b' THEN 1 END) OVER w AS bolds, coalesce(max(CASE WHEN kind = 'b' THEN i END) OVER w, 0) AS last_bold,
  coalesce(max(CASE WHEN kind = 'p' AND NOT ends THEN i END) OVER w, 0) AS opened,
  coalesce(max(CASE WHEN kind IN ('start', 'end') OR (kind = 'p' AND ends) THEN i END) OVER w, 0) AS closed
  FROM kinds WINDOW w AS (PARTITION BY page_id ORDER BY i)),
held AS (SELECT *, last_value(CASE WHEN kind = 'start' THEN name END IGNORE NULLS) OVER (PARTITION BY page_id, base ORDER BY i) AS inner_tag FROM nested),
texts AS (SELECT page_id, i, base, least(bolds, 3) + CASE WHEN bolds > 3 AND last_bold > greatest(opened, closed) THEN 1 ELSE 0 END AS bold,
  opened > closed AS in_p, inner_tag, trim(replace(replace(replace(replace(token, '&copy;', '©'), '&middot;', '·'), '&quot;', '"'), '&amp;', '&'),
  concat(' ', chr(9), chr(10), chr(13))) AS body_text FROM held WHERE kind = 'text')
SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY i) AS INT) AS text_pos, CAST(base + bold + CAST(in_p AS INT) AS INT) AS depth,
  CASE WHEN bold > 0 THEN 'b' WHEN in_p THEN 'p' ELSE inner_tag END AS tag, md5(body_text) AS text_digest
FROM texts WHERE body_text <> ''""")
def html_tree_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of every page by the element that holds them, after more has been broken: a third of the pages loses the end tags
    of paragraphs and list items, another third gains end tags without elements and ends in a tag that is cut off."""
    broken = """CASE page_id % 3 WHEN 1 THEN regexp_replace(html, '</(p|li)>(?=\\\\s*<)', '')
        WHEN 2 THEN concat(replace(html, '</article>', '</em></td></section></article></h2>'), '<p class="cut') ELSE html END"""
    pages = spread(table(spark, sf_dir, "pages")).select("page_id", F.expr(broken).alias("body"))
    texts = html_nodes(pages, "page_id").where("text IS NOT NULL")
    # A page's texts are ranked where they lie: one page is one task's work anyway.
    rank = F.row_number().over(Window.partitionBy("page_id").orderBy("node_pos"))
    return texts.select("page_id", rank.alias("text_pos"), "depth", "tag", F.md5("text").alias("text_digest"))


@query("""SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS payload_k, 'api' AS source
FROM events WHERE event_id % 10 <> 0""")
def json_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON responses; every tenth body is cut short and gives no record."""
    landed = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("_pos"),
        F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("url"),
        F.expr("CASE WHEN event_id % 10 = 0 THEN substring(props, 1, 4) ELSE props END").alias("body"),
    )
    return json_records(landed).select(
        F.col("_pos").alias("event_id"),
        F.get_json_object("raw", "$.json.k").cast("bigint").alias("payload_k"),
        "source",
    )


@query("""WITH parts AS (SELECT CAST(o_orderkey AS BIGINT) AS k, o_custkey FROM orders)
SELECT k, 0 AS item, concat('https://a.example/?q=', CAST(k AS STRING), ',', CAST(o_custkey AS STRING)) AS locator FROM parts
UNION ALL SELECT k, 1, concat('http://b.example/', CAST(k AS STRING)) FROM parts WHERE k % 2 = 0""")
def locator_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inline locator lists; commas inside a link do not separate."""
    lists = table(spark, sf_dir, "orders").selectExpr(
        "CAST(o_orderkey AS BIGINT) AS k",
        "concat('https://a.example/?q=', o_orderkey, ',', o_custkey, "
        "CASE WHEN o_orderkey % 2 = 0 THEN concat(',  http://b.example/', o_orderkey) ELSE '' END) AS value",
    )
    return inline_locators(lists).select("k", F.col("_item").alias("item"), F.col("value").alias("locator"))


@query(f"""{_POINTS}, used AS (SELECT k, url, pts.lat, pts.lon FROM pts JOIN geo USING (k) WHERE point_pos = 0)
SELECT k, 'raw' AS entity_type, 'url' AS source, url AS source_id,
  lat AS g_lat, lon AS g_lon, CAST(1 AS DOUBLE) AS confidence, {COUNTRY_SQL} AS bbox_country FROM used""")
def default_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records to entities by the default projection, with the country filled in."""
    return with_country(to_entity(url_records(_links(spark, sf_dir)))).select(
        F.col("_pos").alias("k"), "entity_type", "source", "source_id",
        F.col("geom.lat").alias("g_lat"), F.col("geom.lon").alias("g_lon"), "confidence", "bbox_country",
    )


@query(f"""{_POINTS}, named AS (SELECT k, {COUNTRY_SQL} AS country, lat FROM pts WHERE point_pos = 0)
SELECT k, CASE WHEN country <> 'unknown' AND lat <= 80 THEN country END AS entity_type,
  CASE WHEN lat > 80 THEN 'failed' WHEN country = 'unknown' THEN 'skipped' END AS outcome,
  CASE WHEN lat > 80 THEN 'normalize: ValueError: too far north'
       WHEN country = 'unknown' THEN 'normalizer_returned_none' END AS error FROM named""")
def normalize_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user normalizer that yields, skips or fails."""

    def by_country(raw: DataFrame) -> DataFrame:
        lat, lon = F.col("coord_hint.lat"), F.col("coord_hint.lon")
        far, cc = lat > 80, detect_country(lat, lon)
        return to_entity(raw).withColumn(
            "entity_type", F.when(~far & (cc != "unknown"), cc)
        ).withColumn("_problem", F.when(far, F.lit("too far north")))

    out = normalize(url_records(_links(spark, sf_dir)), by_country)
    return out.select(
        F.col("_pos").alias("k"), "entity_type", F.col("_outcome").alias("outcome"), F.col("_error").alias("error")
    )


@query(f"""WITH {GEO_SQL} SELECT k,
  CASE WHEN k % 5 <> 0 THEN lon END AS x, CASE WHEN k % 5 <> 0 THEN lat END AS y, k % 5 <> 0 AS has_point FROM geo""")
def geojson_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored geometry: GeoJSON with the longitude first."""
    g = point_json(F.when(F.col("k") % 5 != 0, latlon(F.col("lat"), F.col("lon"))))
    df = geo_orders(spark, sf_dir).select("k", g.alias("g"))
    at = lambda i: F.get_json_object("g", f"$.coordinates[{i}]").cast("double")
    return df.select("k", at(0).alias("x"), at(1).alias("y"), F.col("g").isNotNull().alias("has_point"))


@query(f"""WITH {GEO_SQL} SELECT k, 'priority' AS ak, concat('"', o_orderpriority, '"') AS av FROM geo
UNION ALL SELECT k, 'status', CASE WHEN k % 2 = 0 THEN 'null' ELSE concat('"', o_orderstatus, '"') END FROM geo
UNION ALL SELECT k, 'n', CAST(k AS STRING) FROM geo""")
def json_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shallow merge where the new value wins, an explicit null too."""
    merged = merge_json(
        F.expr("concat('{\"status\":\"', o_orderstatus, '\",\"n\":', k, '}')"),
        F.expr("concat('{\"priority\":\"', o_orderpriority, '\"', CASE WHEN k % 2 = 0 THEN ',\"status\":null' ELSE '' END, '}')"),
    )
    entries = geo_orders(spark, sf_dir).select(
        "k", F.explode(F.parse_json(merged).cast("map<string,variant>")).alias("ak", "v")
    )
    return entries.select("k", "ak", F.to_json("v").alias("av"))


@query("""SELECT doc_id, substr(text, 1, 200) AS title, md5(substr(text, 1, 2000)) AS detail,
  md5(substr(text, 1, 50000)) AS body, substr(text, 1, 120) AS query_id FROM documents""")
def truncation_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("text")
    return table(spark, sf_dir, "documents").select(
        "doc_id", clip(t, 200).alias("title"), F.md5(clip(t, 2000)).alias("detail"),
        F.md5(clip(t, 50000)).alias("body"), clip(t, 120).alias("query_id"),
    )


@query("""SELECT page_id, concat('searxng:0x', sha256(url)) AS source_id FROM pages""")
def stable_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "pages")).select("page_id", digest_id(F.col("url")).alias("source_id"))


@query("""SELECT event_id, concat('fetch: HTTPError: ', event_type, ' #', CAST(event_id AS STRING)) AS error FROM events""")
def error_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    message = F.concat("event_type", F.lit(" #"), F.col("event_id").cast("string"))
    return table(spark, sf_dir, "events").select(
        "event_id", stage_error("fetch", F.lit("HTTPError"), message).alias("error")
    )


@query(f"""WITH {FETCH_SQL} SELECT event_id, attempt, round(2.0 * pow(1.5, attempt - 1), 6) AS wait_s FROM fetchlog""")
def retry_waits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fetch_log(spark, sf_dir).select("event_id", "attempt", _r6(retry_wait_s(F.col("attempt"))).alias("wait_s"))


@query("""SELECT CAST(o_orderkey AS BIGINT) AS k,
  concat('http://localhost:8080/search?q=', replace(o_orderpriority, ' ', '+'), '%26', CAST(o_orderkey AS STRING),
    '&format=json&language=ru&safesearch=0&time_range=day&engines=bing%2Cduckduckgo') AS search_url,
  concat('data=node%28', CAST(o_orderkey AS STRING), '%29%3Bout+center%3B') AS osm_body FROM orders""")
def request_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search requests and OSM request bodies."""
    k = F.col("o_orderkey").cast("string")
    search = build_search_url(
        "http://localhost:8080/search/", F.concat("o_orderpriority", F.lit("&"), k),
        time_range="day", engines=["bing", "duckduckgo"],
    )
    osm = build_osm_request(F.concat(F.lit("node("), k, F.lit(");out center;")))
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("bigint").alias("k"), search.alias("search_url"), osm.alias("osm_body")
    )


@query(f"""WITH {GEO_SQL}, items AS (SELECT k, unnest(range(0, k % 15)) AS i FROM geo),
pts AS (SELECT k, i, CAST((k * 131 + i * 3700) % 190000 - 95000 AS DOUBLE) / 1000 AS lat, CAST(i AS DOUBLE) / 4 AS lon FROM items)
SELECT k, CAST(row_number() OVER (PARTITION BY k ORDER BY i) - 1 AS INT) AS point_pos, lat, lon
FROM pts WHERE abs(lat) <= 90""")
def linestring_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GeoJSON positions, longitude first, with unusable items between them."""
    items = F.expr(
        """concat('[', array_join(concat(
             transform(filter(sequence(0, CAST(k % 15 AS INT)), i -> i < k % 15), i -> concat('[', i / 4, ',',
                CAST((k * 131 + i * 3700) % 190000 - 95000 AS DOUBLE) / 1000, ']')),
             array('"x"', '[7]', 'null', '{"a":1}')), ','), ']')"""
    )
    variants = F.try_variant_get(F.try_parse_json(items), "$", "array<variant>")
    rows = geo_orders(spark, sf_dir).select("k", F.posexplode(line_points(variants)).alias("point_pos", "p"))
    return rows.select("k", "point_pos", "p.lat", "p.lon")


def _osm_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geo_orders(spark, sf_dir).selectExpr(
        "k AS _pos",
        "concat('[out:json];node(', k, ');out center;') AS query",
        "CASE WHEN k % 9 = 0 THEN 429 ELSE 200 END AS status",
        """CASE WHEN k % 9 = 1 THEN '{"elements":[' WHEN k % 9 = 2 THEN '{"elements":[]}'
           ELSE concat('{"elements":[{"type":"way","id":', k, ',"center":{"lat":', lat, ',"lon":', lon,
                '},"lat":', lat2, ',"lon":', lon2, ',"tags":{"name":"', o_orderpriority, '"}},',
                '{"type":"node","id":', k + 1, ',"lat":"', lat2, '","lon":', lon2, '},{"type":"relation","id":', k + 2, '}]}')
           END AS body""",
    )


_OSM_POINT = "CASE WHEN ok THEN lat ELSE lat2 END AS lat, CASE WHEN ok THEN lon ELSE lon2 END AS lon"


@query(f"""WITH {GEO_SQL} SELECT k, concat('overpass:0x', sha256(concat('[out:json];node(', CAST(k AS STRING), ');out center;'))) AS source_id,
  CASE WHEN k % 9 = 2 THEN NULL ELSE 3 END AS n_elements,
  CASE WHEN k % 9 = 2 THEN NULL WHEN ok THEN lat ELSE lat2 END AS hint_lat,
  CASE WHEN k % 9 = 2 THEN NULL WHEN ok THEN lon ELSE lon2 END AS hint_lon
FROM geo WHERE k % 9 NOT IN (0, 1)""")
def osm_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OSM responses: refused and broken ones give nothing, empty ones an envelope without a hint."""
    return osm_records(_osm_responses(spark, sf_dir)).select(
        F.col("_pos").alias("k"), "source_id",
        F.get_json_object("raw", "$.n_elements").cast("int").alias("n_elements"),
        F.col("coord_hint.lat").alias("hint_lat"), F.col("coord_hint.lon").alias("hint_lon"),
    )


@query(f"""WITH {GEO_SQL}, used AS (SELECT * FROM geo WHERE k % 9 NOT IN (0, 1, 2))
SELECT k, 0 AS element_pos, 'way' AS osm_type, k AS osm_id, {_OSM_POINT}, o_orderpriority AS tag_name FROM used
UNION ALL SELECT k, 1, 'node', k + 1, lat2, lon2, NULL FROM used
UNION ALL SELECT k, 2, 'relation', k + 2, NULL, NULL, NULL FROM used""")
def osm_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Elements of the envelopes with their canonical point."""
    return _shown_elements(element_rows(osm_records(_osm_responses(spark, sf_dir))))


@query(ORACLE["osm_elements"])
def osm_response_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same straight from the responses, parsed once."""
    return _shown_elements(response_elements(_osm_responses(spark, sf_dir)))


def _shown_elements(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.col("_pos").alias("k"), "element_pos", "osm_type", "osm_id",
        F.col("geom.lat").alias("lat"), F.col("geom.lon").alias("lon"),
        F.try_element_at("tags", F.lit("name")).alias("tag_name"),
    )


def _search_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geo_orders(spark, sf_dir).selectExpr(
        "k AS _pos",
        "concat('fuel ', k) AS query",
        "CASE WHEN k % 11 = 0 THEN 429 ELSE 200 END AS status",
        """CASE WHEN k % 11 = 1 THEN '<html>' WHEN k % 11 = 2 THEN '{"results":null}' ELSE
           concat('{"number_of_results":', k, ',"results":[', array_join(transform(sequence(1, CAST(k % 7 AS INT) + 1),
             i -> concat('{"url":"https://r.example/', k, '/', i, '","title":"t', i, '","content":"',
                CASE WHEN i = 1 AND k % 2 = 0 THEN '' ELSE concat('c', k, '-', i) END, '","score":', i / 2, '}')), ','), ']}') END AS body""",
    )


@query(f"""WITH {GEO_SQL}, used AS (SELECT k, unnest(range(1, least(k % 7 + 1, 5) + 1)) AS i FROM geo WHERE k % 11 NOT IN (0, 1, 2))
SELECT k, CAST(i - 1 AS INT) AS result_pos, concat('https://r.example/', CAST(k AS STRING), '/', CAST(i AS STRING)) AS url,
  concat('t', CAST(i AS STRING)) AS title, CAST(i AS DOUBLE) / 2 AS score FROM used""")
def search_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First five results of every answered search, in response order."""
    rows = search_results(search_records(_search_responses(spark, sf_dir), max_results=5))
    return rows.select(F.col("_pos").alias("k"), "result_pos", "url", "title", "score")


@query(f"""WITH {GEO_SQL} SELECT k, CASE WHEN k % 11 = 2 THEN 0 ELSE CAST(least(k % 7 + 1, 5) AS INT) END AS n_results,
  CASE WHEN k % 11 = 2 THEN NULL ELSE k END AS number_of_results,
  CASE WHEN k % 11 = 2 OR k % 2 = 0 THEN NULL ELSE concat('c', CAST(k AS STRING), '-1') END AS text
FROM geo WHERE k % 11 NOT IN (0, 1)""")
def search_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search responses as envelopes; the text is the first content that is not empty."""
    return search_records(_search_responses(spark, sf_dir), max_results=5).select(
        F.col("_pos").alias("k"),
        F.get_json_object("raw", "$.n_results").cast("int").alias("n_results"),
        F.get_json_object("raw", "$.number_of_results").cast("bigint").alias("number_of_results"),
        "text",
    )


def _gpx_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geo_orders(spark, sf_dir).selectExpr(
        "k AS _pos",
        "concat('track/', k, '.gpx') AS url",
        """encode(CASE WHEN k % 8 = 0 THEN '<gpx><trk>' ELSE concat(
            '<?xml version="1.0"?><gpx version="1.1" xmlns="http://www.topografix.com/GPX/1/1">',
            CASE WHEN k % 3 = 0 THEN '' ELSE concat('<metadata><name>G', k, '</name></metadata>') END,
            '<wpt lat="', lat2_s, '" lon="', lon2_s, '"><name>w', k, '</name></wpt>',
            '<trk><trkseg><trkpt lat="', lat_s, '" lon="', lon_s, '"/><trkpt lat="', lat2_s, '" lon="', lon2_s, '"/></trkseg>',
            '<trkseg><trkpt lat="1.5" lon="2.5"><ele>7</ele></trkpt></trkseg></trk></gpx>') END, 'UTF-8') AS body""",
    )


_GPX_ID = "CASE WHEN k % 3 = 0 THEN concat('track/', CAST(k AS STRING), '.gpx') ELSE concat('G', CAST(k AS STRING)) END AS source_id"


@query(f"""WITH {GEO_SQL}, used AS (SELECT *, {_GPX_ID} FROM geo WHERE k % 8 <> 0)
SELECT source_id, 0 AS point_pos, lat, lon FROM used UNION ALL SELECT source_id, 1, lat2, lon2 FROM used
UNION ALL SELECT source_id, 2, 1.5, 2.5 FROM used""")
def gpx_track_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Track points of all segments in document order; truncated documents give nothing."""
    return track_rows(gpx_records(_gpx_documents(spark, sf_dir))).select("source_id", "point_pos", "lat", "lon")


@query(f"""WITH {GEO_SQL} SELECT {_GPX_ID}, lat2 AS lat, lon2 AS lon, concat('w', CAST(k AS STRING)) AS name, '' AS type,
  lat AS hint_lat FROM geo WHERE k % 8 <> 0""")
def gpx_waypoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = gpx_records(_gpx_documents(spark, sf_dir))
    rows = waypoint_rows(records, F.col("coord_hint.lat").alias("hint_lat"))
    return rows.select("source_id", "lat", "lon", "name", "type", "hint_lat")


# Numbers of a record's JSON are compared as numbers, everything else as it is.
@query(f"""{_POINTS}, {_PAGE_TEXT.replace('WITH ', '')},
links AS (SELECT k, geo.url, p.lat, p.lon FROM geo JOIN pts p USING (k) WHERE point_pos = 0),
ends AS (SELECT k, lat, lon FROM pts WHERE point_pos = 1)
SELECT 'url' AS source, l.url AS source_id, l.url AS raw_ref, l.lat AS hint_lat, l.lon AS hint_lon, NULL AS text_digest,
  l.url AS media_url, k AS _pos, '2024-02-01' AS fetched_at,
  concat(l.url, '|', CAST(l.lat AS STRING), '|', CAST(l.lon AS STRING), coalesce('|' || CAST(e.lat AS STRING) || '|' || CAST(e.lon AS STRING), '')) AS raw_told
FROM links l LEFT JOIN ends e USING (k)
UNION ALL SELECT 'html', url, url, NULL, NULL, md5(substr(body_text, 1, 50000)), NULL, page_id, '2024-01-01', md5(html)
FROM txt JOIN pages USING (page_id, url)
UNION ALL SELECT 'api', concat('e', CAST(event_id AS STRING)), concat('e', CAST(event_id AS STRING)), NULL, NULL, NULL, NULL, event_id,
  strftime(ts, '%Y-%m-%d'), json_extract_string(props, '$.k') FROM events""")
def union_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of three sources stacked, all their columns: raw JSON by what it holds, texts by digest."""
    links = _links(spark, sf_dir).withColumn("media_url", F.col("value")).withColumn("fetched_at", F.lit("2024-02-01"))
    pages = spread(table(spark, sf_dir, "pages")).select(
        F.col("page_id").alias("_pos"), "url", F.col("html").alias("body"), F.lit("2024-01-01").alias("fetched_at")
    )
    landed = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("_pos"), F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("url"),
        F.col("props").alias("body"), F.col("ts").alias("fetched_at"),
    )
    points = F.flatten(F.from_json(F.get_json_object("raw", "$.points"), "array<array<double>>"))
    told = (
        F.when(F.col("source") == "url", F.concat_ws("|", F.get_json_object("raw", "$.url"), points.cast("array<string>")))
        .when(F.col("source") == "html", F.md5(F.get_json_object("raw", "$.body")))
        .otherwise(F.get_json_object("raw", "$.json.k"))
    )
    return stack(url_records(links), page_records(pages), json_records(landed)).select(
        "source", "source_id", "raw_ref", F.col("coord_hint.lat").alias("hint_lat"), F.col("coord_hint.lon").alias("hint_lon"),
        F.md5("text").alias("text_digest"), "media_url", "_pos", F.date_format("fetched_at", "yyyy-MM-dd").alias("fetched_at"),
        told.alias("raw_told"),
    )
