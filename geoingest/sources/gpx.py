"""GPX documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geoingest.functions.coords import first_point, latlon
from geoingest.functions.expr import compute_once, json_string, non_empty
from geoingest.sources.html import body_text
from geoingest.sources.record import to_raw_records

GPX_SCHEMA = (
    "metadata struct<name:string,desc:string>, name string, desc string, "
    "wpt array<struct<_lat:double,_lon:double,name:string,type:string>>, "
    "trk array<struct<trkseg:array<struct<trkpt:array<struct<_lat:double,_lon:double>>>>>>, "
    "_corrupt string"
)
# A prefix bound to a namespace is dropped from element names, the XML reader matches local names only.
_PREFIX = r"(</?)[A-Za-z_][\w.\-]*:(?=[A-Za-z_])"
_COMMENT = r"(?s)<!--.*?-->"
_FIRST_TAG = r"<([A-Za-z_][\w.\-]*)"


def read_gpx(
    spark: SparkSession, paths: str | list[str], *, keep_failed: bool = False, **options
) -> DataFrame:
    """Records of GPX files below ``paths``; ``_pos`` is assigned at the scan."""
    files = (
        spark.read.format("binaryFile")
        .load(paths)
        .select(F.col("path").alias("locator"), "content")
        .withColumn("_pos", F.monotonically_increasing_id())
    )
    return gpx_records(files, locator="locator", body="content", keep_failed=keep_failed, **options)


def gpx_records(
    documents: DataFrame,
    *,
    locator: str = "url",
    body: str = "body",
    waypoint_fallback: bool = False,
    keep_failed: bool = False,
) -> DataFrame:
    """One record per well-formed GPX document, with its track points and waypoints in order.

    The first track point is the hint; ``waypoint_fallback`` takes the first waypoint without one.
    """
    xml = F.regexp_replace(body_text(documents, body), _PREFIX, "$1")
    is_gpx = F.regexp_extract(F.regexp_replace(xml, _COMMENT, ""), _FIRST_TAG, 1) == "gpx"
    df = compute_once(
        documents,
        "_g",
        F.when(
            is_gpx,
            F.from_xml(xml, GPX_SCHEMA, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}),
        ),
    )
    g = F.col("_g")
    segments = F.flatten(
        F.transform(F.filter(g["trk"], lambda t: t["trkseg"].isNotNull()), lambda t: t["trkseg"])
    )
    track = F.flatten(
        F.transform(F.filter(segments, lambda s: s["trkpt"].isNotNull()), lambda s: s["trkpt"])
    )
    df = compute_once(
        df,
        "_track",
        F.coalesce(
            F.transform(track, lambda p: latlon(p["_lat"], p["_lon"])),
            F.array().cast("array<struct<lat:double,lon:double>>"),
        ),
    )
    waypoints = F.coalesce(
        F.transform(
            g["wpt"],
            lambda w: F.struct(
                w["_lat"].alias("lat"),
                w["_lon"].alias("lon"),
                F.coalesce(w["name"], F.lit("")).alias("name"),
                F.coalesce(w["type"], F.lit("")).alias("type"),
            ),
        ),
        F.array().cast("array<struct<lat:double,lon:double,name:string,type:string>>"),
    )
    points = F.col("_track")
    name = F.coalesce(g["metadata"]["name"], g["name"])
    hint = first_point(points)
    if waypoint_fallback:
        hint = F.coalesce(hint, F.get(F.transform(waypoints, lambda w: latlon(w["lat"], w["lon"])), F.lit(0)))
    # A point without usable attributes makes the whole document unusable.
    broken = F.exists(points, lambda p: p["lat"].isNull() | p["lon"].isNull()) | F.exists(
        waypoints, lambda w: w["lat"].isNull() | w["lon"].isNull()
    )
    return to_raw_records(
        df,
        source="gpx",
        source_id=F.coalesce(non_empty(name), F.col(locator)),
        raw=json_string(
            F.struct(
                name.alias("name"),
                F.coalesce(g["metadata"]["desc"], g["desc"]).alias("description"),
                F.transform(points, lambda p: F.array(p["lat"], p["lon"])).alias("track_points"),
                waypoints.alias("waypoints"),
            )
        ),
        raw_ref=F.col(locator),
        locator=F.col(locator),
        ok=g.isNotNull() & g["_corrupt"].isNull() & ~broken,
        coord_hint=hint,
        keep_failed=keep_failed,
    )


def gpx_track_points(records: DataFrame) -> DataFrame:
    """One row per track point, in document order."""
    pts = F.from_json(F.get_json_object("raw", "$.track_points"), "array<array<double>>")
    rows = records.select("source", "source_id", "_pos", F.posexplode(pts).alias("point_pos", "_p"))
    return rows.select(
        "source", "source_id", "_pos", "point_pos",
        F.get("_p", F.lit(0)).alias("lat"), F.get("_p", F.lit(1)).alias("lon"),
    )


def gpx_waypoints(records: DataFrame, *extra: Column) -> DataFrame:
    """One row per waypoint, in document order, with further columns of its record."""
    kind = "array<struct<lat:double,lon:double,name:string,type:string>>"
    pts = F.from_json(F.get_json_object("raw", "$.waypoints"), kind)
    rows = records.select("source", "source_id", "_pos", F.struct(F.lit(0), *extra).alias("_x"), F.posexplode(pts).alias("point_pos", "_w"))
    names = [f.name for f in rows.schema["_x"].dataType.fields[1:]]
    return rows.select("source", "source_id", "_pos", "point_pos", "_w.*", *[F.col("_x").getField(n).alias(n) for n in names])
