"""Routed tracks: response geometry, quality class, stamping on attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from geoingest.functions.coords import linestring_points
from geoingest.functions.expr import let
from geoingest.functions.jsonmerge import json_merge

TRACK_SOURCE = "brouter"


def track_quality(npts: Column) -> Column:
    return (
        F.when(npts <= 0, "unknown")
        .when(npts == 2, "placeholder")
        .when(npts <= 10, "sparse")
        .when(npts.isNotNull(), "real")
    )


def route_coordinates(body: Column, status: Column) -> Column:
    """Points of the first feature when the response is a usable line, else null."""

    def line(v: Column) -> Column:
        kind = F.try_variant_get(v, "$.features[0].geometry.type", "string")
        items = F.try_variant_get(v, "$.features[0].geometry.coordinates", "array<variant>")
        return F.when(kind == "LineString", linestring_points(items))

    return F.when(status < 400, let(F.try_parse_json(body), line))


def stamp_track(attrs: Column, points: Column) -> Column:
    """Attributes with the track added when it has at least two points."""
    n = F.size(points)
    stamp = F.to_json(
        F.struct(
            F.transform(points, lambda p: F.array(p["lat"], p["lon"])).alias("track"),
            n.alias("track_npts"),
            track_quality(n).alias("track_quality"),
            F.lit(TRACK_SOURCE).alias("track_source"),
        )
    )
    return F.when(points.isNotNull() & (n >= 2), json_merge(attrs, stamp)).otherwise(attrs)
