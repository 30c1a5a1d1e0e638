"""Coordinate expressions: validity, DMS, pairs in free text, OSM elements, GeoJSON."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from geoingest.functions.expr import let, non_empty, to_float

LATLON_TYPE = "struct<lat:double,lon:double>"

# The two text patterns decide which strings count as coordinates.
DECIMAL_PAIR = r"(?U)(-?\d{1,3}[.,]\d{3,7})[,\s]+(-?\d{1,3}[.,]\d{3,7})"
DMS_PAIR = (
    r"(?U)(\d{1,3})[°\s]+(\d{1,2})['′\s]+([\d.,]+)?[\"″\s]*([NSns])[,\s]+"
    r"(\d{1,3})[°\s]+(\d{1,2})['′\s]+([\d.,]+)?[\"″\s]*([EWew])"
)
MAX_PAIRS = 2


def latlon(lat: Column, lon: Column) -> Column:
    return F.struct(lat.cast("double").alias("lat"), lon.cast("double").alias("lon"))


def no_latlon() -> Column:
    return F.lit(None).cast(LATLON_TYPE)


def valid_latlon(lat: Column, lon: Column) -> Column:
    """True when both are numbers in range; NaN and nulls are out of range."""
    return F.coalesce(lat.between(-90.0, 90.0) & lon.between(-180.0, 180.0), F.lit(False))


def latlon_if_valid(lat: Column, lon: Column) -> Column:
    return let(latlon(lat, lon), lambda p: F.when(valid_latlon(p["lat"], p["lon"]), p))


def dms_to_decimal(d: Column, m: Column, s: Column, hemi: Column) -> Column:
    """Degrees, minutes, optional seconds and a hemisphere letter as signed decimal degrees."""
    seconds = F.when(F.coalesce(s, F.lit("")) == "", F.lit(0.0)).otherwise(
        to_float(F.replace(s, F.lit(","), F.lit(".")))
    )
    value = to_float(d) + to_float(m) / 60.0 + seconds / 3600.0
    return F.when(F.upper(hemi).isin("S", "W"), -value).otherwise(value)


def dedupe_consecutive(points: Column) -> Column:
    """Drop an element equal to the one before it."""
    return let(
        points,
        lambda ps: F.filter(ps, lambda p, i: (i == 0) | (p != F.get(ps, i - 1))),
    )


def _dms_matches(text: Column) -> Column:
    def pair(m: Column) -> Column:
        g = lambda i: F.regexp_extract(m, DMS_PAIR, i)
        return latlon(
            dms_to_decimal(g(1), g(2), g(3), g(4)), dms_to_decimal(g(5), g(6), g(7), g(8))
        )

    found = F.transform(F.regexp_extract_all(text, F.lit(DMS_PAIR), F.lit(0)), pair)
    return F.filter(found, lambda p: p["lat"].isNotNull() & p["lon"].isNotNull())


def _decimal_matches(text: Column) -> Column:
    def pair(m: Column) -> Column:
        g = lambda i: to_float(
            F.replace(F.regexp_extract(m, DECIMAL_PAIR, i), F.lit(","), F.lit("."))
        )
        return latlon(g(1), g(2))

    found = F.transform(F.regexp_extract_all(text, F.lit(DECIMAL_PAIR), F.lit(0)), pair)
    return F.filter(found, lambda p: valid_latlon(p["lat"], p["lon"]))


def coord_pairs(text: Column) -> Column:
    """At most two (lat, lon) pairs in ``text``; decimal notation counts only without any DMS pair."""
    text = F.coalesce(text, F.lit(""))
    pairs = let(_dms_matches(text), lambda d: F.when(F.size(d) > 0, d).otherwise(_decimal_matches(text)))
    return F.slice(dedupe_consecutive(pairs), 1, MAX_PAIRS)


def first_point(points: Column) -> Column:
    return F.get(points, F.lit(0))


def osm_latlon(element: Column) -> Column:
    """(lat, lon) of an OSM element (VARIANT): a valid ``center`` first, else its own lat/lon."""
    num = lambda path: F.try_variant_get(element, path, "double")
    return F.coalesce(
        latlon_if_valid(num("$.center.lat"), num("$.center.lon")),
        latlon_if_valid(num("$.lat"), num("$.lon")),
    )


def linestring_points(items: Column) -> Column:
    """GeoJSON positions (``array<variant>``, lon first) as (lat, lon); unusable items are dropped."""
    pts = F.transform(
        items,
        lambda e: latlon_if_valid(
            F.try_variant_get(e, "$[1]", "double"), F.try_variant_get(e, "$[0]", "double")
        ),
    )
    return F.array_compact(pts)


def geojson_point(point: Column) -> Column:
    """GeoJSON point text, longitude first; null for a null point."""
    return F.when(
        point.isNotNull(),
        F.to_json(
            F.struct(
                F.lit("Point").alias("type"), F.array(point["lon"], point["lat"]).alias("coordinates")
            )
        ),
    )


def split_latlon(value: Column, *, lon_first: bool) -> Column:
    """A single ``a,b`` value as a valid point, else null."""

    def point(parts: Column) -> Column:
        a, b = to_float(F.get(parts, F.lit(0))), to_float(F.get(parts, F.lit(1)))
        return latlon_if_valid(b, a) if lon_first else latlon_if_valid(a, b)

    return let(F.split(value, ",", 2), point)
