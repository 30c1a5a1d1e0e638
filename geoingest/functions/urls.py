"""Map links to points, and request URLs for search, routing and OSM services."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from geoingest.functions.coords import LATLON_TYPE, latlon, latlon_if_valid, split_latlon
from geoingest.functions.expr import let, to_float

# Query keys that carry a Yandex point, in the order they are listed in the result.
YANDEX_KEYS = ("ll", "pt", "q")
GOOGLE_AT = r"@(-?\d+\.\d+),(-?\d+\.\d+),"
ROUTE_BASE_URL = "https://brouter.de/brouter"
ROUTE_PROFILE = "river"


def url_host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)", 1))


def url_query(url: Column) -> Column:
    return F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)


def query_param(query: Column, key: str) -> Column:
    """First non-blank value of ``key`` in a query string, decoded; null when absent."""

    def decoded(v: Column) -> Column:
        plain = F.translate(v, "+", " ")
        return (
            F.when(v == "", F.lit(None))
            .when(v.contains("%"), F.coalesce(F.try_url_decode(v), plain))
            .otherwise(plain)
        )

    return let(F.regexp_extract(query, rf"(?:^|&){key}=([^&]+)", 1), decoded)


def _points(*candidates: Column) -> Column:
    return F.array_compact(F.array(*candidates))


def yandex_coords(query: Column) -> Column:
    return _points(*[split_latlon(query_param(query, k), lon_first=True) for k in YANDEX_KEYS])


def google_coords(url: Column, query: Column) -> Column:
    at = let(
        F.split(F.regexp_extract(url, GOOGLE_AT, 0), "[@,]"),
        lambda v: latlon_if_valid(to_float(F.get(v, F.lit(1))), to_float(F.get(v, F.lit(2)))),
    )
    return _points(F.coalesce(split_latlon(query_param(query, "q"), lon_first=False), at))


def osm_coords(query: Column) -> Column:
    """Permalink marker; the range of its values is not checked."""
    marker = latlon(to_float(query_param(query, "mlat")), to_float(query_param(query, "mlon")))
    return F.filter(F.array(marker), lambda p: p["lat"].isNotNull() & p["lon"].isNotNull())


def brouter_coords(url: Column) -> Column:
    """All valid ``lon,lat`` pieces of ``lonlats`` in the fragment, or in the link without one."""
    fragment = F.when(F.instr(url, "#") > 0, F.regexp_extract(url, r"(?s)^[^#]*#(.*)$", 1)).otherwise(url)
    pieces = F.split(query_param(fragment, "lonlats"), ";")
    points = F.array_compact(F.transform(pieces, lambda p: split_latlon(p, lon_first=True)))
    return F.coalesce(points, F.array().cast(f"array<{LATLON_TYPE}>"))


def url_coords(url: Column) -> Column:
    """Points of a map link by its host; an unknown host gives an empty array."""

    def by_host(host: Column) -> Column:
        q = url_query(url)
        return (
            F.when(host.contains("yandex"), let(q, yandex_coords))
            .when(host.contains("google"), let(q, lambda v: google_coords(url, v)))
            .when(host.contains("openstreetmap") | host.contains("osm"), let(q, osm_coords))
            .when(host.contains("brouter"), brouter_coords(url))
            .otherwise(F.array().cast(f"array<{LATLON_TYPE}>"))
        )

    return let(url_host(url), by_host)


def build_search_url(
    base: str,
    query: Column,
    *,
    language: str = "ru",
    safesearch: int = 0,
    time_range: str | None = None,
    engines: list[str] | None = None,
) -> Column:
    """Search request; ``q`` is percent-encoded once."""
    parts = [
        F.lit(f"{base.rstrip('/')}?q="),
        F.url_encode(query),
        F.lit(f"&format=json&language={language}&safesearch={safesearch}"),
    ]
    if time_range:
        parts.append(F.lit(f"&time_range={time_range}"))
    if engines:
        parts += [F.lit("&engines="), F.url_encode(F.lit(",".join(engines)))]
    return F.concat(*parts)


def number_text(c: Column) -> Column:
    """Plain decimal text of a double, without an exponent for values near zero."""
    c = c.cast("double")
    plain = F.regexp_replace(c.cast("decimal(38,17)").cast("string"), r"(\.\d+?)0+$", "$1")
    return F.when((F.abs(c) < 1e-3) & (c != 0), plain).otherwise(c.cast("string"))


def build_route_url(
    start: Column,
    finish_lat: Column,
    finish_lon: Column,
    *,
    base: str = ROUTE_BASE_URL,
    profile: str = ROUTE_PROFILE,
) -> Column:
    """Route request between two points, longitudes first; null when a coordinate is missing.

    ``finish_*`` are texts as they stand in the payload, so ``50`` is not turned into ``50.0``.
    """
    ends = F.concat(
        number_text(start["lon"]), F.lit(","), number_text(start["lat"]), F.lit("|"),
        finish_lon, F.lit(","), finish_lat,
    )
    return F.concat(
        F.lit(f"{base}?lonlats="),
        F.url_encode(ends),
        F.lit(f"&profile={profile}&alternativeidx=0&format=geojson"),
    )


def build_osm_request(query: Column) -> Column:
    return F.concat(F.lit("data="), F.url_encode(query))
