from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from geoingest.functions.coords import (
    coord_pairs,
    geojson_point,
    latlon,
    linestring_points,
    osm_latlon,
    valid_latlon,
)
from geoingest.functions.country import country_join, detect_country, in_supported_region
from geoingest.functions.tracks import track_quality
from geoingest.functions.urls import build_route_url, build_search_url, url_coords
from helpers import one, pairs, rows

X = F.col("x")


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("55.7558, 37.6173", [(55.7558, 37.6173)]),
        ("55,7558 37,6173", [(55.7558, 37.6173)]),
        ("at 55.755, 37.617 and 55.755, 37.617", [(55.755, 37.617)]),
        ("55.755,37.617; 55.755,37.617; 53.900,27.500; 1.000,2.000", [(55.755, 37.617), (53.9, 27.5)]),
        ("200.000, 37.6173", []),
        ("no coordinates", []),
        ("", []),
        (None, []),
        ("55.7558 37.6173", [(55.7558, 37.6173)]),
    ],
)
def test_decimal_pairs(spark, text, expected):
    assert pairs(one(spark, text, coord_pairs(X))) == expected


def test_dms_pairs_come_before_decimal_ones(spark):
    (pair,) = pairs(one(spark, "55°07'23.4\"N 37°39'15.6\"E or 10.500, 20.500", coord_pairs(X)))
    assert pair == pytest.approx((55 + 7 / 60 + 23.4 / 3600, 37 + 39 / 60 + 15.6 / 3600))
    (pair,) = pairs(one(spark, "5° 6' S 7° 8' w", coord_pairs(X)))
    assert pair == pytest.approx((-5.1, -(7 + 8 / 60)))


def test_dms_with_unreadable_seconds_drops_the_pair(spark):
    text = "55°07'1.2.3\"N 37°39'15.6\"E but 55.7558, 37.6173"
    assert pairs(one(spark, text, coord_pairs(X))) == [(55.7558, 37.6173)]


@pytest.mark.parametrize(
    ("url", "expected"),
    [
        ("https://yandex.ru/maps/?ll=37.6173,55.7558&z=12", [(55.7558, 37.6173)]),
        ("https://yandex.ru/maps/?pt=37.6%2C55.7&ll=30,50&q=word", [(50.0, 30.0), (55.7, 37.6)]),
        ("https://yandex.ru/maps/?ll=&ll=3,4", [(4.0, 3.0)]),
        ("https://yandex.ru/maps/?ll=200,95", []),
        ("https://maps.google.com/?q=55.7558,37.6173", [(55.7558, 37.6173)]),
        ("https://www.google.com/maps/@55.7558,37.6173,15z", [(55.7558, 37.6173)]),
        ("https://www.google.com/maps/@55,37,15z", []),
        ("https://www.google.com/maps/place/@1.5,2.5,9z?q=Kyiv", [(1.5, 2.5)]),
        ("https://www.openstreetmap.org/?mlat=55.7558&mlon=37.6173#map=12/1/2", [(55.7558, 37.6173)]),
        ("https://osm.org/?mlat=95&mlon=200", [(95.0, 200.0)]),
        ("https://osm.org/?mlat=95", []),
        ("https://brouter.de/brouter/#lonlats=27.5,53.9;27.6,53.8&profile=river", [(53.9, 27.5), (53.8, 27.6)]),
        ("https://brouter.de/brouter?x=1&lonlats=27.5,53.9;bad;1;500,1", [(53.9, 27.5)]),
        ("https://example.com/?q=1,2", []),
        ("HTTPS://MAPS.GOOGLE.COM/?q=+1.5,2.5", [(1.5, 2.5)]),
        ("maps.google.com/?q=1,2", []),
        ("https://maps.google.com/?q=0x1p3,2", []),
        ("", []),
        (None, []),
    ],
)
def test_map_links(spark, url, expected):
    assert pairs(one(spark, url, url_coords(X))) == expected


@pytest.mark.parametrize(
    ("lat", "lon", "country"),
    [
        (53.9, 27.5, "BY"), (52.0, 30.0, "BY"), (49.8, 24.0, "UA"), (50.0, 30.0, "UA"),
        (48.0, 60.0, "KZ"), (55.7, 37.6, "RU"), (0.0, 0.0, "unknown"), (56.5, 33.0, "BY"),
    ],
)
def test_country(spark, lat, lon, country):
    found = one(spark, "", detect_country(F.lit(lat), F.lit(lon)), in_supported_region(F.lit(lat), F.lit(lon)))
    assert found == (country, country != "unknown")


def test_country_join_matches_first_box_in_both_plans(spark):
    boxes = spark.createDataFrame(
        [("A", 0.0, 0.0, 10.0, 10.0, 2), ("B", 5.0, 5.0, 15.0, 15.5, 1), ("C", -90.0, -180.0, -80.0, 180.0, 0)],
        "cc string, min_lat double, min_lon double, max_lat double, max_lon double, rank int",
    )
    points = spark.range(4000).select(
        F.col("id").alias("k"),
        # A third of all points lie in one cell.
        F.expr("CASE WHEN id % 3 = 0 THEN 7.5 ELSE CAST(id % 37 - 18 AS DOUBLE) / 2 + id % 2 / 4 END").alias("lat"),
        F.expr("CASE WHEN id % 3 = 0 THEN 7.25 ELSE CAST(id % 41 - 20 AS DOUBLE) END").alias("lon"),
    )

    def brute(lat, lon):
        hits = [
            (b["rank"], b["cc"]) for b in boxes_local
            if b["min_lat"] <= lat <= b["max_lat"] and b["min_lon"] <= lon <= b["max_lon"]
        ]
        return min(hits)[1] if hits else "unknown"

    boxes_local = rows(boxes)
    expected = {p["k"]: brute(p["lat"], p["lon"]) for p in rows(points)}
    broadcast = country_join(points, boxes)
    shuffled = country_join(points, boxes, max_broadcast_cells=10, salt=4)
    for out in (broadcast, shuffled):
        assert {r["k"]: r["country"] for r in rows(out)} == expected
    for out in (broadcast, shuffled):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_country_join_has_one_rule_in_both_plans(spark):
    """Repeated and null keys, equal ranks, boxes past the date line: the bound changes the plan alone."""
    boxes = spark.createDataFrame(
        [("Z", 0.0, 0.0, 10.0, 10.0, 1), ("A", 0.0, 0.0, 5.0, 5.0, 1), ("E", 0.0, 170.0, 10.0, 190.0, 2), ("F", 0.0, 186.0, 9.0, 200.0, 1)],
        "cc string, min_lat double, min_lon double, max_lat double, max_lon double, rank int",
    )
    points = spark.createDataFrame(
        [(1, 2.0, 2.0), (1, 7.0, 7.0), (None, 7.0, 8.0), (2, 3.0, 185.0), (3, 3.0, 187.0), (4, None, 1.0), (5, 3.0, -175.0)],
        "k long, lat double, lon double",
    )
    expected = [(1, 2.0, "A"), (1, 7.0, "Z"), (2, 3.0, "E"), (3, 3.0, "F"), (4, None, "unknown"), (5, 3.0, "unknown"), (None, 7.0, "Z")]
    for bound in (200_000, 0):
        got = country_join(points, boxes, max_broadcast_cells=bound).select("k", "lat", "country").collect()
        assert sorted(map(tuple, got), key=repr) == sorted(expected, key=repr)


@pytest.mark.parametrize(
    ("element", "expected"),
    [
        ('{"center":{"lat":50.5,"lon":30.5},"lat":1,"lon":2}', (50.5, 30.5)),
        ('{"center":{"lat":50.5},"lat":1,"lon":2}', (1.0, 2.0)),
        ('{"center":{"lat":95,"lon":30.5},"lat":1,"lon":2}', (1.0, 2.0)),
        ('{"lat":"50.5","lon":"30.5"}', (50.5, 30.5)),
        ('{"lat":95,"lon":30.5}', None),
        ('{"center":"x"}', None),
        ("{}", None),
    ],
)
def test_osm_element_point(spark, element, expected):
    p = one(spark, element, osm_latlon(F.parse_json(X)))
    assert (p and (p["lat"], p["lon"])) == expected


def test_linestring_drops_unusable_items_in_order(spark):
    items = F.try_variant_get(F.parse_json(X), "$", "array<variant>")
    text = '[[30.5,50.5],[200,1],"x",[1],null,{"a":1},["30.6","50.6",7],[1,null]]'
    assert pairs(one(spark, text, linestring_points(items))) == [(50.5, 30.5), (50.6, 30.6)]
    assert one(spark, "[]", linestring_points(items)) == []


@pytest.mark.parametrize(
    ("n", "quality"),
    [(0, "unknown"), (-5, "unknown"), (1, "sparse"), (2, "placeholder"), (10, "sparse"), (11, "real"), (150, "real")],
)
def test_track_quality(spark, n, quality):
    assert one(spark, "", track_quality(F.lit(n))) == quality


def test_validity_and_geojson(spark):
    nan = float("nan")
    for lat, lon, ok in [(90.0, -180.0, True), (90.1, 0.0, False), (0.0, 180.1, False), (nan, 0.0, False)]:
        assert one(spark, "", valid_latlon(F.lit(lat), F.lit(lon))) is ok
    assert one(spark, "", valid_latlon(F.lit(None).cast("double"), F.lit(1.0))) is False
    assert one(spark, "", geojson_point(latlon(F.lit(50.0), F.lit(30.0)))) == '{"type":"Point","coordinates":[30.0,50.0]}'


def test_request_urls(spark):
    url = one(spark, "", build_route_url(latlon(F.lit(50.5), F.lit(30.5)), F.lit("50.6"), F.lit("30.6")))
    assert url == (
        "https://brouter.de/brouter?lonlats=30.5%2C50.5%7C30.6%2C50.6"
        "&profile=river&alternativeidx=0&format=geojson"
    )
    small = one(spark, "", build_route_url(latlon(F.lit(0.00001), F.lit(-0.0005)), F.lit("1"), F.lit("2")))
    assert "lonlats=-0.0005%2C0.00001%7C2%2C1&" in small
    url = one(spark, "a b&c", build_search_url("http://s/search/", X, time_range="day", engines=["x", "y"]))
    assert url == "http://s/search?q=a+b%26c&format=json&language=ru&safesearch=0&time_range=day&engines=x%2Cy"
