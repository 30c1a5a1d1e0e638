"""Country classification by bounding boxes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoingest.functions.expr import let

# Fixed values: (country, min_lat, min_lon, max_lat, max_lon), tested in this order, borders included.
COUNTRY_BOXES = (
    ("BY", 51.0, 23.0, 56.5, 33.0),
    ("KZ", 40.0, 46.0, 56.0, 88.0),
    ("UA", 44.0, 22.0, 53.0, 41.0),
    ("RU", 41.0, 19.0, 82.0, 180.0),
)
UNKNOWN = "unknown"


def detect_country(lat: Column, lon: Column, boxes: Sequence[tuple] = COUNTRY_BOXES) -> Column:
    """First box that holds the point, else ``unknown``."""
    hits = [
        F.when(lat.between(lat0, lat1) & lon.between(lon0, lon1), F.lit(cc))
        for cc, lat0, lon0, lat1, lon1 in boxes
    ]
    return F.coalesce(*hits, F.lit(UNKNOWN))


def in_supported_region(lat: Column, lon: Column) -> Column:
    return detect_country(lat, lon) != UNKNOWN


def with_country(df: DataFrame) -> DataFrame:
    """Fill a missing ``bbox_country`` from ``geom``."""
    found = F.when(F.col("geom").isNotNull(), detect_country(F.col("geom.lat"), F.col("geom.lon")))
    return df.withColumn("bbox_country", F.coalesce(F.col("bbox_country"), found))


def country_join(
    points: DataFrame,
    boxes: DataFrame,
    *,
    cell_deg: float = 1.0,
    max_broadcast_cells: int = 200_000,
    salt: int = 32,
) -> DataFrame:
    """Classify ``points(lat, lon)`` with a user table ``boxes(cc, min_lat, min_lon, max_lat, max_lon, rank)``.

    The box of lowest rank that holds the point counts, of equal rank the smaller country, then the smaller
    bounds; each row is judged by its own point. Boxes are cut into grid cells, so this is an equi-join on
    the cell, never a nested loop. When the cells fit the checked bound they are broadcast with their
    boxes in order, and a point is classified without a shuffle. Beyond the bound each distinct point is
    classified once: the cells are replicated over ``salt`` values, the points of a crowded cell are spread
    over the same values, and the least box per point wins.
    """
    bounds = ["min_lat", "min_lon", "max_lat", "max_lon"]

    # What lies beyond the globe shares the cells at its edge, for boxes and points alike: a box makes a
    # bounded number of cells and still meets every point it holds.
    def cell(x: Column, limit: float) -> Column:
        return F.floor(F.least(F.greatest(x, F.lit(-limit)), F.lit(limit)) / cell_deg)

    def span(lo: str, hi: str, limit: float) -> Column:
        return F.sequence(cell(F.col(lo), limit), cell(F.col(hi), limit))

    whole = boxes.where((F.col("min_lat") <= F.col("max_lat")) & (F.col("min_lon") <= F.col("max_lon")))
    cells = whole.select("*", F.explode(span("min_lat", "max_lat", 90.0)).alias("_cy"))
    cells = cells.select("*", F.explode(span("min_lon", "max_lon", 180.0)).alias("_cx"))
    cy, cx = cell(F.col("lat"), 90.0).alias("_cy"), cell(F.col("lon"), 180.0).alias("_cx")
    if cells.limit(max_broadcast_cells + 1).count() <= max_broadcast_cells:
        per_cell = cells.groupBy("_cy", "_cx").agg(F.array_sort(F.collect_list(F.struct("rank", "cc", *bounds))).alias("_boxes"))
        hit = F.filter(
            F.col("_boxes"),
            lambda b: F.col("lat").between(b["min_lat"], b["max_lat"])
            & F.col("lon").between(b["min_lon"], b["max_lon"]),
        )
        return (
            points.select("*", cy, cx)
            .join(F.broadcast(per_cell), ["_cy", "_cx"], "left")
            .withColumn("country", F.coalesce(let(hit, lambda h: F.get(h, F.lit(0))["cc"]), F.lit(UNKNOWN)))
            .drop("_boxes", "_cy", "_cx")
        )
    salted_cells = cells.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
    asked = points.where("lat is not null and lon is not null").select("lat", "lon").distinct()
    salted = asked.select("*", cy, cx, F.pmod(F.xxhash64("lat", "lon"), F.lit(salt)).cast("int").alias("_salt"))
    inside = salted.join(salted_cells, ["_cy", "_cx", "_salt"]).where(
        F.col("lat").between(F.col("min_lat"), F.col("max_lat"))
        & F.col("lon").between(F.col("min_lon"), F.col("max_lon"))
    )
    first = inside.groupBy("lat", "lon").agg(F.min(F.struct("rank", "cc", *bounds))["cc"].alias("_cc"))
    return points.join(first, ["lat", "lon"], "left").select(*points.columns, F.coalesce("_cc", F.lit(UNKNOWN)).alias("country"))
