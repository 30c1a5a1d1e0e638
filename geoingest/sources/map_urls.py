"""Map links as records; the link itself is the data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoingest.functions.coords import first_point
from geoingest.functions.expr import compute_once, json_string
from geoingest.functions.urls import url_coords
from geoingest.sources.record import to_raw_records


def url_records(locators: DataFrame, *, column: str = "value", keep_failed: bool = False) -> DataFrame:
    """One record per link that names at least one point; the first point is the coordinate hint."""
    df = compute_once(locators, "_points", url_coords(F.col(column)))
    points, link = F.col("_points"), F.col(column)
    return to_raw_records(
        df,
        source="url",
        source_id=link,
        raw=json_string(
            F.struct(
                link.alias("url"),
                F.transform(points, lambda p: F.array(p["lat"], p["lon"])).alias("points"),
            )
        ),
        raw_ref=link,
        locator=link,
        ok=F.size(points) > 0,
        coord_hint=first_point(points),
        keep_failed=keep_failed,
    )
