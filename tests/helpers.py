from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def one(spark, value: str | None, *columns):
    """Evaluate expressions over one row with the text column ``x``."""
    row = spark.createDataFrame([(value,)], "x string").select(*columns).first()
    return row[0] if len(columns) == 1 else tuple(row)


def pairs(points) -> list[tuple[float, float]]:
    return [(p["lat"], p["lon"]) for p in points]


def at(text: str):
    return F.lit(text).cast("timestamp")


def rows(df: DataFrame) -> list[dict]:
    return [r.asDict(recursive=True) for r in df.collect()]
