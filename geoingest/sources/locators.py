"""Locator lists: what a run should read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoingest.functions.text import split_locators


def read_locators(spark: SparkSession, path: str) -> DataFrame:
    """One locator per non-blank line; ``_pos`` is assigned at the scan and grows with the line."""
    lines = spark.read.text(path).select(F.regexp_replace("value", r"(?U)^\s+|\s+$", "").alias("value"))
    return lines.withColumn("_pos", F.monotonically_increasing_id()).where("value <> ''")


def inline_locators(df: DataFrame, column: str = "value") -> DataFrame:
    """Rows holding inline lists as one locator per row, in order; the rest of the row is repeated."""
    rest = [c for c in df.columns if c != column]
    return df.select(*rest, F.posexplode(split_locators(F.col(column))).alias("_item", column))
