"""GPX files of any size as rows: no document, track or segment is held as one value."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoingest.functions.coords import latlon
from geoingest.functions.expr import to_float
from geoingest.session import broadcast_if_small

# Element and columns of each landed table; attributes carry an underscore. Numbers come as text: the reader
# ends the whole job at one that is none.
_TABLES = {
    "documents": ("gpx", "metadata struct<name:string,desc:string>, name string, desc string"),
    "track_points": ("trkpt", "_lat string, _lon string"),
    "waypoints": ("wpt", "_lat string, _lon string, name string, type string"),
}
_NUMBERS = ("_lat", "_lon")
#: So many files, a path and a few numbers each, may be broadcast.
SMALL_FILES = 20_000
#: Files with more than one in this many of all rows are fewer than this.
HEAVY_PARTS = 4096


def land_gpx(spark: SparkSession, paths: str | list[str], into: str) -> None:
    """Read the files below ``paths`` as a stream of elements into Parquet tables below ``into``, which are replaced.

    A file is read by one task per table, element by element, so memory does not grow with its size. Elements
    keep their order: ``_row`` rises within a file and has no gaps there, as files are not split.
    """
    for name, (tag, schema) in _TABLES.items():
        elements = (
            spark.read.format("xml")
            .schema(schema)
            .options(rowTag=tag, ignoreNamespace=True, mode="DROPMALFORMED" if name == "documents" else "PERMISSIVE")
            .load(paths)
        )
        columns = [to_float(F.col(c)).alias(c) if c in _NUMBERS else F.col(c) for c in elements.columns]
        elements.select(
            F.col("_metadata.file_path").alias("path"), F.monotonically_increasing_id().alias("_row"), *columns
        ).write.mode("overwrite").parquet(f"{into}/{name}")


def _landed(spark: SparkSession, into: str, name: str) -> DataFrame:
    schema = f"path string, _row bigint, {_TABLES[name][1]}"
    for number in _NUMBERS:
        schema = schema.replace(f"{number} string", f"{number} double")
    return spark.read.schema(schema).parquet(f"{into}/{name}")


def _by_file(points: DataFrame, prefix: str) -> DataFrame:
    place = latlon(F.col("_lat"), F.col("_lon"))
    return points.groupBy("path").agg(
        F.count("*").alias(f"n_{prefix}"),
        F.min("_row").alias(f"first_{prefix}"),
        F.bool_or(F.col("_lat").isNull() | F.col("_lon").isNull()).alias(f"broken_{prefix}"),
        F.min_by(place, "_row").alias(f"hint_{prefix}"),
    )


def _usable(spark: SparkSession, into: str) -> DataFrame:
    one_root = (
        _landed(spark, into, "documents")
        .groupBy("path")
        .agg(
            F.count("*").alias("n"),
            F.max(F.coalesce("metadata.name", "name")).alias("name"),
            F.max(F.coalesce("metadata.desc", "desc")).alias("description"),
        )
        .where("n = 1")
    )
    found = one_root.join(_by_file(_landed(spark, into, "track_points"), "points"), "path", "left").join(
        _by_file(_landed(spark, into, "waypoints"), "waypoints"), "path", "left"
    )
    return found.where("NOT coalesce(broken_points, false) AND NOT coalesce(broken_waypoints, false)")


def landed_documents(spark: SparkSession, into: str) -> DataFrame:
    """One row per usable file: ``path, name, description, n_points, n_waypoints, coord_hint``, the first track point.

    A file is usable if it is well-formed, holds exactly one ``gpx`` element, and each of its track points and
    waypoints has two coordinates. Files that are not have no rows here nor in :func:`landed_points`.
    """
    return _usable(spark, into).select(
        "path", "name", "description",
        F.coalesce("n_points", F.lit(0)).alias("n_points"),
        F.coalesce("n_waypoints", F.lit(0)).alias("n_waypoints"),
        F.col("hint_points").alias("coord_hint"),
    )


def landed_points(spark: SparkSession, into: str, kind: str = "track_points") -> DataFrame:
    """Track points (``path, point_pos, lat, lon``) or ``waypoints`` (also ``name, type``, empty if absent) in document order."""
    prefix = "points" if kind == "track_points" else "waypoints"
    size, first = f"n_{prefix}", f"first_{prefix}"
    files = _usable(spark, into).where(f"{size} > 0").select("path", size, first)
    points = _landed(spark, into, kind)
    small = broadcast_if_small(files, SMALL_FILES)
    if small is not files:
        rows = points.join(small, "path")
    else:
        # Files that hold a good part of all points are few; their points stay where they are.
        total = files.agg(F.sum(size)).first()[0]
        heavy = F.col(size) > total / HEAVY_PARTS
        marks = F.broadcast(files.where(heavy))
        rows = points.join(marks, "path").unionByName(
            points.join(marks.select("path"), "path", "left_anti").join(files.where(~heavy), "path")
        )
    texts = [F.coalesce(c, F.lit("")).alias(c) for c in ("name", "type") if kind == "waypoints"]
    return rows.select(
        "path", (F.col("_row") - F.col(first)).cast("int").alias("point_pos"),
        F.col("_lat").alias("lat"), F.col("_lon").alias("lon"), *texts,
    )
