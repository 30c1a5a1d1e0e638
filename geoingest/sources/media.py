"""Geotagged media files: positions and capture times from bytes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoingest.functions.coords import latlon
from geoingest.functions.media import (
    JPEG_MIMES,
    VIDEO_MIMES,
    base_mime,
    exif_datetime,
    quicktime_gps,
)
from geoingest.sources.exif import TEXT_FIELDS, exif_batches

MEDIA_GEO = (
    "struct<lat:double,lon:double,source:string,datetime:timestamp,"
    "datetime_raw:string,raw:map<string,string>>"
)
_EXIF_TYPE = T.StructType(
    [T.StructField("lat", T.DoubleType()), T.StructField("lon", T.DoubleType())]
    + [T.StructField(n, T.StringType()) for n in TEXT_FIELDS]
)

#: Files by name whose content is read, and the size up to which it is.
_READ_GLOB = "*.{[jJ][pP][gG],[jJ][pP][eE][gG],[mM][pP]4,[mM][oO][vV],[qQ][tT]}"
MAX_MEDIA_BYTES = 1 << 30


def read_media(
    spark: SparkSession, paths: str | list[str], mime: str | None = None, max_bytes: int = MAX_MEDIA_BYTES
) -> DataFrame:
    """Files below ``paths`` with a mime type (given, or by file extension), their position and ``error``.

    Content is read of photos and videos up to ``max_bytes`` only, which bounds a task's memory; a larger
    file keeps its row and says so in ``error``, any other file keeps its row without a position.
    """
    files = spark.read.format("binaryFile")
    by_name = (
        F.when(F.col("path").rlike(r"(?i)\.jpe?g$"), "image/jpeg")
        .when(F.col("path").rlike(r"(?i)\.mp4$"), "video/mp4")
        .when(F.col("path").rlike(r"(?i)\.(mov|qt)$"), "video/quicktime")
    )
    kind = F.lit(mime) if mime else by_name
    fits = F.col("length") <= max_bytes
    wanted = files.option("pathGlobFilter", _READ_GLOB) if mime is None else files
    read = media_geo(wanted.load(paths).where(fits).select("path", "content").withColumn("mime", kind))
    read = read.withColumn("error", F.lit(None).cast("string"))
    # Without the content column only the listing is read.
    listed = spark.read.format("binaryFile").load(paths).select("path", "length").withColumn("mime", kind)
    rest = listed.where(F.col("mime").isNull() | ~fits).select(
        "path", "mime", F.lit(None).cast(MEDIA_GEO).alias("geo"),
        F.when(F.col("mime").isNotNull(), F.concat(F.lit("larger than "), F.lit(max_bytes), F.lit(" bytes"))).alias("error"),
    )
    return read.select("path", "mime", "geo", "error").unionByName(rest)


def media_geo(media: DataFrame, *, content: str = "content", mime: str = "mime") -> DataFrame:
    """Add ``geo``: the position a photo or video carries, null without one.

    Only the bytes of photos go to the Python workers; videos are read by an expression. The content
    column is not carried on.
    """
    kind = base_mime(F.col(mime))
    rest = [c for c in media.columns if c != content]
    routed = media.select(
        *rest,
        quicktime_gps(F.when(kind.isin(*VIDEO_MIMES), F.col(content))).alias("_video"),
        F.when(kind.isin(*JPEG_MIMES), F.col(content)).alias("_jpeg"),
    )
    kept = [f for f in routed.schema if f.name != "_jpeg"]
    parsed = routed.mapInArrow(
        exif_batches, T.StructType([*kept, T.StructField("_exif", _EXIF_TYPE)])
    )
    e = F.col("_exif")
    photo = F.when(
        e.isNotNull(),
        F.struct(
            e["lat"].alias("lat"),
            e["lon"].alias("lon"),
            F.lit("exif_gps").alias("source"),
            exif_datetime(e["datetime_raw"]).alias("datetime"),
            e["datetime_raw"].alias("datetime_raw"),
            F.create_map(
                *[x for n in TEXT_FIELDS[1:] for x in (F.lit(n), e[n])]
            ).alias("raw"),
        ),
    ).cast(MEDIA_GEO)
    return parsed.select(*rest, F.coalesce(F.col("_video").cast(MEDIA_GEO), photo).alias("geo"))


def media_points(media: DataFrame) -> DataFrame:
    """Rows with a position, as ``geom``."""
    return media.where("geo is not null").withColumn("geom", latlon(F.col("geo.lat"), F.col("geo.lon")))
