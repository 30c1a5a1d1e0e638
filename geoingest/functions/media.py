"""Media metadata expressions that need no byte parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from geoingest.functions.coords import latlon
from geoingest.functions.expr import let, non_empty, to_float

# The key that precedes the location text, and how far its end may lie.
QUICKTIME_KEY = "com.apple.quicktime.location.ISO"
QUICKTIME_WINDOW = 64
_ISO6709 = r"^([+-][0-9.]*[0-9])([+-](?:[0-9.]*[0-9](?=[+-])|[0-9.]+$))"

JPEG_MIMES = ("image/jpeg", "image/jpg")
VIDEO_MIMES = ("video/mp4", "video/quicktime", "video/mov")


def base_mime(mime: Column) -> Column:
    return F.trim(F.substring_index(F.lower(mime), ";", 1))


def exif_datetime(text: Column) -> Column:
    """``YYYY:MM:DD HH:MM:SS`` as a timestamp of the session zone (keep it at UTC); bad text is null."""
    s = F.trim(F.btrim(text, F.lit("\u0000 ")))
    return F.when(F.length(s) >= 19, F.try_to_timestamp(F.left(s, F.lit(19)), F.lit("yyyy:MM:dd HH:mm:ss")))


def iso6709(text: Column) -> Column:
    """Signed latitude and longitude at the start of ``text``; altitude ignored, range not checked."""
    s = F.trim(F.rtrim(text, F.lit("/")))
    lat, lon = (to_float(F.regexp_extract(s, _ISO6709, i)) for i in (1, 2))
    return let(latlon(lat, lon), lambda p: F.when(p["lat"].isNotNull() & p["lon"].isNotNull(), p))


def quicktime_location(content: Column) -> Column:
    """Location text stored after the QuickTime key in a video's bytes, null without one."""
    chars = F.decode(content, "ISO-8859-1")
    tail = F.regexp_extract(
        chars, rf"(?s){QUICKTIME_KEY.replace('.', chr(92) + '.')}(.{{0,{QUICKTIME_WINDOW + 1}}})", 1
    )
    inside = F.regexp_extract(tail, rf"(?s)^([^/]{{0,{QUICKTIME_WINDOW}}})/", 1)
    return non_empty(F.regexp_replace(inside, r"(?s)^[^+-]*", ""))


def quicktime_gps(content: Column) -> Column:
    """Media geo struct of a video, null without a location."""
    return let(
        quicktime_location(content),
        lambda s: let(
            iso6709(s),
            lambda p: F.when(
                p.isNotNull(),
                F.struct(
                    p["lat"].alias("lat"),
                    p["lon"].alias("lon"),
                    F.lit("quicktime_location").alias("source"),
                    F.lit(None).cast("timestamp").alias("datetime"),
                    F.lit(None).cast("string").alias("datetime_raw"),
                    F.create_map(F.lit("iso6709"), s).alias("raw"),
                ),
            ),
        ),
    )


def geo_confidence(
    has_geo: Column, geo_dt: Column, posted_at: Column, threshold_hours: int = 24
) -> Column:
    """How far a media position can be trusted, by the age of the picture at posting time."""
    gap_us = F.abs(F.timestamp_diff("MICROSECOND", geo_dt, posted_at))
    return (
        F.when(~F.coalesce(has_geo, F.lit(False)), F.lit(0.0))
        .when(gap_us <= threshold_hours * 3_600_000_000, F.lit(0.9))
        .otherwise(F.lit(0.5))
    )
