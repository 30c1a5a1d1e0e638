from __future__ import annotations

import struct
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from geoingest import media_geo, read_media
from geoingest.functions.media import exif_datetime, geo_confidence, iso6709
from geoingest.sources.exif import exif_position
from helpers import one, rows

X = F.col("x")


def jpeg(order="<", lat=((50, 1), (27, 1), (0, 1)), lon=((30, 1), (0, 1), (0, 1)), refs=(b"N", b"E"),
         taken=b"2026:07:27 12:00:00\0", exif_first=False, skip=(), before=b"") -> bytes:
    """A JPEG whose EXIF block is assembled from directories laid out one after another."""
    def directory(entries):
        return struct.pack(order + "H", len(entries)) + b"".join(entries) + b"\0" * 4

    def entry(tag, kind, count, value):
        return struct.pack(order + "HHI", tag, kind, count) + value.ljust(4, b"\0")

    u32 = lambda n: struct.pack(order + "I", n)
    root_len, exif_len = 2 + 24 + 4, 2 + 12 + 4
    gps_len = 2 + 12 * (4 - len(skip)) + 4
    first, second = 8 + root_len, 8 + root_len + (exif_len if exif_first else gps_len)
    exif_at, gps_at = (first, second) if exif_first else (second, first)
    data = 8 + root_len + exif_len + gps_len
    gps = [
        (1, entry(1, 2, 2, refs[0] + b"\0")), (2, entry(2, 5, 3, u32(data))),
        (3, entry(3, 2, 2, refs[1] + b"\0")), (4, entry(4, 5, 3, u32(data + 24))),
    ]
    gps_dir = directory([e for tag, e in gps if tag not in skip])
    exif_dir = directory([entry(0x9003, 2, len(taken), u32(data + 48))])
    tiff = (b"II*\0" if order == "<" else b"MM\0*") + u32(8)
    tiff += directory([entry(0x8825, 4, 1, u32(gps_at)), entry(0x8769, 4, 1, u32(exif_at))])
    tiff += exif_dir + gps_dir if exif_first else gps_dir + exif_dir
    tiff += b"".join(struct.pack(order + "II", *r) for r in (*lat, *lon)) + taken
    body = b"Exif\0\0" + tiff
    return b"\xff\xd8" + before + b"\xff\xe1" + struct.pack(">H", len(body) + 2) + body + b"\xff\xd9"


@pytest.mark.parametrize("order", ["<", ">"])
def test_photo_position(order):
    got = exif_position(jpeg(order))
    assert (got["lat"], got["lon"]) == pytest.approx((50.45, 30.0))
    assert got["byte_order"] == ("LE" if order == "<" else "BE")
    assert got["datetime_raw"] == "2026:07:27 12:00:00"


def test_photo_hemispheres_and_missing_parts():
    got = exif_position(jpeg(refs=(b"S", b"W")))
    assert (got["lat"], got["lon"]) == pytest.approx((-50.45, -30.0))
    got = exif_position(jpeg(skip=(1, 3)))
    assert (got["lat_ref"], got["lon_ref"]) == ("N", "E")
    assert exif_position(jpeg(skip=(2,))) is None
    assert exif_position(jpeg(lat=((1, 0), (1, 1), (1, 1)))) is None
    assert exif_position(jpeg(exif_first=True))["datetime_raw"] is None


def test_photo_segments():
    xmp = b"\xff\xe1\x00\x0ahttp://x"
    assert exif_position(jpeg(before=xmp)) is not None
    assert exif_position(jpeg(before=b"\xff\xe0\x00\x04ab")) is not None
    assert exif_position(jpeg(before=b"\xff\xda\x00\x04ab")) is None
    for data in (None, b"", b"\xff\xd8\xff\xd9", b"PNG", jpeg()[:40], jpeg()[:100], b"\xff\xd8" + b"\xff\xe1\x00\x00" * 9):
        assert exif_position(data) is None


def test_media_frame(spark):
    video = b"\0\0moov\xffcom.apple.quicktime.location.ISO6709\0\x12+49.2345-028.4567+150.2/\0"
    df = spark.createDataFrame(
        [
            (1, "image/jpeg", jpeg()), (2, "IMAGE/JPG; q=1", jpeg(taken=b"bad date\0")), (3, "video/mp4", video),
            (4, "video/quicktime", b"nothing"), (5, "text/plain", jpeg()), (6, "image/jpeg", b""), (7, None, jpeg()),
            (8, "video/mov", b"com.apple.quicktime.location.ISO+1.5+2.5/"),
            (9, "video/mp4", b"com.apple.quicktime.location.ISO" + b"x" * 70 + b"+1.5+2.5/"),
        ],
        "k int, mime string, content binary",
    )
    got = {r["k"]: r["geo"] for r in rows(media_geo(df))}
    assert got[1]["lat"] == pytest.approx(50.45) and got[1]["source"] == "exif_gps"
    assert got[1]["datetime"] == datetime(2026, 7, 27, 12) and got[1]["raw"]["lat_ref"] == "N"
    assert got[2]["datetime"] is None and got[2]["datetime_raw"] == "bad date"
    assert (got[3]["lat"], got[3]["lon"], got[3]["source"]) == (49.2345, -28.4567, "quicktime_location")
    assert (got[8]["lat"], got[8]["lon"]) == (1.5, 2.5)
    assert [k for k, g in got.items() if g is None] == [4, 5, 6, 7, 9]


def test_media_files(spark, tmp_path):
    (tmp_path / "a.JPG").write_bytes(jpeg())
    (tmp_path / "b.mov").write_bytes(b"com.apple.quicktime.location.ISO6709+1.5-2.5/")
    (tmp_path / "c.txt").write_bytes(jpeg())
    got = {r["path"][-5:]: r["geo"] for r in rows(read_media(spark, str(tmp_path)))}
    assert got["a.JPG"]["lat"] == pytest.approx(50.45) and got["b.mov"]["lon"] == -2.5 and got["c.txt"] is None
    small = {r["path"][-5:]: (r["geo"], r["error"]) for r in rows(read_media(spark, str(tmp_path), max_bytes=60))}
    assert small["a.JPG"] == (None, "larger than 60 bytes") and small["b.mov"][0]["lat"] == 1.5 and small["c.txt"] == (None, None)


@pytest.mark.parametrize(
    ("text", "point"),
    [
        ("+49.2345-028.4567/", (49.2345, -28.4567)), ("-33.8688+151.2093/", (-33.8688, 151.2093)),
        ("+49.2345+028.4567+150.0/", (49.2345, 28.4567)), ("+49.2+28.4-3CRSx/", (49.2, 28.4)),
        ("49.2345+028.4567/", None), ("+49.2345", None), ("+4.9.2+1/", None), ("", None), (None, None),
    ],
)
def test_iso6709(spark, text, point):
    p = one(spark, text, iso6709(X))
    assert (p and (p["lat"], p["lon"])) == point


def test_exif_datetime(spark):
    for text, ok in [("2026:07:27 12:00:00\0", True), (" 2026:07:27 12:00:00+03", True), ("2026:07:27", False),
                     ("2026:13:27 12:00:00", False), ("2026-07-27 12:00:00", False), (None, False)]:
        assert one(spark, text, exif_datetime(X)) == (datetime(2026, 7, 27, 12) if ok else None)


@pytest.mark.parametrize(
    ("geo", "taken", "posted", "expected"),
    [
        (True, "2026-07-27 12:00:00", "2026-07-27 12:00:00", 0.9), (True, "2026-07-27 12:00:00", "2026-07-27 18:00:00", 0.9),
        (True, "2026-07-27 12:00:00", "2026-07-26 12:00:00", 0.9), (True, "2026-07-27 12:00:01", "2026-07-26 12:00:00", 0.5),
        (True, "2020-07-27 12:00:00", "2026-07-27 12:00:00", 0.5), (True, None, "2026-07-27 12:00:00", 0.5),
        (True, "2026-07-27 12:00:00", None, 0.5), (False, None, None, 0.0), (None, None, None, 0.0),
    ],
)
def test_confidence(spark, geo, taken, posted, expected):
    ts = lambda t: F.lit(t).cast("timestamp")
    assert one(spark, "", geo_confidence(F.lit(geo).cast("boolean"), ts(taken), ts(posted))) == expected
