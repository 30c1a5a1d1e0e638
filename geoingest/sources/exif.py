"""Reading the EXIF segment of JPEG bytes, batch by batch inside a task."""

from __future__ import annotations

import struct
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle

# The executors get these functions by value, they need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

TEXT_FIELDS = ("datetime_raw", "lat_ref", "lon_ref", "byte_order")

# Fixed values of the EXIF format: tags, value types with their sizes, JPEG markers.
TAG_EXIF, TAG_GPS, TAG_TAKEN = 0x8769, 0x8825, 0x9003
GPS_LAT_REF, GPS_LAT, GPS_LON_REF, GPS_LON = 1, 2, 3, 4
ASCII, LONG, RATIONAL = 2, 4, 5
SIZES = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 7: 1, 9: 4, 10: 8, 11: 4, 12: 8}
APP1, EOI = 0xE1, 0xD9
NO_EXIF_AHEAD = {EOI, 0xC0, 0xC4, 0xDA}
SOUTH_WEST = {"S", "W"}


def _exif_block(jpeg: bytes) -> bytes | None:
    """TIFF bytes of the first EXIF segment, read segment by segment from the start of the file."""
    if jpeg[:2] != b"\xff\xd8":
        return None
    at = 2
    while at + 10 < len(jpeg) and jpeg[at] == 0xFF:
        marker = jpeg[at + 1]
        if marker in NO_EXIF_AHEAD:
            return None
        if marker < 0xC0:
            at += 2
            continue
        length = int.from_bytes(jpeg[at + 2 : at + 4], "big")
        if marker == APP1 and jpeg[at + 4 : at + 10] == b"Exif\0\0":
            return jpeg[at + 10 : at + 2 + length]
        if length < 2:
            return None
        at += 2 + length
    return None


def _directory(tiff: bytes, order: str, at: int) -> dict[int, tuple[int, int, bytes]]:
    """Tag to (type, count, value bytes) of the directory at ``at``; the first entry of a tag counts."""
    (n,) = struct.unpack_from(order + "H", tiff, at)
    found: dict[int, tuple[int, int, bytes]] = {}
    for entry in range(at + 2, at + 2 + 12 * n, 12):
        tag, kind, count = struct.unpack_from(order + "HHI", tiff, entry)
        size = SIZES.get(kind, 0) * count
        start = entry + 8 if size <= 4 else struct.unpack_from(order + "I", tiff, entry + 8)[0]
        found.setdefault(tag, (kind, count, tiff[start : start + size]))
    return found


def _pointer(entries: dict, tag: int, order: str) -> int | None:
    kind, _, value = entries.get(tag, (0, 0, b""))
    return struct.unpack(order + "I", value)[0] if kind == LONG and len(value) == 4 else None


def _degrees(entry: tuple | None, order: str) -> float | None:
    if entry is None or entry[:2] != (RATIONAL, 3):
        return None
    d0, d1, m0, m1, s0, s1 = struct.unpack(order + "6I", entry[2])
    return d0 / d1 + m0 / m1 / 60.0 + s0 / s1 / 3600.0


def _letter(entry: tuple | None, default: str) -> str:
    if entry is None or entry[0] != ASCII or entry[1] < 1:
        return default
    return entry[2][:1].decode("ascii", "replace")


def exif_position(jpeg: bytes | None) -> dict | None:
    """Position, hemispheres, byte order and capture text of a JPEG; null when absent or unreadable."""
    tiff = _exif_block(jpeg or b"")
    order = {b"II*\0": "<", b"MM\0*": ">"}.get((tiff or b"")[:4])
    if order is None:
        return None
    try:
        root = _directory(tiff, order, struct.unpack_from(order + "I", tiff, 4)[0])
        gps_at = _pointer(root, TAG_GPS, order)
        if gps_at is None:
            return None
        gps = _directory(tiff, order, gps_at)
        lat, lon = _degrees(gps.get(GPS_LAT), order), _degrees(gps.get(GPS_LON), order)
        if lat is None or lon is None:
            return None
    except (struct.error, ZeroDivisionError):
        return None
    lat_ref, lon_ref = _letter(gps.get(GPS_LAT_REF), "N"), _letter(gps.get(GPS_LON_REF), "E")
    return {
        "lat": -lat if lat_ref.upper() in SOUTH_WEST else lat,
        "lon": -lon if lon_ref.upper() in SOUTH_WEST else lon,
        "datetime_raw": _taken(tiff, order, _pointer(root, TAG_EXIF, order), gps_at),
        "lat_ref": lat_ref,
        "lon_ref": lon_ref,
        "byte_order": "LE" if order == "<" else "BE",
    }


def _taken(tiff: bytes, order: str, at: int | None, gps_at: int) -> str | None:
    """Capture text; it counts only when its directory lies behind the position directory."""
    (n_gps,) = struct.unpack_from(order + "H", tiff, gps_at)
    if not at or at < gps_at + 2 + 12 * n_gps:
        return None
    try:
        kind, count, value = _directory(tiff, order, at).get(TAG_TAKEN, (0, 0, b""))
    except struct.error:
        return None
    if kind != ASCII or count < 1:
        return None
    return value.rstrip(b"\0").decode("ascii", "replace")


def exif_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    fields = pa.struct(
        [("lat", pa.float64()), ("lon", pa.float64())] + [(n, pa.string()) for n in TEXT_FIELDS]
    )
    for batch in batches:
        found = [exif_position(v.as_py()) for v in batch.column("_jpeg")]
        kept = batch.drop_columns(["_jpeg"])
        yield pa.RecordBatch.from_arrays(
            [*kept.columns, pa.array(found, fields)], names=[*kept.schema.names, "_exif"]
        )
