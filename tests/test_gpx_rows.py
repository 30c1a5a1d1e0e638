from __future__ import annotations

import pytest

from geoingest import read_gpx
from geoingest.sources import gpx_rows
from geoingest.sources.gpx import gpx_track_points, gpx_waypoints
from geoingest.sources.gpx_rows import land_gpx, landed_documents, landed_points

FILES = {
    "whole": '<?xml version="1.0"?><!-- <trkpt lat="9" lon="9"/> --><gpx xmlns="http://www.topografix.com/GPX/1/1">'
    "<metadata><name>n &amp; m</name><desc>d</desc></metadata>"
    '<wpt lat="1" lon="2"><name>a</name><type>pier</type></wpt><wpt lat="3" lon="4"/>'
    '<trk><name>t</name><trkseg><trkpt lat="1.5" lon="2.5"><ele>3</ele></trkpt><trkpt lat="3" lon="4"/></trkseg>'
    '<trkseg><trkpt lat="5" lon="6"></trkpt></trkseg></trk><trk><trkseg/></trk></gpx>',
    "prefixed": "<g:gpx xmlns:g='u'><g:trk><g:trkseg><g:trkpt lat='7' lon='8'/></g:trkseg></g:trk></g:gpx>",
    "bare": "<gpx/>",
    "cut": '<gpx><name>c</name><trk><trkseg><trkpt lat="7" lon="8"/></trkseg><trkseg><trkpt lat="7" ',
    "unclosed": '<gpx><trk><trkseg><trkpt lat="7" lon="8"/></trkseg>',
    "no_lon": '<gpx><wpt lat="1" lon="1"/><trk><trkseg><trkpt lat="7" lon="8"/><trkpt lat="7"/></trkseg></trk></gpx>',
    "bad_wpt": '<gpx><wpt lat="x" lon="1"/><trk><trkseg><trkpt lat="7" lon="8"/></trkseg></trk></gpx>',
    "other": '<kml><trkpt lat="7" lon="8"/></kml>',
    "two": '<all><gpx><wpt lat="1" lon="1"/></gpx><gpx><wpt lat="1" lon="1"/></gpx></all>',
    "text": "broken <",
    "empty": "",
}


def _name(path: str) -> str:
    return path.rsplit("/", 1)[-1].removesuffix(".gpx")


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    place = tmp_path_factory.mktemp("gpx")
    (place / "files").mkdir()
    for name, body in FILES.items():
        (place / "files" / f"{name}.gpx").write_text(body)
    into = str(place / "landed")
    land_gpx(spark, str(place / "files"), into)
    land_gpx(spark, str(place / "files"), into)
    return str(place / "files"), into


def _told(spark, into):
    track = sorted((_name(p["path"]), p["point_pos"], p["lat"], p["lon"]) for p in landed_points(spark, into).collect())
    ways = sorted((_name(w["path"]), *w[1:]) for w in landed_points(spark, into, "waypoints").collect())
    return track, ways


def test_files_as_rows(spark, landed):
    docs = {_name(d["path"]): d for d in landed_documents(spark, landed[1]).collect()}
    assert sorted(docs) == ["bare", "prefixed", "whole"]
    assert docs["whole"][1:5] == ("n & m", "d", 3, 2) and tuple(docs["whole"]["coord_hint"]) == (1.5, 2.5)
    assert docs["bare"][1:] == (None, None, 0, 0, None)
    track, ways = _told(spark, landed[1])
    assert track == [("prefixed", 0, 7, 8), ("whole", 0, 1.5, 2.5), ("whole", 1, 3, 4), ("whole", 2, 5, 6)]
    assert ways == [("whole", 0, 1, 2, "a", "pier"), ("whole", 1, 3, 4, "", "")]


def test_rows_agree_with_records(spark, landed):
    records = read_gpx(spark, landed[0])
    names = {r["_pos"]: _name(r["raw_ref"]) for r in records.collect()}
    track, ways = _told(spark, landed[1])
    assert track == sorted((names[p["_pos"]], p["point_pos"], p["lat"], p["lon"]) for p in gpx_track_points(records).collect())
    assert [w[:4] for w in ways] == sorted((names[w["_pos"]], w["point_pos"], w["lat"], w["lon"]) for w in gpx_waypoints(records).collect())


def test_more_files_than_may_be_broadcast(spark, landed, monkeypatch):
    usual = _told(spark, landed[1])
    monkeypatch.setattr(gpx_rows, "SMALL_FILES", 0)
    for parts in (1, 2, 4096):
        monkeypatch.setattr(gpx_rows, "HEAVY_PARTS", parts)
        assert _told(spark, landed[1]) == usual


def test_long_file_keeps_its_order(spark, tmp_path):
    n = 60_000
    points = "".join(f'<trkpt lat="{i % 90}" lon="{i / 1000}"/>\n' for i in range(n))
    (tmp_path / "long.gpx").write_text(f"<gpx><trk><trkseg>{points}</trkseg></trk></gpx>")
    land_gpx(spark, str(tmp_path / "long.gpx"), str(tmp_path / "landed"))
    got = landed_points(spark, str(tmp_path / "landed"))
    assert got.where("lon = point_pos / 1000D AND lat = point_pos % 90").count() == n == got.count()
