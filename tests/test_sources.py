from __future__ import annotations

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from geoingest import (
    gpx_records,
    gpx_track_points,
    gpx_waypoints,
    html_records,
    inline_locators,
    json_records,
    osm_elements,
    osm_records,
    read_gpx,
    read_locators,
    record_preview,
    search_records,
    search_results,
    union_sources,
    url_records,
)
from geoingest.schemas import RAW_RECORD
from helpers import rows

GPX = """<?xml version="1.0" encoding="UTF-8"?>
<gpx version="1.1" creator="t" xmlns="http://www.topografix.com/GPX/1/1">
  <metadata><name>Lake loop</name><desc>around</desc></metadata>
  <wpt lat="61.7849" lon="34.3469"><name>Start</name><type>pier</type></wpt>
  <wpt lat="61.81" lon="34.41"/>
  <trk><trkseg><trkpt lat="61.7849" lon="34.3469"/><trkpt lat="61.80" lon="34.38"/></trkseg><trkseg/></trk>
  <trk><name>b</name><trkseg><trkpt lat="61.81" lon="34.41"><ele>3</ele></trkpt></trkseg></trk>
</gpx>"""


def _docs(spark, *bodies: str):
    return spark.createDataFrame([(f"f{i}", b.encode(), i) for i, b in enumerate(bodies)], "url string, body binary, _pos long")


def test_locator_file_and_list(spark, tmp_path):
    path = tmp_path / "list.txt"
    path.write_text("  https://a \n\n\thttps://b,c\n   \nhttps://d")
    got = rows(read_locators(spark, str(path)).orderBy("_pos"))
    assert [r["value"] for r in got] == ["https://a", "https://b,c", "https://d"]
    lists = spark.createDataFrame([("https://a/1,2,https://b", 7)], "value string, k int")
    assert [(r["k"], r["_item"], r["value"]) for r in rows(inline_locators(lists))] == [
        (7, 0, "https://a/1,2"), (7, 1, "https://b"),
    ]


def test_gpx_document(spark):
    df = gpx_records(_docs(spark, GPX))
    (rec,) = rows(df)
    assert rec["source"] == "gpx" and rec["source_id"] == "Lake loop" and rec["raw_ref"] == "f0"
    assert rec["coord_hint"] == {"lat": 61.7849, "lon": 34.3469}
    raw = json.loads(rec["raw"])
    assert raw["description"] == "around" and len(raw["track_points"]) == 3
    assert [(p["point_pos"], p["lat"]) for p in rows(gpx_track_points(df))] == [(0, 61.7849), (1, 61.80), (2, 61.81)]
    assert [(w["name"], w["type"]) for w in rows(gpx_waypoints(df))] == [("Start", "pier"), ("", "")]


@pytest.mark.parametrize(
    "body", ["<gpx><trk>", "", "not xml", "<html><p>x</p></html>", '<gpx><wpt lat="x" lon="1"/></gpx>', "<gpx><wpt/></gpx>"]
)
def test_unusable_gpx_gives_no_record(spark, body):
    assert rows(gpx_records(_docs(spark, body))) == []
    (failed,) = rows(gpx_records(_docs(spark, body), keep_failed=True))
    assert failed["_error"] == "adapter_returned_none" and failed["_locator"] == "f0"


def test_gpx_without_namespace_name_or_track(spark):
    bare = '<!-- <html> --><gpx><wpt lat="1.5" lon="2.5"/></gpx>'
    (rec,) = rows(gpx_records(_docs(spark, bare)))
    assert rec["source_id"] == "f0" and rec["coord_hint"] is None
    (rec,) = rows(gpx_records(_docs(spark, bare), waypoint_fallback=True))
    assert rec["coord_hint"] == {"lat": 1.5, "lon": 2.5}
    prefixed = "<g:gpx xmlns:g='u'><g:trk><g:trkseg><g:trkpt lat='1' lon='2'/></g:trkseg></g:trk></g:gpx>"
    (rec,) = rows(gpx_records(_docs(spark, prefixed)))
    assert rec["coord_hint"] == {"lat": 1.0, "lon": 2.0}
    (rec,) = rows(gpx_records(_docs(spark, "<gpx/>")))
    assert json.loads(rec["raw"])["track_points"] == []


def test_gpx_files(spark, tmp_path):
    (tmp_path / "a.gpx").write_text(GPX)
    (tmp_path / "b.gpx").write_text("broken <")
    (rec,) = rows(read_gpx(spark, str(tmp_path)))
    assert rec["raw_ref"].endswith("a.gpx")


def _osm(spark, status: int, body: str | None):
    df = spark.createDataFrame([("q" * 200, status, body, 1)], "query string, status int, body string, _pos long")
    return osm_records(df)


def test_osm_envelope_and_elements(spark):
    body = json.dumps(
        {
            "elements": [
                {"type": "way", "id": 1, "center": {"lat": 50.5, "lon": 30.5}, "tags": {"brand": "x"}},
                {"type": "node", "id": 2, "lat": 50.6, "lon": 30.6},
            ]
        }
    )
    df = _osm(spark, 200, body)
    (rec,) = rows(df)
    assert rec["source"] == "overpass" and rec["source_id"] == "overpass:0x" + hashlib.sha256(b"q" * 200).hexdigest()
    assert rec["coord_hint"] == {"lat": 50.5, "lon": 30.5}
    raw = json.loads(rec["raw"])
    assert raw["n_elements"] == 2 and raw["raw_response"] == json.loads(body) and raw["query"] == "q" * 200
    got = rows(osm_elements(df))
    assert [(e["osm_type"], e["osm_id"], e["geom"]["lat"]) for e in got] == [("way", 1, 50.5), ("node", 2, 50.6)]
    assert got[0]["tags"] == {"brand": "x"}


def test_osm_responses_without_elements(spark):
    (rec,) = rows(_osm(spark, 200, '{"elements":[]}'))
    assert rec["coord_hint"] is None and "n_elements" not in json.loads(rec["raw"])
    assert json.loads(rec["raw"])["elements"] == []
    for status, body in [(429, '{"elements":[]}'), (200, "<html>"), (200, "[1]"), (200, None)]:
        assert rows(_osm(spark, status, body)) == []


def _search(spark, status: int, body, **options):
    df = spark.createDataFrame([("fuel", status, body, 1)], "query string, status int, body string, _pos long")
    return search_records(df, **options)


def test_search_envelope_and_results(spark):
    results = [{"url": f"u{i}", "title": f"t{i}", "content": f"c{i}", "score": 1.5} for i in range(5)]
    body = json.dumps({"results": results, "number_of_results": 99})
    df = _search(spark, 200, body, max_results=2)
    (rec,) = rows(df)
    raw = json.loads(rec["raw"])
    assert (raw["n_results"], raw["number_of_results"], rec["text"]) == (2, 99, "c0")
    assert raw["engine_url"] == rec["raw_ref"] and "q=fuel" in rec["raw_ref"]
    assert [(r["result_pos"], r["url"], r["score"]) for r in rows(search_results(df))] == [(0, "u0", 1.5), (1, "u1", 1.5)]


def test_search_responses_without_results(spark):
    for body in ('{"results":[]}', '{"results":null}', "{}"):
        (rec,) = rows(_search(spark, 200, body))
        assert rec["text"] is None and json.loads(rec["raw"])["n_results"] == 0
    for status, body in [(429, "{}"), (200, "oops")]:
        assert rows(_search(spark, status, body)) == []


def test_json_and_html_records(spark):
    landed = spark.createDataFrame(
        [("u1", b'{"a":[1,null]}', {"h": "v"}, "httpx"), ("u2", b"{bad", None, None)],
        "url string, body binary, headers map<string,string>, strategy string",
    )
    (rec,) = rows(json_records(landed))
    assert json.loads(rec["raw"]) == {"json": {"a": [1, None]}, "headers": {"h": "v"}, "strategy": "httpx"}
    page = spark.createDataFrame([("u", "<title>T</title>" + "x" * 60000), ("v", "")], "url string, body string")
    big, empty = rows(html_records(page).orderBy("source_id"))
    assert len(big["text"]) == 50000 and json.loads(big["raw"])["title"] == "T"
    assert empty["text"] is None
    (shown, _) = rows(record_preview(html_records(page)).orderBy("source_id"))
    assert len(shown["text_preview"]) == 200 and shown["raw_size"] == 60016


def test_link_records_and_union(spark):
    links = spark.createDataFrame(
        [("https://yandex.ru/maps/?ll=37.6,55.7&pt=1,2", 0), ("https://example.com", 1)], "value string, _pos long"
    )
    good, bad = rows(url_records(links, keep_failed=True).orderBy("_pos"))
    assert json.loads(good["raw"])["points"] == [[55.7, 37.6], [2.0, 1.0]] and good["_error"] is None
    assert bad["_error"] == "adapter_returned_none"
    stacked = union_sources(url_records(links), html_records(links.withColumnsRenamed({"value": "url"}).withColumn("body", F.lit("x"))))
    assert stacked.columns == RAW_RECORD.fieldNames() and stacked.count() == 3


@pytest.mark.parametrize("body", [b"\xff\xfe<", b"<title>a\xff</title>", bytes(range(256)), b"\xed\xa0\x80", b"<meta charset=nonsense>\xe9"])
def test_no_byte_string_ends_the_job(spark, body):
    df = spark.createDataFrame([(1, "u", "q", 200, body)], "_pos long, url string, query string, status int, body binary")
    for reader in (html_records, json_records, gpx_records, osm_records, search_records):
        reader(df, keep_failed=True).collect()


@pytest.mark.parametrize(("body", "headers", "text"), [
    ("<title>привет</title>".encode("cp1251"), {"Content-Type": "text/html; charset=windows-1251"}, "привет"),
    ("<meta charset='koi8-r'><title>привет</title>".encode("koi8-r"), None, "привет"),
    (("<title>привет</title>" + "<!-- -->" * 5000 + "<meta charset='koi8-r'>").encode("koi8-r"), None, "привет"),
    ("<title>é</title>".encode("utf-16"), None, "é"), ("<meta charset=iso-8859-1><title>\u2019</title>".encode("cp1252"), None, "\u2019"),
    (b"\xef\xbb\xbf<title>x</title>", None, "x"), ("<title>é</title>".encode(), {"content-type": "text/html"}, "é"),
])
def test_declared_encodings(spark, body, headers, text):
    df = spark.createDataFrame([("u", body, headers)], "url string, body binary, headers map<string,string>")
    assert json.loads(rows(html_records(df))[0]["raw"])["title"] == text
