from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from geoingest import (
    Target,
    build_session,
    drop_repeated,
    enrich_tracks,
    entity_table,
    failure_table,
    gpx_records,
    html_records,
    json_records,
    landed_reader,
    read_entities,
    read_failures,
    read_run_log,
    record_failures,
    run_ingest,
    stream_upsert,
    to_entity,
    url_records,
)
from geoingest.functions.country import with_country
from geoingest.operators.merge import DO_NOTHING, upsert_entities
from geoingest.operators.runlog import errors_sample, run_counters, source_health
from geoingest.plans import ingest
from geoingest.plans.ingest import fetch_error
from geoingest.schemas import ENTITY, ENTITY_TABLE, FAILURE_TABLE, RUN_LOG
from geoingest.session import broadcast_if_small, checkpoint_dir
from geoingest.sinks.tables import VersionedTable
from helpers import at, rows

NOW, LATER = "2024-01-01 00:00:00", "2024-01-02 00:00:00"
LINKS = [
    "https://yandex.ru/maps/?ll=37.6173,55.7558",
    "https://maps.google.com/?q=50.0,30.0",
    "https://example.com/no-coords",
]


def locators(spark, *links):
    return spark.createDataFrame([(u, i) for i, u in enumerate(links)], "value string, _pos long")


def counts(r):
    return (r.rows_total, r.rows_inserted, r.rows_updated, r.rows_skipped, r.rows_failed)


def with_errors(df):
    return url_records(df, keep_failed=True)


@pytest.mark.parametrize("reader", [url_records, with_errors])
def test_dry_run_counts(spark, reader):
    r = run_ingest(spark, locators(spark, *LINKS), reader, source_name="url", now=at(NOW))
    assert counts(r) == (3, 2, 0, 1, 0) and r.errors == ["adapter_returned_none"]


def test_run_writes_tables_and_log(spark, tmp_path):
    entities, failures = entity_table(spark, f"{tmp_path}/e"), failure_table(spark, f"{tmp_path}/f")
    options = dict(
        source_name="maps", targets=[Target(entities)], failures=failures, run_log_path=f"{tmp_path}/log",
        normalizer=lambda raw: with_country(to_entity(raw)), http_status=200,
    )
    first = run_ingest(spark, locators(spark, *LINKS, LINKS[0]), with_errors, now=at(NOW), **options)
    assert counts(first) == (4, 2, 1, 1, 0)
    second = run_ingest(spark, locators(spark, *LINKS), with_errors, now=at(LATER), **options)
    assert counts(second) == (3, 0, 2, 1, 0)
    stored = {r["source_id"]: r for r in rows(read_entities(spark, f"{tmp_path}/e"))}
    assert stored[LINKS[0]]["bbox_country"] == "RU" and stored[LINKS[1]]["bbox_country"] == "UA"
    assert json.loads(stored[LINKS[0]]["attrs"])["points"] == [[55.7558, 37.6173]]
    (failed,) = rows(read_failures(spark, f"{tmp_path}/f"))
    assert (failed["source"], failed["source_id"], failed["failure_stage"]) == ("maps", LINKS[2], "fetch")
    assert failed["attempts"] == 2 and failed["url"] is None
    log = rows(read_run_log(spark, f"{tmp_path}/log").orderBy("run_ts"))
    assert [(r["rows_added"], r["rows_updated"], r["http_status"], r["error"]) for r in log] == [
        (2, 1, 200, "adapter_returned_none"), (0, 2, 200, "adapter_returned_none"),
    ]
    assert not [d for d in os.listdir(checkpoint_dir(spark)) if d.startswith("run-")]


def test_normalizer_outcomes_and_refused_rows(spark, tmp_path):
    def normalizer(raw):
        lat = F.col("coord_hint.lat")
        return (
            to_entity(raw)
            .withColumn("_problem", F.when(lat == 1, F.lit("no such place")))
            .withColumn("entity_type", F.when(lat != 2, F.lit("place")))
            .withColumn("attrs", F.when(lat == 3, F.lit("[]")).otherwise(F.col("attrs")))
        )

    failures = failure_table(spark, f"{tmp_path}/f")
    links = [f"https://maps.google.com/?q={i}.0,5.0" for i in (1, 2, 3, 4)]
    r = run_ingest(
        spark, locators(spark, *links), url_records, source_name="maps", now=at(NOW), normalizer=normalizer,
        targets=[Target(entity_table(spark, f"{tmp_path}/e"), name="db")], failures=failures,
    )
    assert counts(r) == (4, 1, 0, 1, 2)
    got = {f["source_id"]: (f["failure_stage"], f["failure_detail"]) for f in rows(failures.read())}
    assert got == {
        links[0]: ("normalize", "normalize: ValueError: no such place"),
        links[1]: ("normalize", "normalizer_returned_none"),
        links[2]: ("persist", "persist[db]: NotPersisted: attrs is not a JSON object"),
    }
    assert r.errors[0] == "normalize: ValueError: no such place"


def test_every_sink_counts_for_itself(spark, tmp_path):
    targets = [
        Target(entity_table(spark, f"{tmp_path}/a")),
        Target(entity_table(spark, f"{tmp_path}/b"), on_conflict=DO_NOTHING),
        Target(),
    ]
    r = run_ingest(
        spark, locators(spark, LINKS[0], LINKS[0]), url_records, source_name="maps", now=at(NOW), targets=targets
    )
    assert counts(r) == (2, 4, 1, 1, 0)


def test_enrichers_run_in_order_and_a_broken_one_is_left_out(spark, tmp_path):
    table = entity_table(spark, f"{tmp_path}/e")
    tag = lambda n: lambda df: df.withColumn("attrs", F.concat(F.expr("rtrim('}', attrs)"), F.lit(f',"t{n}":{n}}}')))
    r = run_ingest(
        spark, locators(spark, *LINKS), url_records, source_name="maps", now=at(NOW), targets=[Target(table)],
        enrichers=[tag(1), lambda df: df.withColumn("attrs", F.col("no_such_column")), tag(2)],
    )
    assert counts(r) == (3, 2, 0, 1, 0)
    for e in rows(table.read()):
        assert {"t1", "t2"} <= set(json.loads(e["attrs"]))


def test_empty_input_and_fetch_errors(spark, tmp_path):
    log = f"{tmp_path}/log"
    r = run_ingest(spark, locators(spark, "x").limit(0), url_records, source_name="maps", now=at(NOW), run_log_path=log)
    assert counts(r) == (0, 0, 0, 0, 0)
    assert rows(read_run_log(spark, log))[0]["rows_added"] == 0
    failing = lambda df: fetch_error(url_records(df, keep_failed=True), F.lit("all strategies exhausted for x"))
    r = run_ingest(spark, locators(spark, "x"), failing, source_name="maps", now=at(NOW))
    assert counts(r) == (1, 0, 0, 1, 0) and r.errors == ["fetch: RuntimeError: all strategies exhausted for x"]


def test_gpx_through_a_run(spark, tmp_path):
    table = entity_table(spark, f"{tmp_path}/e")
    body = b'<gpx><wpt lat="1" lon="2"/><trk><trkseg><trkpt lat="49.8" lon="24.0"/></trkseg></trk></gpx>'
    docs = spark.createDataFrame([("a.gpx", body, 0), ("b.gpx", b"<gpx>", 1)], "value string, body binary, _pos long")
    r = run_ingest(
        spark, docs, lambda df: gpx_records(df, locator="value", keep_failed=True), source_name="gpx", now=at(NOW),
        targets=[Target(table)],
    )
    assert counts(r) == (2, 1, 0, 1, 0)
    (e,) = rows(table.read())
    assert e["entity_type"] == "raw" and e["geom"] == '{"type":"Point","coordinates":[24.0,49.8]}'


def test_landed_responses_through_a_run(spark, tmp_path):
    log = spark.createDataFrame(
        [
            ("u1", 1, 0, 500, b"down"), ("u1", 2, 0, 200, b'{"a":1}'), ("u2", 1, 0, 200, b"<html>"),
            ("u3", 1, 0, 503, b"{}"), ("u9", 1, 0, 200, b"{}"),
        ],
        "url string, attempt int, strategy_rank int, status int, body binary",
    )
    table, failures = entity_table(spark, f"{tmp_path}/e"), failure_table(spark, f"{tmp_path}/f")
    r = run_ingest(
        spark, locators(spark, "u1", "u2", "u3", "u4"), landed_reader(log, json_records), source_name="feed",
        now=at(NOW), targets=[Target(table)], failures=failures,
    )
    assert counts(r) == (4, 1, 0, 3, 0)
    (e,) = rows(table.read())
    assert e["source_id"] == "u1" and json.loads(e["attrs"])["json"] == {"a": 1}
    got = {f["source_id"]: f["failure_detail"] for f in rows(failures.read())}
    lost = "fetch: RuntimeError: all strategies exhausted for "
    assert got == {"u2": "adapter_returned_none", "u3": lost + "u3", "u4": lost + "u4"}
    pages = run_ingest(
        spark, locators(spark, "u2", "u3"), landed_reader(log, html_records), source_name="html", now=at(NOW)
    )
    assert counts(pages) == (2, 1, 0, 1, 0)


def test_failure_table_counts_attempts(spark):
    kind = ("source string, source_id string, text string, raw_ref string, coord_hint struct<lat:double,lon:double>, "
            "stage string, detail string, _pos long")
    events = [
        ("s", "a", "t" * 300, "https://x", (1.0, 2.0), "fetch", "d" * 5000, 0),
        ("s", "a", "", "local", None, "persist", "last", 1), ("s", None, "t", "x", None, "fetch", "d", 2),
    ] + [("s", "b", None, "x", None, "fetch", "d", i) for i in range(3, 8)]
    table = record_failures(spark.createDataFrame([], FAILURE_TABLE), spark.createDataFrame(events, kind), at(NOW))
    got = {r["source_id"]: r for r in rows(table)}
    a, b = got["a"], got["b"]
    assert len(a["title"]) == 200 and a["url"] == "https://x" and json.loads(a["geom"])["coordinates"] == [2.0, 1.0]
    assert (a["failure_stage"], a["failure_detail"], a["attempts"]) == ("persist", "last", 2)
    assert b["attempts"] == 5 and b["title"] is None and set(got) == {"a", "b", "unknown"}
    again = record_failures(table, spark.createDataFrame([events[0]], kind), at(LATER))
    a = {r["source_id"]: r for r in rows(again)}["a"]
    assert a["attempts"] == 3 and len(a["failure_detail"]) == 2000
    assert (str(a["first_attempt_at"]), str(a["last_attempt_at"])) == (NOW, LATER)


def test_enrich_tracks(spark):
    finish = '{"finish_lat":50.6,"finish_lon":30.6}'
    e = spark.createDataFrame(
        [("raw", "s", sid, (50.5, 30.5) if geo else None, attrs, None, 1.0, i) for i, (sid, geo, attrs) in enumerate(
            [("a", True, finish), ("b", True, finish), ("c", False, finish), ("d", True, '{"finish_lat":1}'),
             ("e", True, '{"finish_lat":1,"finish_lon":2}')])],
        ENTITY,
    )
    url = "https://brouter.de/brouter?lonlats=30.5%2C50.5%7C{}&profile=river&alternativeidx=0&format=geojson"
    line = {"features": [{"geometry": {"type": "LineString", "coordinates": [[30.5, 50.5], [200, 1], [30.6, 50.6]]}}]}
    short = {"features": [{"geometry": {"type": "LineString", "coordinates": [[30.5, 50.5]]}}]}
    responses = spark.createDataFrame(
        [(url.format("30.6%2C50.6"), 200, json.dumps(line).encode()), (url.format("2%2C1"), 200, json.dumps(short).encode())],
        "url string, status int, body binary",
    )
    got = {r["source_id"]: json.loads(r["attrs"]) for r in rows(enrich_tracks(e, responses))}
    assert got["a"]["track"] == [[50.5, 30.5], [50.6, 30.6]] and got["a"]["track_npts"] == 2
    assert got["a"]["track_quality"] == "placeholder" and got["a"]["track_source"] == "brouter"
    assert got["b"] == got["a"] and "track" not in got["c"] | got["d"] | got["e"] and len(got) == 5


def test_versioned_table(spark, tmp_path):
    table = VersionedTable(spark, f"{tmp_path}/t", RUN_LOG)
    assert table.read().count() == 0
    row = ("r", None, "s", 1, 0, None, None, 1)
    one = spark.createDataFrame([row], RUN_LOG)
    table.commit(one)
    table.commit(table.read().union(one), tag="b-1")
    os.makedirs(f"{tmp_path}/t/v0000000003")  # a commit that died
    assert table.read().count() == 2 and table.has("b-1") and not table.has("b-2")
    assert table.read_before("b-1").count() == 1 and table.read_tagged("b-1").count() == 2
    table.commit(one)
    table.prune(keep=1)
    assert table.read().count() == 1 and table.has("b-1") and not table.has_version("b-1")


def test_counters_samples_and_health(spark):
    outcomes = spark.createDataFrame(
        [("s", i, o, e) for i, (o, e) in enumerate([("inserted", None), ("failed", "e1"), ("skipped", "e2"), ("failed", "e3"), ("failed", "e4")])],
        "source string, _pos long, outcome string, error string",
    )
    (c,) = rows(run_counters(outcomes))
    assert c == {"source": "s", "rows_total": 5, "rows_inserted": 1, "rows_updated": 0, "rows_skipped": 1, "rows_failed": 3}
    sample = errors_sample(outcomes)
    assert [r["error"] for r in rows(sample.orderBy("rank"))] == ["e1", "e2", "e3"]
    assert "WindowGroupLimit" in sample._jdf.queryExecution().executedPlan().toString()
    log = spark.createDataFrame(
        [("s", "2024-01-08 00:00:00", 3, "x"), ("s", "2024-01-01 00:00:00", 5, None), ("s", "2024-01-02 12:00:00", 2, None)],
        "source string, run_ts string, rows_added long, error string",
    ).selectExpr("source", "CAST(run_ts AS TIMESTAMP) AS run_ts", "rows_added", "0L AS rows_updated", "200 AS http_status", "error")
    (h,) = rows(source_health(log, at("2024-01-08 00:00:00")))
    assert (h["runs"], h["rows_added"], h["runs_with_error"]) == (2, 5, 1)


def _start(spark, tmp_path, entities, failures):
    arrivals = spark.readStream.text(f"{tmp_path}/in")
    return stream_upsert(
        arrivals, with_errors, source_name="maps", checkpoint=f"{tmp_path}/ck", query_name="links",
        now=lambda batch: at(NOW if batch == 0 else LATER), targets=[Target(entities)], failures=failures,
        run_log_path=f"{tmp_path}/log",
    )


def test_stream_carries_new_files_and_replays_safely(spark, tmp_path):
    entities, failures = entity_table(spark, f"{tmp_path}/e"), failure_table(spark, f"{tmp_path}/f")
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.txt").write_text("\n".join(LINKS))
    _start(spark, tmp_path, entities, failures).awaitTermination()
    (tmp_path / "in" / "2.txt").write_text("\n".join(LINKS[1:]))
    _start(spark, tmp_path, entities, failures).awaitTermination()
    seen = {r["source_id"]: str(r["last_seen_at"]) for r in rows(entities.read())}
    assert seen == {LINKS[0]: NOW, LINKS[1]: LATER}
    assert [r["attempts"] for r in rows(failures.read())] == [2]
    # The commit of the last batch is lost, so the next start replays it.
    commits = tmp_path / "ck" / "commits"
    for name in ("1", ".1.crc"):
        if (commits / name).exists():
            (commits / name).unlink()
    before = rows(entities.read().orderBy("source_id"))
    _start(spark, tmp_path, entities, failures).awaitTermination()
    assert rows(entities.read().orderBy("source_id")) == before
    assert [r["attempts"] for r in rows(failures.read())] == [2]
    log = rows(read_run_log(spark, f"{tmp_path}/log").orderBy("run_ts"))
    assert [(r["rows_added"], r["rows_updated"]) for r in log] == [(2, 0), (0, 1)]


def test_repeated_records_are_dropped_within_event_time(spark, tmp_path):
    kind = "source string, source_id string, fetched_at timestamp"
    batch = lambda *items: spark.createDataFrame(
        [("s", k, t) for k, t in items], "source string, source_id string, fetched_at string"
    ).selectExpr("source", "source_id", "CAST(fetched_at AS TIMESTAMP) AS fetched_at")
    batch(("a", "2024-01-01 00:00:00"), ("a", "2024-01-01 01:00:00"), ("b", "2024-01-01 02:00:00")).write.parquet(f"{tmp_path}/in")
    arrivals = spark.readStream.schema(kind).parquet(f"{tmp_path}/in")
    query = (
        drop_repeated(arrivals).writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/ck")
        .trigger(availableNow=True).start(f"{tmp_path}/out")
    )
    query.awaitTermination()
    assert sorted(r["source_id"] for r in rows(spark.read.parquet(f"{tmp_path}/out"))) == ["a", "b"]


def test_session_helpers(spark):
    assert build_session("again").conf.get("spark.sql.session.timeZone") == "UTC"
    assert checkpoint_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    hinted = lambda n: "ResolvedHint" in broadcast_if_small(spark.range(10), n)._jdf.queryExecution().analyzed().toString()
    assert hinted(10) and not hinted(9)


def test_rows_that_a_stage_drops_or_the_table_refuses_are_accounted_for(spark, tmp_path):
    drop_first = lambda raw: with_country(to_entity(raw)).where("_pos <> 0")
    no_source = lambda raw: drop_first(raw).withColumn("source", F.lit(None).cast("string"))
    good = LINKS[:2] + ["https://maps.google.com/?q=51.0,31.0"]
    failures = failure_table(spark, f"{tmp_path}/f")
    r = run_ingest(
        spark, locators(spark, *good), with_errors, source_name="maps", now=at(NOW), normalizer=no_source,
        targets=[Target(entity_table(spark, f"{tmp_path}/e"))], failures=failures, errors_path=f"{tmp_path}/errors", errors_kept=1,
    )
    assert counts(r) == (3, 0, 0, 1, 2) and len(r.errors) == 1
    assert {(x["source"], x["source_id"], x["failure_stage"]) for x in rows(failures.read())} == {
        ("maps", good[0], "normalize"), ("maps", good[1], "persist"), ("maps", good[2], "persist"),
    }
    told = rows(spark.read.parquet(f"{tmp_path}/errors"))
    assert sorted((x["_pos"], x["stage"]) for x in told) == [(0, "normalize"), (1, "persist"), (2, "persist")]


def test_an_enricher_that_fails_on_a_row_leaves_all_rows(spark, tmp_path):
    breaks = lambda df: df.withColumn("attrs", F.when(F.col("_pos") == 1, F.raise_error(F.lit("bad row"))).otherwise(F.col("attrs")))
    works = lambda df: df.withColumn("confidence", F.lit(0.25))
    table = entity_table(spark, f"{tmp_path}/e")
    r = run_ingest(
        spark, locators(spark, *LINKS), with_errors, source_name="maps", now=at(NOW), enrichers=[breaks, works], targets=[Target(table)]
    )
    assert counts(r) == (3, 2, 0, 1, 0) and {x["confidence"] for x in rows(table.read())} == {0.25}


def test_a_failed_run_leaves_nothing_staged(spark, tmp_path):
    where = checkpoint_dir(spark)
    before = {d for d in os.listdir(where) if d.startswith("run-")} if os.path.isdir(where) else set()
    fails = lambda df: url_records(df).withColumn("raw", F.raise_error(F.lit("no reader")).cast("string"))
    with pytest.raises(Exception, match="no reader"):
        run_ingest(spark, locators(spark, *LINKS), fails, source_name="maps", now=at(NOW))
    assert {d for d in os.listdir(where) if d.startswith("run-")} == before


def test_any_function_can_be_a_sink(spark, tmp_path):
    def store(valid, now):
        valid.write.parquet(f"{tmp_path}/out")
        one = F.lit(1).cast("long")
        return valid.select("source", "source_id", one.alias("n_inserted"), (one - 1).alias("n_updated"), (one - 1).alias("n_skipped"))

    r = run_ingest(spark, locators(spark, *LINKS), with_errors, source_name="maps", now=at(NOW), targets=[Target(write=store)])
    assert counts(r) == (3, 2, 0, 1, 0) and spark.read.parquet(f"{tmp_path}/out").count() == 2


def test_a_stream_with_a_new_checkpoint_is_no_replay(spark, tmp_path):
    table = entity_table(spark, f"{tmp_path}/e")
    for i, link in enumerate(LINKS[:2]):
        (tmp_path / f"in{i}").mkdir()
        (tmp_path / f"in{i}" / "1.txt").write_text(link)
        stream_upsert(
            spark.readStream.text(f"{tmp_path}/in{i}"), with_errors, source_name="maps", checkpoint=f"{tmp_path}/ck{i}",
            now=lambda batch: at(NOW), targets=[Target(table)],
        ).awaitTermination()
    assert table.read().count() == 2


def test_pruned_versions_keep_their_tags(spark, tmp_path):
    table = VersionedTable(spark, f"{tmp_path}/t", RUN_LOG)
    for i in range(5):
        table.commit(spark.createDataFrame([], RUN_LOG), f"tag-{i}")
    table.prune(keep=2)
    assert all(table.has(f"tag-{i}") for i in range(5)) and not table.has("tag-9")
    assert [table.has_version(f"tag-{i}") for i in range(5)] == [False, False, False, True, True]


def test_rows_without_a_place_are_refused(spark):
    e = spark.createDataFrame([("raw", "s", "a", None, "{}", None, 1.0, None)], ENTITY)
    with pytest.raises(Exception, match="_pos is null"):
        upsert_entities(spark.createDataFrame([], ENTITY_TABLE), e, at(NOW))[0].collect()


def test_rows_an_enricher_fails_on_stay_alone_as_they_were(spark, tmp_path):
    links = [f"https://maps.google.com/?q=50.{i},30.{i}" for i in range(1, 41)]
    bad = F.col("_pos").isin(3, 17)
    breaks = lambda df: df.withColumn("confidence", F.when(bad, F.raise_error(F.lit("bad row")).cast("double")).otherwise(F.lit(0.25)))
    works = lambda df: df.withColumn("entity_type", F.lit("place"))
    unplanned = lambda df: df.withColumn("attrs", F.col("no_such_column"))
    table = entity_table(spark, f"{tmp_path}/e")
    r = run_ingest(
        spark, locators(spark, *links), with_errors, source_name="maps", now=at(NOW), enrichers=[breaks, works], targets=[Target(table)]
    )
    assert counts(r) == (40, 40, 0, 0, 0) and r.rows_unenriched == 2
    stored = rows(table.read())
    assert {x["source_id"] for x in stored if x["confidence"] != 0.25} == {links[3], links[17]}
    assert {x["entity_type"] for x in stored} == {"place"}
    r = run_ingest(spark, locators(spark, *links), with_errors, source_name="maps", now=at(NOW), enrichers=[unplanned, works])
    assert r.rows_unenriched == 40


def test_a_run_told_again_is_kept_once(spark, tmp_path):
    old = spark.createDataFrame([("old", None, "maps", 1, 0, None, None, 5)], RUN_LOG)
    old.write.parquet(f"{tmp_path}/log")
    for _ in range(2):
        run_ingest(
            spark, locators(spark, *LINKS), with_errors, source_name="maps", now=at(NOW), run_id="r/1 é",
            run_log_path=f"{tmp_path}/log", errors_path=f"{tmp_path}/errors",
        )
    log = rows(read_run_log(spark, f"{tmp_path}/log").orderBy("run_id"))
    assert [(r["run_id"], r["rows_added"]) for r in log] == [("old", 1), ("r/1 é", 2)]
    errors = spark.read.option("recursiveFileLookup", "true").parquet(f"{tmp_path}/errors")
    assert [(r["run_id"], r["source_id"]) for r in rows(errors)] == [("r/1 é", LINKS[2])]
    # A write that died leaves hidden folders, which no reader sees.
    dead = tmp_path / "log" / ".spark-staging-1" / "_run=x"
    dead.mkdir(parents=True)
    (dead / "part-0.parquet").write_bytes(b"cut")
    assert read_run_log(spark, f"{tmp_path}/log").count() == 2


def test_a_dry_run_without_errors_has_no_job_beside_its_writes(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("counted-run", "dry run")
    try:
        r = run_ingest(spark, spark.range(1000).selectExpr(f"'{LINKS[0]}' AS value", "id AS _pos"), with_errors, source_name="m", now=at(NOW))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert counts(r) == (1000, 1000, 0, 0, 0) and r.errors == []
    # Locators, rows and dropped rows are written; adaptive planning runs the stages of the last write as jobs of their own.
    # Each of the two tables it reads has a job for its schema.
    assert len(tracker.getJobIdsForGroup("counted-run")) <= 8


def test_reader_runs_once_for_records_and_failures(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def told(link):
        seen.add(1)
        return link

    failures = failure_table(spark, f"{tmp_path}/f")
    r = run_ingest(
        spark, locators(spark, *LINKS), lambda df: url_records(df.withColumn("value", told.asNondeterministic()("value")), keep_failed=True),
        source_name="maps", now=at(NOW), failures=failures,
    )
    assert seen.value == len(LINKS) and counts(r) == (3, 2, 0, 1, 0)
    (failed,) = rows(failures.read())
    assert (failed["source"], failed["source_id"], failed["attempts"]) == ("maps", LINKS[2], 1)


def test_dropped_row_is_told_next_to_a_doubled_one(spark, tmp_path):
    def normalizer(raw):
        kept = to_entity(raw).where(F.col("_pos") != 0)
        return kept.unionByName(kept.where(F.col("_pos") == 1))

    failures = failure_table(spark, f"{tmp_path}/f")
    r = run_ingest(spark, locators(spark, *LINKS), with_errors, source_name="maps", now=at(NOW), normalizer=normalizer, failures=failures)
    assert counts(r) == (4, 2, 0, 2, 0)
    assert {f["source_id"] for f in rows(failures.read())} == {LINKS[0], LINKS[2]}


def test_a_task_merges_a_bounded_number_of_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ingest, "ROWS_PER_TASK", 2)
    assert ingest._dealt(spark.range(9).withColumnRenamed("id", "_pos").coalesce(1), 9).rdd.getNumPartitions() == 5
    assert ingest._dealt(spark.range(9).withColumnRenamed("id", "_pos").coalesce(1), 2).rdd.getNumPartitions() == 1
    links = [f"https://maps.google.com/?q={i % 7}.0,5.0" for i in range(40)]
    entities = entity_table(spark, f"{tmp_path}/e")
    r = run_ingest(spark, locators(spark, *links), with_errors, source_name="maps", now=at(NOW), targets=[Target(entities)])
    assert counts(r) == (40, 7, 33, 0, 0) and {e["source_id"] for e in rows(entities.read())} == set(links)
