"""Bucketed tables: only touched buckets are rewritten, replays change nothing, a commit that died is finished."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from geoingest import Target, bucketed_entities, bucketed_failures, entity_table, failure_table, isolated, run_ingest, upsert_entities, url_records
from geoingest.schemas import ENTITY_TABLE
from helpers import at, rows

NOW, LATER = "2024-01-01 00:00:00", "2024-02-01 00:00:00"


def entities(spark, ids, value="a"):
    df = spark.createDataFrame([(i, value) for i in ids], "i long, v string")
    return df.selectExpr(
        "'place' AS entity_type", "'s' AS source", "CAST(i AS STRING) AS source_id", "named_struct('lat', 1.0D, 'lon', CAST(i % 90 AS DOUBLE)) AS geom",
        "concat('{\"v\":\"', v, '\",\"n\":', CAST(i AS STRING), '}') AS attrs", "'UA' AS bbox_country", "1.0D AS confidence", "i AS _pos",
    )


def written(path):
    return {f.parent.name: f.stat().st_mtime_ns for f in path.rglob("*.parquet")}


def test_an_upsert_rewrites_the_touched_buckets_only(spark, tmp_path):
    table = bucketed_entities(spark, f"{tmp_path}/t", 64)
    first = entities(spark, range(20_000))
    assert table.upsert(first, at(NOW)) == {"n_inserted": 20_000, "n_updated": 0, "n_skipped": 0}
    before = written(tmp_path / "t")
    assert len(before) == 64
    # A thousand rows of a few buckets, half of them new.
    candidates = table.bucket_of(entities(spark, range(10_000, 60_000), "b")).where("_bucket < 2")
    batch = candidates.orderBy("_pos").limit(1000).drop("_bucket")
    told = table.upsert(batch, at(LATER), tag="x")
    assert told["n_inserted"] + told["n_updated"] == 1000 and told["n_inserted"] and told["n_updated"]
    after = written(tmp_path / "t")
    assert {b for b in after if after[b] != before[b]} == {"_bucket=0", "_bucket=1"}
    empty = spark.createDataFrame([], ENTITY_TABLE)
    expected, _ = upsert_entities(upsert_entities(empty, first, at(NOW))[0], batch, at(LATER))
    assert rows(table.read().orderBy("source_id")) == rows(expected.orderBy("source_id"))
    # The replay with the tag reads and writes nothing.
    assert sum(table.upsert(batch, at("2024-03-01 00:00:00"), tag="x").values()) == 0
    assert written(tmp_path / "t") == after


def test_only_touched_buckets_are_read(spark, tmp_path):
    table = bucketed_entities(spark, f"{tmp_path}/t", 16)
    table.upsert(entities(spark, range(500)), at(NOW))
    seen = []
    table.apply(entities(spark, [1]), lambda old, batch: seen.append(old.select(F.input_file_name()).distinct().count()) or old)
    assert seen == [1]


def test_a_commit_that_died_is_finished(spark, tmp_path, monkeypatch):
    table = bucketed_entities(spark, f"{tmp_path}/t", 4)
    table.upsert(entities(spark, range(50)), at(NOW), tag="a")
    finish = type(table)._finish
    monkeypatch.setattr(type(table), "_finish", lambda self: None)
    table.upsert(entities(spark, range(40, 60), "b"), at(LATER), tag="b")
    monkeypatch.setattr(type(table), "_finish", finish)
    again = bucketed_entities(spark, f"{tmp_path}/t", 4)
    assert sum(again.upsert(entities(spark, range(40, 60), "b"), at(LATER), tag="b").values()) == 0
    assert again.read().count() == 60 and again.read().where("last_seen_at = '2024-02-01'").count() == 20


def test_soft_delete_and_empty_batches(spark, tmp_path):
    table = bucketed_entities(spark, f"{tmp_path}/t", 8)
    assert table.read().count() == 0 and table.soft_delete(entities(spark, [1]), at(NOW)) == 0
    table.upsert(entities(spark, range(30)), at(NOW))
    keys = entities(spark, [3, 4, 99]).select("source", F.when(F.col("_pos") != 4, F.col("source_id")).alias("source_id"))
    assert table.soft_delete(keys, at(LATER)) == 1 and table.soft_delete(keys, at(LATER)) == 0
    assert [r["source_id"] for r in rows(table.read().where("removed_at IS NOT NULL"))] == ["3"]
    assert table.upsert(entities(spark, []), at(LATER)) == {"n_inserted": 0, "n_updated": 0, "n_skipped": 0}
    assert table.upsert(entities(spark, [3]), at(LATER), on_conflict="DO_NOTHING")["n_skipped"] == 1


def links(spark, n):
    urls = [f"https://maps.google.com/?q=50.{i},30.{i}" for i in range(n)] + ["https://example.com/none"]
    return spark.createDataFrame([(u, i) for i, u in enumerate(urls)], "value string, _pos long")


def test_a_run_into_bucketed_tables(spark, tmp_path):
    reader = lambda df: url_records(df, keep_failed=True)
    tables = [bucketed_entities(spark, f"{tmp_path}/e", 8), entity_table(spark, f"{tmp_path}/v")]
    failures = [bucketed_failures(spark, f"{tmp_path}/f", 4), failure_table(spark, f"{tmp_path}/w")]
    for _ in range(2):
        told = [
            run_ingest(spark, links(spark, 30), reader, source_name="maps", now=at(NOW), targets=[Target(t)], failures=f, tag="one")
            for t, f in zip(tables, failures)
        ]
    assert [(r.rows_total, r.rows_skipped) for r in told] == [(31, 1)] * 2
    assert rows(tables[0].read().orderBy("source_id")) == rows(tables[1].read().orderBy("source_id"))
    assert rows(failures[0].read()) == rows(failures[1].read()) and rows(failures[0].read())[0]["attempts"] == 1


def test_an_isolated_enricher_costs_no_jobs_per_bad_row(spark, tmp_path):
    def broken(batch):
        if (batch["_pos"] % 10 == 3).any():
            raise ValueError("bad row")
        return pd.DataFrame({"confidence": batch["_pos"] / 1000, "entity_type": "seen"})

    def run(n):
        group = f"isolated-{n}"
        spark.sparkContext.setJobGroup(group, group)
        locators = spark.range(n).selectExpr("concat('https://maps.google.com/?q=5.', CAST(id % 999 AS STRING), ',3.', CAST(id AS STRING)) AS value", "id AS _pos")
        table = entity_table(spark, f"{tmp_path}/{n}")
        enricher = isolated(broken, ["_pos"], "confidence double, entity_type string")
        r = run_ingest(spark, locators, lambda df: url_records(df, keep_failed=True), source_name="maps", now=at(NOW), enrichers=[enricher], targets=[Target(table)])
        spark.sparkContext.setJobGroup("", "")
        return r, table, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    few, _, jobs = run(20)
    many, table, more = run(20_000)
    assert (few.rows_unenriched, many.rows_unenriched) == (2, 2_000) and many.rows_inserted == 20_000
    assert more <= jobs + 10
    stored = table.read()
    assert stored.where("entity_type = 'seen'").count() == 18_000 and stored.where("confidence IS NULL").count() == 0


def test_rows_that_do_not_fit_the_schema_stay_alone(spark):
    def odd(batch):
        return pd.DataFrame({"n": [("x" if v == 2 else v * 2) for v in batch["v"]]})

    df = spark.createDataFrame([(i,) for i in range(5)], "v long").withColumn("n", F.lit(-1).cast("long"))
    stage = isolated(odd, ["v"], "n long")
    got = rows(stage(stage(df)).orderBy("v"))
    assert [r["n"] for r in got] == [0, 2, -1, 6, 8]
    assert [r["_enrich_error"] is None for r in got] == [True, True, False, True, True] and got[2]["_enrich_error"].count(";") >= 1
    assert stage(df.limit(0)).count() == 0


def test_windows_and_outages_of_a_stream_are_those_of_the_table(spark, tmp_path):
    from conftest import TESTDATA
    from geoingest.operators import fetchlog
    from geoingest.plans.derived import fetch_log

    log = fetch_log(spark, str(TESTDATA)).select("source", F.col("ts").cast("timestamp").alias("ts"), "status")
    log.repartitionByRange(4, "ts").write.parquet(f"{tmp_path}/log")
    arrivals = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/log")
    for name, fn in (("health", fetchlog.windowed_health), ("outages", fetchlog.outages)):
        stream = fn(arrivals, late="30 days").writeStream.format("memory").queryName(name).outputMode("complete")
        stream.option("checkpointLocation", f"{tmp_path}/{name}").trigger(availableNow=True).start().awaitTermination()
        expected = fn(log)
        assert sorted(map(tuple, spark.table(name).select(expected.columns).collect())) == sorted(map(tuple, expected.collect()))
