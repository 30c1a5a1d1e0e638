from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from geoingest.operators.fetchlog import backoff_interval, health_at, mirror_health, mirror_state, pacing_state
from geoingest.streaming.health import MIRROR_STATE, PACING_STATE, mirror_table, pacing_table, stream_health
from helpers import at, rows

SCHEMA = "source string, mirror string, ts timestamp, status int, event_id long"
SOON = "2024-01-01 01:40:30"


def attempts(spark, n: int, seed: int):
    pick = random.Random(seed)
    made, second = [], 0
    for i in range(n):
        second += pick.choice([0, 1, 20, 45])
        source = None if pick.random() < 0.05 else pick.choice(["hot", "hot", "hot", "a", "b"])
        status = pick.choice([200, 200, 304, 406, 429, 503, 0, None])
        mirror = None if pick.random() < 0.05 else pick.choice(["m0", "m0", "m1"])
        made.append((source, mirror, second, status, i))
    df = spark.createDataFrame(made, "source string, mirror string, s long, status int, event_id long")
    start = F.unix_seconds(F.lit("2024-01-01").cast("timestamp"))
    return df.select("source", "mirror", F.timestamp_seconds(start + F.col("s")).alias("ts"), "status", "event_id")


def by_key(df, key: str) -> dict:
    return {r[key]: r for r in rows(df)}


@pytest.mark.parametrize("cuts", [(40,), (1, 2, 90), (0, 100)])
def test_state_carried_over_parts_is_the_state_of_the_whole(spark, cuts):
    log = attempts(spark, 100, len(cuts)).cache()
    pacing, mirrors = spark.createDataFrame([], PACING_STATE), spark.createDataFrame([], MIRROR_STATE)
    for low, high in zip((0, *cuts), (*cuts, 100)):
        part = log.where((F.col("event_id") >= low) & (F.col("event_id") < high))
        pacing = spark.createDataFrame(pacing_state(part, pacing, tie="event_id").collect(), PACING_STATE)
        named = part.where("mirror IS NOT NULL")
        mirrors = spark.createDataFrame(mirror_state(named, mirrors).collect(), MIRROR_STATE)
    whole = by_key(backoff_interval(log, tie="event_id"), "source")
    assert {k: r["current_interval_s"] for k, r in by_key(pacing, "source").items()} == {
        k: r["current_interval_s"] for k, r in whole.items()
    }
    assert by_key(health_at(mirrors, at(SOON)), "mirror") == by_key(mirror_health(log.where("mirror IS NOT NULL"), at(SOON)), "mirror")


def test_a_stream_replayed_after_a_lost_commit_ends_with_the_batch_state(spark, tmp_path):
    log = attempts(spark, 120, 7).cache()
    pacing, mirrors = pacing_table(spark, f"{tmp_path}/pacing"), mirror_table(spark, f"{tmp_path}/mirrors")

    def carry() -> None:
        arrivals = spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in")
        stream_health(arrivals, checkpoint=f"{tmp_path}/ck", pacing=pacing, mirrors=mirrors, versions_kept=1).awaitTermination()

    for part in (0, 1, 2):
        log.where(F.col("event_id").between(part * 40, part * 40 + 39)).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        carry()
    before = rows(pacing.read().orderBy("source")), rows(mirrors.read().orderBy("mirror"))
    for name in ("2", ".2.crc"):
        (tmp_path / "ck" / "commits" / name).unlink(missing_ok=True)
    carry()
    assert (rows(pacing.read().orderBy("source")), rows(mirrors.read().orderBy("mirror"))) == before
    whole = by_key(backoff_interval(log, tie="event_id"), "source")
    assert {k: r["current_interval_s"] for k, r in by_key(pacing.read(), "source").items()} == {
        k: r["current_interval_s"] for k, r in whole.items()
    }
    assert by_key(health_at(mirrors.read(), at(SOON)), "mirror") == by_key(mirror_health(log.where("mirror IS NOT NULL"), at(SOON)), "mirror")


def test_empty_parts_change_nothing(spark):
    known = spark.createDataFrame([("a", 4.0, 5)], PACING_STATE)
    none = spark.createDataFrame([], SCHEMA)
    assert rows(pacing_state(none, known, tie="event_id")) == [{"source": "a", "current_interval_s": 4.0, "last_ok_us": 5}]
    stored = spark.createDataFrame([("m", 200, None, None, 3, 9.0)], MIRROR_STATE)
    assert rows(mirror_state(none, stored)) == rows(stored)
    assert rows(mirror_state(none, spark.createDataFrame([], MIRROR_STATE))) == []
