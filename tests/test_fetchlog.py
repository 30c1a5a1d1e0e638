from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from geoingest import (
    account_health,
    assign_round_robin,
    backoff_interval,
    mirror_health,
    rank_mirrors,
    rate_stats,
    select_response,
    status_count_map,
    write_rate_stats,
)
from geoingest.operators.ordering import with_row_index
from helpers import at, rows

T0 = datetime(2024, 1, 1)


def log(spark, *events):
    """(source, seconds, status) in the order of their ids."""
    data = [(s, T0 + timedelta(seconds=t), status, i) for i, (s, t, status) in enumerate(events)]
    return spark.createDataFrame(data, "source string, ts timestamp, status int, event_id long")


@pytest.mark.parametrize(
    ("attempts", "won", "lost"),
    [
        ([(1, 0, 200)], (1, 0), None),
        ([(1, 0, 500), (1, 1, 200)], (1, 1), None),
        ([(1, 0, 500), (1, 1, 404), (2, 0, 503), (2, 1, 302)], (2, 1), None),
        ([(2, 0, 200), (1, 1, 200)], (1, 1), None),
        ([(i, 0, 500) for i in (1, 2, 3)], None, "all strategies exhausted for u"),
        ([(1, 0, 500), (4, 0, 200), (5, 0, 200)], (4, 0), None),
        ([(1, 0, None)], None, "all strategies exhausted for u"),
    ],
)
def test_select_response(spark, attempts, won, lost):
    df = spark.createDataFrame(
        [("u", a, r, s, b"body") for a, r, s in attempts],
        "url string, attempt int, strategy_rank int, status int, body binary",
    )
    chosen, exhausted = select_response(df)
    assert [(r["attempt"], r["strategy_rank"]) for r in rows(chosen)] == ([won] if won else [])
    details = [r["detail"] for r in rows(exhausted)]
    assert (details == []) if lost is None else details[0].endswith(lost)


def test_attempts_beyond_a_limit_leave_the_url_exhausted(spark):
    kind = "url string, attempt int, strategy_rank int, status int, body binary"
    df = spark.createDataFrame([("u", 1, 0, 500, b"x"), ("u", 4, 0, 200, b"x"), ("v", 5, 0, 200, b"x"), ("w", 2, 0, 200, b"x")], kind)
    chosen, exhausted = select_response(df, max_retries=2)
    assert [r["url"] for r in rows(chosen)] == ["w"] and sorted(r["url"] for r in rows(exhausted)) == ["u", "v"]
    chosen, exhausted = select_response(df.unionByName(df))
    assert sorted((r["url"], r["attempt"]) for r in rows(chosen)) == [("u", 4), ("v", 5), ("w", 2)] and rows(exhausted) == []


def test_backoff_interval_keeps_the_order_of_equal_times(spark):
    """4,000 events of one moment in several partitions: only the tie orders them."""
    events = [("s", 0, 503 if i < 6 else 200) for i in range(3999)] + [("s", 40, 200)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = backoff_interval(log(spark, *events), base_interval=0.5, tie="event_id")
        assert rows(out)[0]["current_interval_s"] == _sequential(events, 0.5)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def _sequential(events, base):
    """One source, event by event."""
    interval, last_ok = base, events[0][1]
    for _, t, status in events:
        if status in (429, 500, 502, 503, 504):
            interval = min(60.0, interval * 2)
            continue
        if t - last_ok > 30:
            interval = max(base, interval / 2)
        last_ok = t
    return interval


@pytest.mark.parametrize(
    ("events", "interval"),
    [
        ([("s", 0, 503)], 1.0),
        ([("s", 0, 429)], 1.0),
        ([("s", i, 503) for i in range(20)], 60.0),
        ([("s", 0, 503), ("s", 31, 200)], 0.5),
        ([("s", 0, 503), ("s", 30, 200)], 1.0),
        ([("s", 0, 503), ("s", 5, 503), ("s", 40, 404), ("s", 71, 0)], 0.5),
        ([("s", 0, 200), ("s", 100, 200)], 0.5),
        ([*[("s", i, 503) for i in range(9)], ("s", 100, 200), ("s", 140, 503)], 60.0),
    ],
)
def test_backoff_interval(spark, events, interval):
    (row,) = rows(backoff_interval(log(spark, *events), base_interval=0.5, tie="event_id"))
    assert row["current_interval_s"] == interval


def test_backoff_equals_a_sequential_fold_of_a_crowded_source(spark):
    rng = random.Random(7)
    events, clock = [], 0.0
    for _ in range(6000):
        clock += rng.choice([0.5, 3.0, 20.0, 31.0])
        source = "hot" if rng.random() < 0.6 else f"s{rng.randrange(5)}"
        events.append((source, clock, rng.choice([200, 200, 404, 503, 429, 500])))
    df = log(spark, *events).repartition(8)
    got = {r["source"]: r["current_interval_s"] for r in rows(backoff_interval(df, base_interval=0.7, tie="event_id"))}
    expected = {s: _sequential([e for e in events if e[0] == s], 0.7) for s in {e[0] for e in events}}
    assert got == pytest.approx(expected)
    plan = backoff_interval(df, tie="event_id")._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning(source" in plan


def test_rate_stats(spark, tmp_path):
    df = log(spark, ("s", 0, 200), ("s", 1, 200), ("s", 2, 429), ("t", 0, 200))
    assert {r["source"]: r["by_status"] for r in rows(status_count_map(df))} == {"s": {"200": 2, "429": 1}, "t": {"200": 1}}
    stats = rate_stats(df, rate_per_sec=2.0, tie="event_id", now=at("2024-01-01 10:00:00"))
    got = {r["source"]: (r["current_interval_s"], r["backoff_active"]) for r in rows(stats)}
    assert got == {"s": (1.0, True), "t": (0.5, False)}
    write_rate_stats(stats, str(tmp_path / "stats"))
    assert {r["ts"] for r in rows(spark.read.json(str(tmp_path / "stats")))} == {"2024-01-01T10:00:00Z"}


def mirrors(spark, *events):
    data = [(m, T0 + timedelta(seconds=t), status, i) for i, (m, t, status) in enumerate(events)]
    return spark.createDataFrame(data, "mirror string, ts timestamp, status int, event_id long")


def test_mirror_health(spark):
    df = mirrors(
        spark, ("a", 0, 200), ("a", 1, 503), ("a", 2, None), ("a", 3, 404),
        ("b", 0, 503), ("b", 1, 200), ("c", 5, 406), ("d", 0, 304), ("d", 1, 404),
    )
    got = {r["mirror"]: r for r in rows(mirror_health(df, at("2024-01-01 00:00:10")))}
    a, b, c, d = (got[m] for m in "abcd")
    assert (a["last_status"], a["consecutive_failures"], a["cooldown_remaining_s"]) == (404, 3, 52.0)
    assert a["last_success_ts"] == T0 and a["last_attempt_ts"] == T0 + timedelta(seconds=3)
    assert (b["last_status"], b["consecutive_failures"], b["cooldown_remaining_s"]) == (200, 0, 0.0)
    assert (c["last_success_ts"], c["cooldown_remaining_s"]) == (None, 115.0)
    assert (d["consecutive_failures"], d["cooldown_remaining_s"]) == (2, 0.0)


def test_mirror_choice(spark):
    df = mirrors(spark, ("a", 0, 200), ("b", 5, 200), ("c", 9, 200), ("c", 10, 503))
    now = at("2024-01-01 00:00:12")
    order = lambda *names: [r["mirror"] for r in rows(rank_mirrors(mirror_health(df, now), names).orderBy("rank"))]
    assert order("a", "b", "c") == ["b", "a"]
    assert order("c") == ["c"]
    assert order("new", "a") == ["a", "new"]
    ties = mirrors(spark, ("a", 0, 503), ("b", 0, 503))
    ranked = rank_mirrors(mirror_health(ties, now), ["b", "a"]).orderBy("rank")
    assert [(r["mirror"], r["usable"]) for r in rows(ranked)] == [("b", False), ("a", False)]


def test_account_health(spark):
    data = [("x", 0, "flood", 100.0), ("x", 1, "ok", None), ("y", 0, "error", None), ("z", 0, "flood", None)]
    usage = spark.createDataFrame(
        [(a, T0 + timedelta(seconds=t), o, s) for a, t, o, s in data],
        "account string, ts timestamp, outcome string, flood_seconds double",
    )
    for after, cooling in [("00:00:50", True), ("00:01:39", True), ("00:01:40", False), ("00:01:50", False)]:
        got = {r["account"]: r for r in rows(account_health(usage, at(f"2024-01-01 {after}")))}
        assert got["x"]["is_cooling"] is cooling
    assert (got["x"]["success"], got["x"]["fail"]) == (1, 1)
    assert (got["y"]["fail"], got["y"]["is_cooling"]) == (1, False) and got["z"]["is_cooling"] is False


def test_row_index_over_sparse_and_dense_keys(spark):
    keys = [*range(70000), 2**20, 2**33, 2**33 + 1, 2**50, 2**62, -5, -(2**40)]
    df = spark.createDataFrame([(k,) for k in keys], "k long").repartition(8)
    got = {r["k"]: r["_idx"] for r in with_row_index(df, "k").collect()}
    assert got == {k: i for i, k in enumerate(sorted(keys))}


@pytest.mark.parametrize("limit", [100_000, 1])
def test_round_robin(spark, monkeypatch, limit):
    monkeypatch.setattr("geoingest.operators.accounts.MAX_BROADCAST_ACCOUNTS", limit)
    work = spark.range(0, 50, 1).select((F.col("id") * 3).alias("_pos"))
    pool = spark.createDataFrame(
        [("a", 10, False), ("b", 20, True), ("c", 30, False), ("d", 5, False)],
        "account string, account_rank long, is_cooling boolean",
    )
    got = [r["account"] for r in rows(assign_round_robin(work, pool).orderBy("_pos"))]
    assert got == (["d", "a", "c"] * 17)[:50]
    with pytest.raises(ValueError):
        assign_round_robin(work, pool.withColumn("is_cooling", F.lit(True)))
