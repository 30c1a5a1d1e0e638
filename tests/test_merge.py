from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from geoingest import dry_run, reject_invalid, row_outcomes, soft_delete_entities, upsert_entities
from geoingest.operators.merge import DO_NOTHING
from geoingest.schemas import ENTITY, ENTITY_TABLE
from helpers import at, rows

T1, T2, T3 = "2024-01-01 00:00:00", "2024-01-02 00:00:00", "2024-01-03 00:00:00"


def entities(spark, *items):
    """(source_id, attrs, other fields) in input order, all of source ``s``."""
    data = []
    for i, (sid, attrs, *rest) in enumerate(items):
        more = rest[0] if rest else {}
        data.append(
            (
                more.get("entity_type", "station"), more.get("source", "s"), sid, more.get("geom", (50.0, 30.0)),
                attrs if isinstance(attrs, (str, type(None))) else json.dumps(attrs), more.get("country"),
                more.get("confidence", 1.0), i,
            )
        )
    return spark.createDataFrame(data, ENTITY)


def empty(spark):
    return spark.createDataFrame([], ENTITY_TABLE)


def by_id(df):
    return {r["source_id"]: {**r, "attrs": json.loads(r["attrs"])} for r in rows(df)}


def test_insert_then_update(spark):
    table, out = upsert_entities(empty(spark), entities(spark, ("a", {"x": 1, "y": 2}, {"country": "UA"})), at(T1))
    (row,) = by_id(table).values()
    assert row["geom"] == '{"type":"Point","coordinates":[30.0,50.0]}'
    assert str(row["created_at"]) == str(row["last_seen_at"]) == T1 and row["removed_at"] is None
    assert rows(out) == [{"source": "s", "source_id": "a", "n_inserted": 1, "n_updated": 0, "n_skipped": 0}]
    again = entities(spark, ("a", {"y": None, "z": 3}, {"geom": None, "confidence": None, "entity_type": "stop"}))
    table, out = upsert_entities(table, again, at(T2))
    (row,) = by_id(table).values()
    assert row["attrs"] == {"x": 1, "y": None, "z": 3}
    assert row["geom"] is None and row["confidence"] is None and row["entity_type"] == "stop"
    assert row["bbox_country"] == "UA"
    assert (str(row["created_at"]), str(row["last_seen_at"])) == (T1, T2)
    assert rows(out)[0]["n_updated"] == 1


def test_repeated_upsert_changes_only_last_seen(spark):
    src = entities(spark, ("a", {"x": 1}), ("b", {}), ("a", {"y": 1}))
    once, _ = upsert_entities(empty(spark), src, at(T1))
    twice, out = upsert_entities(once, src, at(T2))
    drop = lambda t: {k: {c: v for c, v in r.items() if c != "last_seen_at"} for k, r in by_id(t).items()}
    assert drop(once) == drop(twice)
    assert sum(r["n_inserted"] for r in rows(out)) == 0 and sum(r["n_updated"] for r in rows(out)) == 3


def test_untouched_rows_stay(spark):
    table, _ = upsert_entities(empty(spark), entities(spark, ("a", {"x": 1}), ("b", {"x": 2})), at(T1))
    table, _ = upsert_entities(table, entities(spark, ("a", {"x": 3}), ("c", {})), at(T2))
    got = by_id(table)
    assert set(got) == {"a", "b", "c"} and got["b"]["attrs"] == {"x": 2} and str(got["b"]["last_seen_at"]) == T1


def test_soft_delete_and_reactivation(spark):
    table, _ = upsert_entities(empty(spark), entities(spark, ("a", {}), ("b", {})), at(T1))
    keys = spark.createDataFrame([("s", "a"), ("s", "a"), ("s", "none"), (None, "b")], "source string, source_id string")
    gone, changed = soft_delete_entities(table, keys, at(T2))
    assert [r["source_id"] for r in rows(changed)] == ["a"]
    assert {k: r["removed_at"] and str(r["removed_at"]) for k, r in by_id(gone).items()} == {"a": T2, "b": None}
    again, changed = soft_delete_entities(gone, keys, at(T3))
    assert rows(changed) == [] and str(by_id(again)["a"]["removed_at"]) == T2
    back, _ = upsert_entities(gone, entities(spark, ("a", {"n": 1})), at(T3))
    assert by_id(back)["a"]["removed_at"] is None
    kept, _ = upsert_entities(gone, entities(spark, ("a", {"n": 1})), at(T3), soft_delete=False)
    assert str(by_id(kept)["a"]["removed_at"]) == T2
    with pytest.raises(ValueError):
        soft_delete_entities(table, keys, at(T2), enabled=False)


def test_insert_only(spark):
    table, _ = upsert_entities(empty(spark), entities(spark, ("a", {"x": 1})), at(T1))
    src = entities(spark, ("a", {"x": 2}), ("b", {"x": 3}), ("b", {"x": 4}))
    table, out = upsert_entities(table, src, at(T2), on_conflict=DO_NOTHING)
    got = by_id(table)
    assert got["a"]["attrs"] == {"x": 1} and str(got["a"]["last_seen_at"]) == T1 and got["b"]["attrs"] == {"x": 3}
    assert {r["source_id"]: (r["n_inserted"], r["n_skipped"]) for r in rows(out)} == {"a": (0, 1), "b": (1, 1)}
    with pytest.raises(ValueError):
        upsert_entities(table, src, at(T2), on_conflict="DO_MAYBE")


def test_row_outcomes(spark):
    table, _ = upsert_entities(empty(spark), entities(spark, ("a", {})), at(T1))
    src = entities(spark, ("a", {}), ("b", {}), ("b", {}), ("a", {}), ("c", {}))
    got = [r["outcome"] for r in rows(row_outcomes(table, src).orderBy("_pos"))]
    assert got == ["updated", "inserted", "updated", "updated", "inserted"]
    got = [r["outcome"] for r in rows(row_outcomes(table, src, on_conflict=DO_NOTHING).orderBy("_pos"))]
    assert got == ["skipped", "inserted", "skipped", "skipped", "inserted"]


def test_rejects_and_dry_run(spark):
    src = entities(
        spark, ("a", {}), (None, {}), ("b", {}, {"entity_type": None}), ("c", "[1]"), ("d", "{bad"), ("e", None),
        ("f", {}, {"source": None}),
    )
    good, bad = reject_invalid(src)
    assert [r["source_id"] for r in rows(good)] == ["a"]
    reasons = [r["reason"] for r in rows(bad.orderBy("_pos"))]
    assert reasons[:2] == ["null value in column source_id", "null value in column entity_type"]
    assert reasons[2:5] == ["attrs is not a JSON object"] * 3 and reasons[5] == "null value in column source"
    assert {r["outcome"] for r in rows(dry_run(src))} == {"inserted"}


def _replay(table: dict, items: list[dict], now: str, mode: str) -> None:
    """Row by row, what a keyed table does."""
    for e in items:
        old = table.get(e["source_id"])
        if old is None:
            table[e["source_id"]] = {**e, "attrs": dict(e["attrs"]), "created": now, "seen": now, "n_ins": 1, "n_again": 0}
            continue
        old["n_again"] += 1
        if mode == DO_NOTHING:
            continue
        old["attrs"].update(e["attrs"])
        old.update(entity_type=e["entity_type"], geom=e["geom"], confidence=e["confidence"], seen=now)
        if e["country"] is not None:
            old["country"] = e["country"]


@pytest.mark.parametrize("mode", ["DO_UPDATE", DO_NOTHING])
@pytest.mark.parametrize("seed", [1, 2])
def test_batches_equal_a_sequential_replay(spark, seed, mode):
    """Random batches in which one key holds a third of all rows."""
    rng = random.Random(seed)
    table, expected = empty(spark), {}
    for now in (T1, T2):
        items = [
            {
                "source_id": "hot" if rng.random() < 0.34 else f"k{rng.randrange(30)}",
                "attrs": {f"a{rng.randrange(6)}": rng.choice([None, 1, "x", {"n": i}]) for _ in range(rng.randrange(4))},
                "entity_type": rng.choice(["p", "q"]), "geom": rng.choice([None, (1.5, 2.5)]),
                "confidence": rng.choice([None, 0.5]), "country": rng.choice([None, "UA", "BY"]),
            }
            for i in range(400)
        ]
        for old in expected.values():
            old.update(n_ins=0, n_again=0)
        _replay(expected, items, now, mode)
        src = entities(spark, *[(e["source_id"], e["attrs"], e) for e in items]).repartition(8)
        merged, out = upsert_entities(table, src, at(now), on_conflict=mode)
        counts = {r["source_id"]: (r["n_inserted"], r["n_updated"] + r["n_skipped"]) for r in rows(out)}
        table = spark.createDataFrame(merged.collect(), ENTITY_TABLE)
        touched = {e["source_id"] for e in items}
        assert counts == {k: (expected[k]["n_ins"], expected[k]["n_again"]) for k in touched}
    got = by_id(table)
    assert set(got) == set(expected)
    for key, e in expected.items():
        row = got[key]
        assert row["attrs"] == e["attrs"] and row["entity_type"] == e["entity_type"]
        assert (row["geom"] is None) == (e["geom"] is None) and row["confidence"] == e["confidence"]
        assert row["bbox_country"] == e["country"]
        assert (str(row["created_at"]), str(row["last_seen_at"])) == (e["created"], e["seen"])


def test_bucketed_target_is_not_shuffled(spark):
    from geoingest import save_bucketed

    many = [(f"k{i}", {"i": i}) for i in range(200)]
    table, _ = upsert_entities(empty(spark), entities(spark, *many), at(T1))
    save_bucketed(table, "entities_bucketed", 8)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        src = entities(spark, *many[:50], *[(f"k{i}", {"j": i}, {"source": f"s{i % 2}"}) for i in range(20)])
        merged, _ = upsert_entities(spark.read.table("entities_bucketed"), src, at(T2))
        plan = merged._jdf.queryExecution().executedPlan().toString()
        # One shuffle per attribute, one per key; neither the join nor the target adds another.
        assert plan.count("Exchange hashpartitioning") == 2 and "FullOuter" in plan
        assert merged.count() == 220
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.sql("DROP TABLE entities_bucketed")
