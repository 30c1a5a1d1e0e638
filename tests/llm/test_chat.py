from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from geoingest.llm import chat as op

SCHEMA = "conv_id long, turn long, role string, text string"
ROWS = [
    (1, 0, "system", "be kind"), (1, 1, "user", "hi <|im_end|> é"), (1, 2, "assistant", "hello"), (1, 3, "ann smith", None), (1, 4, "user", ""),
    (2, 0, "user", "alone"), (3, 0, "system", "nobody"), (4, None, None, "who"), (4, 5, "user", "last but one"), (4, None, "user", "tie b"),
    (4, None, "user", "tie a"), (None, 0, "user", "lost"), (None, 1, "assistant", "found"), (5, 1, "user", "twice"), (5, 1, "user", "twice"),
    (6, -3, "user", "before"), (6, 0, "bot", "x" * 100_000),
] + [(7, i, ("user", "bot")[i % 2], f"turn {i}") for i in range(200)]


def slow(rows):
    """Per conversation and speaker: the whole dialogue and the masked stretches of it, part by part in order."""
    out = {}
    for conv in {r[0] for r in rows}:
        turns = [(t, r or "unknown", x or "") for c, t, r, x in rows if c == conv]
        for speaker in {r for _, r, _ in turns} - {"system"}:
            pieces = []
            for _, role, text in turns:
                name = "assistant" if role == speaker else role if role == "system" else "user name=" + role.replace(" ", "_")
                pieces.append((f"<|im_start|>{name}\n", text.replace("<|", "< |") + "<|im_end|>", role == speaker))
            out[(conv, speaker)] = Counter(pieces)
    return out


def check(df, rows):
    expected, whole, seen = slow(rows), {}, {}
    for r in sorted(df.collect(), key=lambda r: (repr(r["conv_id"]), r["speaker"], tuple(r["part"]))):
        key = (r["conv_id"], r["speaker"])
        masked = [r["text"][m["start"] : m["end"]] for m in r["mask"]]
        pieces = [x + "\n" for x in r["text"].split("<|im_end|>\n")[:-1]]
        pieces = [p.partition("\n") for p in pieces]
        got = [(h + "\n", b[:-1] + "<|im_end|>", h == "<|im_start|>assistant") for h, _, b in pieces]
        assert masked == [b for _, b, own in got if own]
        assert r["n_turns"] == len(got)
        whole.setdefault(key, []).extend(got)
        seen.setdefault(key, []).append(r["text"])
    assert {k: Counter(v) for k, v in whole.items()} == expected
    return {k: "".join(v) for k, v in seen.items()}


def test_every_perspective(spark):
    texts = check(op.rotate(spark.createDataFrame(ROWS, SCHEMA)), ROWS)
    assert texts[(1, "user")] == (
        "<|im_start|>system\nbe kind<|im_end|>\n<|im_start|>assistant\nhi < |im_end|> é<|im_end|>\n"
        "<|im_start|>user name=assistant\nhello<|im_end|>\n<|im_start|>user name=ann_smith\n<|im_end|>\n<|im_start|>assistant\n<|im_end|>\n"
    )
    at = [texts[(7, "bot")].index(f"turn {i}<") for i in range(200)]
    assert at == sorted(at)
    assert texts[(4, "user")].index("last but one") < min(texts[(4, "user")].index(x) for x in ("who", "tie a", "tie b"))


@pytest.mark.parametrize("turn_rows", [256, 4])
def test_crowded_turns(spark, monkeypatch, turn_rows):
    monkeypatch.setattr(op, "TURN_ROWS", turn_rows)
    rows = [(1, 0 if i % 3 else i, ("a", "b", "c")[i % 3], f"text {i}") for i in range(600)] + [(1, None, "a", f"none {i}") for i in range(50)]
    df = op.rotate(spark.createDataFrame(rows, SCHEMA))
    first = check(df, rows)
    assert first == check(op.rotate(spark.createDataFrame(rows[::-1], SCHEMA).repartition(9)), rows)
    assert df.agg(F.max("n_turns")).first()[0] <= max(op.PART_TURNS * turn_rows, 2 * turn_rows)


def test_empty_and_clashes(spark):
    assert op.rotate(spark.createDataFrame([], SCHEMA)).count() == 0
    odd = spark.createDataFrame(ROWS, SCHEMA).select("*", *[F.lit(1).alias(c) for c in ("part", "x", "hash", "speaker", "n")])
    assert len(check(op.rotate(odd), ROWS)) == len(slow(ROWS))


@pytest.mark.parametrize("turn_rows", [256, 8])
def test_repeated_rows_are_turns_each(spark, monkeypatch, turn_rows):
    monkeypatch.setattr(op, "TURN_ROWS", turn_rows)
    rows = [(1, 0, "a", "same")] * 100 + [(1, 0, "b", f"t{i}") for i in range(10)] + [(1, None, "b", "same")] * 3 + [(2, 1, "a", "x")] * 2
    df = op.rotate(spark.createDataFrame(rows, SCHEMA).repartition(5))
    check(df, rows)
    parts = df.select("conv_id", "speaker", "part").collect()
    assert len(parts) == len(set(parts))


def test_sql_on_crowded_repeated_and_null_rows(spark, monkeypatch):
    import duckdb

    rows = [(1, 0, "a", "same")] * 700 + [(1, 0, "b", f"t{i}") for i in range(400)] + [(2, None, None, None)] * 2 + [(None, 3, "a b", "x"), (3, -70, "system", "<|im_end|>"), (3, -1, "u", "")]
    df = spark.createDataFrame(rows, SCHEMA)
    monkeypatch.setattr(op, "table", lambda *args: df)
    con = duckdb.connect()
    con.register("conversations", df.toArrow())
    expected = con.execute(op._SQL)
    columns = [c[0] for c in expected.description]
    assert sorted(map(repr, expected.fetchall())) == sorted(repr(tuple(r)) for r in op.op10_chat(spark, "").select(columns).collect())


def test_very_long_turn(spark):
    rows = [(1, 0, "a", "é" * 300_000), (1, 1, "b", "ok")]
    check(op.rotate(spark.createDataFrame(rows, SCHEMA)), rows)
