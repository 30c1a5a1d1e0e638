"""Benchmark passages against a plain search of every window in every text."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from geoingest.llm import decontaminate as op
from llm_helpers import DOCS, documents, frame, plain, prose

ITEMS = "item_id long, text string"


def words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def expected(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(len(w), 10)
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add("" if item is None else str(item))
    out = []
    for row in docs:
        w, hit, held = words(row[1]), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit |= set(range(i, i + n))
                    held |= windows[tuple(w[i : i + n])]
        out.append((row[0], len(w), len(hit), len(held), hashlib.sha256(",".join(sorted(held)).encode()).hexdigest()))
    return sorted(out, key=repr)


def found(df):
    n_hit = F.expr("aggregate(spans, 0L, (n, x) -> n + x.end - x.start)")
    return plain(df.select("doc_id", "n_words", n_hit, "n_items", "items_sha256"))


def passages(docs):
    """Items cut from the texts, long and short, shared by several items, and some that occur nowhere."""
    rng = random.Random(3)
    texts = [words(t) for _, t, *_ in docs if t and len(words(t)) > 40]
    items = [(i, " ".join(rng.choice(texts)[5 : 5 + n])) for i, n in enumerate([1, 2, 3, 5, 9, 10, 11, 14, 25, 30])]
    items += [(20, items[8][1].upper().replace(" ", ", ")), (100, items[8][1]), (21, prose(999, 40)), (22, items[7][1])]
    return items + [(30, None), (31, ""), (32, " ?! "), (None, items[9][1]), (33, "über schön straße"), (8, "no such words at all here")]


@pytest.mark.parametrize("short", [False, True])
def test_every_passage_and_no_other(spark, short):
    rows = documents()
    items = [x for x in passages(rows) if short or len(words(x[1])) >= 9 or not words(x[1])]
    got = op.contaminated(frame(spark).repartition(5), spark.createDataFrame(items, ITEMS))
    assert found(got) == expected(rows, items)
    assert any(r[2] for r in expected(rows, items)) and any(not r[2] for r in expected(rows, items))


def test_many_random_texts(spark):
    rng = random.Random(5)
    letters = "a b c".split()
    rows = [(i, " ".join(rng.choice(letters) for _ in range(rng.randrange(60))), "en", "s", 0) for i in range(300)]
    items = [(i, " ".join(rng.choice(letters) for _ in range(rng.randrange(1, 16)))) for i in range(25)]
    got = op.contaminated(frame(spark, rows), spark.createDataFrame(items, ITEMS))
    assert found(got) == expected(rows, items)


def test_spans_are_runs_of_hit_words(spark):
    passage = prose(1, 12)
    rows = [(1, f"one two {passage} three {passage} {passage}", "en", "s", 0)]
    got = op.contaminated(frame(spark, rows), spark.createDataFrame([(1, passage)], ITEMS)).first()
    assert [tuple(s) for s in got["spans"]] == [(2, 14), (15, 39)]


@pytest.mark.parametrize("length", range(1, 11))
def test_shared_windows_share_a_fingerprint(length):
    rng = np.random.default_rng(length)
    text = [b"%d" % x for x in rng.integers(0, 4, 200)]
    hashes = np.array([xxhash.xxh64_intdigest(w) for w in text], np.uint64)
    keys, first, last = op.winnowed(hashes, length)
    assert (first[1:] == last[:-1] + 1).all() and first[0] == 0 and last[-1] == len(text) - length
    whole = {w: k for k, a, z in zip(keys, first, last) for w in range(a, z + 1)}
    for w in range(len(text) - length + 1):
        assert list(op.winnowed(hashes[w : w + length], length)[0]) == [whole[w]]


def test_a_passage_in_a_third_of_all_documents(spark):
    passage = prose(2, 30)
    rows = [(i, prose(i, 20) + (" " + passage if i % 3 == 0 else ""), "en", "s", 0) for i in range(900)]
    items = [(i, passage) for i in range(200)] + [(300 + i, prose(i, 15)) for i in range(50)]
    got = op.contaminated(frame(spark, rows).repartition(8), spark.createDataFrame(items, ITEMS))
    assert found(got) == expected(rows, items)


def test_without_broadcasts_and_with_a_full_bitmap(spark, monkeypatch):
    rows = documents()
    items = passages(rows)
    monkeypatch.setattr(op, "broadcast_within", lambda df, size: df.hint("merge"))
    monkeypatch.setattr(op, "_bitmap", lambda keys: np.full(2, 2**64 - 1, np.uint64))
    assert found(op.contaminated(frame(spark), spark.createDataFrame(items, ITEMS))) == expected(rows, items)


def test_empty_tables_and_clashing_columns(spark):
    items = spark.createDataFrame(passages(documents()), ITEMS)
    assert op.contaminated(spark.createDataFrame([], DOCS), items).count() == 0
    got = op.contaminated(frame(spark), spark.createDataFrame([], ITEMS))
    assert found(got) == expected(documents(), [])
    odd = frame(spark).select("*", *[F.lit("x").alias(c) for c in ("row", "place", "m", "spans", "held", "key", "n_items", "start")])
    got = op.contaminated(odd, items)
    assert found(got) == expected(documents(), passages(documents()))
    assert {"row", "place", "m", "held", "key", "start"} <= set(got.columns)
