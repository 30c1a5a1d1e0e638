"""Weights, scores and draws against plain counting."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from geoingest.llm import importance as op
from llm_helpers import DOCS, documents, frame, plain, prose

ITEMS = "item_id long, text string"
TARGET = [(1, prose(5, 40)), (2, prose(6, 80, "de")), (3, None), (4, ""), (5, "The the THE water")]


def words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def buckets(text):
    w = words(text)
    runs = [" ".join(w[i : i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1)]
    return [zlib.crc32(r.encode()) % 10_000 for r in runs]


def expected(rows, items):
    s, t = (Counter(b for text in texts for b in buckets(text)) for texts in ([r[1] for r in rows], [x[1] for x in items]))
    n_s, n_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (n_s + 10_000) / ((s[b] + 1) * (n_t + 10_000)))) for b in range(10_000)]
    out = []
    for doc_id, text, *_ in rows:
        found = buckets(text)
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in found)
        out.append([doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words(text))])
    enough = sorted((r for r in out if r[5] >= 20), key=lambda r: (-r[3], r[0] is not None, r[0]))
    for rank, row in enumerate(enough[: 5 * len(enough) // 100], 1):
        row[4] = rank
    return sorted((tuple(r[:5]) for r in out), key=repr)


def found(df):
    return plain(df.select("doc_id", "n_features", "weight", "score", "rank"))


@settings(max_examples=150, deadline=None)
@given(st.text(st.sampled_from("aB1é😀 \n-_.\x00"), max_size=40))
def test_buckets_of_features(text):
    n, got = op.buckets_of(text.encode())
    assert n == len(words(text)) and got.tolist() == buckets(text)


@pytest.mark.parametrize("parts", [1, 7])
def test_weights_and_draws(spark, parts):
    rows = documents(120)
    got = op.importance_sample(frame(spark, rows).repartition(parts), spark.createDataFrame(TARGET, ITEMS))
    assert found(got) == expected(rows, TARGET)
    assert sorted(r for *_, r in found(got) if r) == list(range(1, 7))


def test_ties_go_to_the_smaller_id_and_repeats_are_drawn_apart(spark, monkeypatch):
    monkeypatch.setattr(op, "DRAWN", 50)
    monkeypatch.setattr(op, "gumbel", lambda id_, seed: F.lit(0))
    rows = [(i // 2, prose(1, 30), "en", "s", 0) for i in range(40)]
    got = op.importance_sample(frame(spark, rows).repartition(6), spark.createDataFrame(TARGET, ITEMS))
    assert sorted((r, i) for i, *_, r in found(got) if r) == [(k + 1, k // 2) for k in range(20)]


def test_few_documents_draw_none(spark):
    rows = [(i, prose(i, 30), "en", "s", 0) for i in range(19)]
    got = op.importance_sample(frame(spark, rows), spark.createDataFrame(TARGET, ITEMS))
    assert found(got) == expected(rows, TARGET) and got.where("rank IS NOT NULL").count() == 0


def test_empty_tables_and_clashing_columns(spark):
    target = spark.createDataFrame(TARGET, ITEMS)
    assert op.importance_sample(spark.createDataFrame([], DOCS), target).count() == 0
    assert found(op.importance_sample(frame(spark), spark.createDataFrame([], ITEMS))) == expected(documents(), [])
    odd = frame(spark).select("*", *[F.lit("x").alias(c) for c in ("row", "place", "f", "id", "rank", "part", "buckets", "n_words")])
    got = op.importance_sample(odd, target)
    assert found(got) == expected(documents(), TARGET)
    assert {"row", "place", "f", "id", "part", "buckets"} <= set(got.columns)
