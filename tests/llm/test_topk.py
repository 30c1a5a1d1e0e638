from __future__ import annotations

import math
from itertools import groupby

import numpy as np
import pytest
from pyspark.sql import functions as F

from geoingest.llm import topk as op
from llm_helpers import plain

SCHEMA = "vec_id long, embedding array<float>, label int"


def scaled(v):
    return [math.floor(1024 * float(np.float32(x))) for x in v]


def slow(rows, k=op.K):
    good = [(i, scaled(v)) for i, v, _ in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for own, (qi, qv) in enumerate(good):
        if qi % 100 == 0:
            scores = sorted((-sum(a * b for a, b in zip(qv, v)), i) for at, (i, v) in enumerate(good) if at != own)[:k]
            out += [(qi, rank, i, -s) for rank, (s, i) in enumerate(scores, 1)]
    return sorted(out, key=repr)


def vectors(n, dims, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, dims))
    return [(i, (centres[i % 5] + 0.3 * rng.normal(size=dims)).astype(np.float32).tolist(), i % 5) for i in range(n)]


def got(spark, rows, **kw):
    v = op.scaled(spark.createDataFrame(rows, SCHEMA), "vec_id", "embedding")
    return plain(op.search(v, v.where("vec_id % 100 = 0"), **kw))


@pytest.mark.parametrize("shard_rows,shard_bytes,few", [(50_000, 64 << 20, 512), (120, 1 << 12, 30), (7, 1 << 10, 1)])
def test_exact(spark, monkeypatch, shard_rows, shard_bytes, few):
    monkeypatch.setattr(op, "SHARD_ROWS", shard_rows)
    monkeypatch.setattr(op, "SHARD_BYTES", shard_bytes)
    monkeypatch.setattr(op, "FEW", few)
    rows = vectors(420, 12, 1)
    assert got(spark, rows) == slow(rows)


def test_awkward_vectors(spark):
    rows = vectors(150, 4, 2)
    rows += [(200, None, 0), (201, [1.0, None, 1.0, 1.0], 0), (202, [float("nan")] * 4, 0), (203, [float("inf"), 0.0, 0.0, 0.0], 0)]
    rows += [(None, [1.0] * 4, 0), (300, [], 0), (301, [9.0], 0), (302, [0.0] * 9 + [1.0], 0), (400, [0.0] * 4, 0), (-100, [-1.0, 2.0, 0.5, 0.0], 0)]
    rows += [(500, [1.0, 1.0, 1.0, 1.0], 0)] * 3 + [(501 + i, [1.0, 1.0, 1.0, 1.0], 0) for i in range(20)]
    assert got(spark, rows) == slow(rows)


def test_search_stops_early_and_stays_exact():
    rng = np.random.default_rng(5)
    x = np.where(rng.random((4000, 16)) < 0.1, rng.integers(200, 1000, (4000, 16)), rng.integers(-20, 20, (4000, 16)))
    index = op.Index(np.arange(4000), np.arange(4000), x)
    q = np.array([500, 300] + [2] * 14)
    assert len(index._possible(-1, q, 10)) <= op.FEW
    ids, scores = index.search(3, q, 10)
    exact = x @ q
    assert list(zip((-scores).tolist(), ids.tolist())) == sorted((-s, i) for i, s in enumerate(exact.tolist()) if i != 3)[:10]


def test_scores_beyond_64_bits_are_held():
    index = op.Index(np.arange(3), np.arange(3), np.array([[2**40], [-(2**40)], [1]]))
    ids, scores = index.search(9, np.array([2**40]), 3)
    assert ids.tolist() == [0, 2, 1] and scores.tolist() == [2**63 - 1, 2**40, -(2**63)]


def test_few_rows_and_empty_table(spark):
    assert got(spark, []) == []
    assert got(spark, [(0, [1.0], 0)]) == []
    assert got(spark, [(0, [1.0], 0), (1, [2.0], 0)]) == [(0, 1, 1, 2 * 1024 * 1024)]
    ranks = got(spark, vectors(205, 3, 4))
    repeated = got(spark, [(100, [1.0, 2.0], 0)] * 3 + [(5, [1.0, 1.0], 0)])
    assert repeated == slow([(100, [1.0, 2.0], 0)] * 3 + [(5, [1.0, 1.0], 0)]) and len(repeated) == 9
    assert all([r[1] for r in sorted(g, key=lambda r: r[1])] == list(range(1, 11)) for _, g in groupby(ranks, key=lambda r: r[0]))


def test_clashing_columns(spark):
    df = spark.createDataFrame(vectors(120, 3, 6), SCHEMA).select("*", *[F.lit(1).alias(c) for c in ("vector", "shard", "mark", "rank")])
    v = op.scaled(df, "vec_id", "embedding")
    assert op.search(v, v.where("vec_id % 100 = 0")).count() == 20


def test_long_vectors_and_a_single_very_long_one(spark):
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=1024).astype(np.float32).tolist(), 0) for i in range(90, 130)] + [(200, rng.normal(size=20_000).astype(np.float32).tolist(), 0)]
    assert got(spark, rows) == slow(rows)
