from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from geoingest.llm import exact_dedup as op
from llm_helpers import DOCS, documents, frame, plain


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), max_size=60))
def test_golomb_code_round_trip(values):
    x = np.array(sorted(values), dtype=np.uint64)
    assert (op.golomb_decode(op.golomb_encode(x)) == x).all()


def test_golomb_code_is_smaller_than_the_hashes():
    x = np.unique(np.random.default_rng(1).integers(0, 2**64, 20_000, dtype=np.uint64))
    assert len(op.golomb_encode(x)) < 0.9 * x.nbytes


def expected(rows):
    groups = defaultdict(list)
    for i, row in enumerate(rows):
        body = (row[1] or "").translate({ord(c): None for c in op.BLANK})
        groups[body].append((-len(row[1] or ""), row[0] is not None, row[0] or 0, i))
    out = []
    for body, members in groups.items():
        best = min(members)
        for n, has_id, doc_id, i in members:
            out.append((rows[i][0], rows[best[3]][0], len(members), i == best[3], hashlib.sha256(body.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("parts", [1, 5])
def test_groups_of_equal_texts(spark, parts):
    got = op.exact_dedup(frame(spark).repartition(parts)).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert plain(got) == expected(documents())


def test_hot_group_and_many_blocks(spark, monkeypatch):
    rows = [(i, "hot text" if i % 3 else f"text {i}", "en", "s", 8) for i in range(6000)]
    got = op.exact_dedup(frame(spark, rows).repartition(16)).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert plain(got) == expected(rows)


def test_empty_table_and_clashing_columns(spark):
    assert op.exact_dedup(frame(spark, [])).count() == 0
    odd = frame(spark).select("*", *[F.lit("x").alias(c) for c in ("kept", "row", "sha", "block", "kind", "bitmap", "suspect")])
    got = op.exact_dedup(odd)
    assert got.where("kept").count() == len({r[4] for r in expected(documents())})
    assert {"row", "sha", "block", "kind", "bitmap", "suspect"} <= set(got.columns)


def test_stage_keeps_one_row_of_each(spark):
    docs = frame(spark)
    got = op.exact_dedup_stage(spark, docs, "")
    assert got.columns == docs.columns and got.count() == len({r[4] for r in expected(documents())})
    assert op.exact_dedup_stage(spark, spark.createDataFrame([], DOCS), "").count() == 0
