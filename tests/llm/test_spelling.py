"""Spelling variants against edits of every word."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from geoingest.llm import spelling as op
from llm_helpers import documents, frame, plain


def words(rows):
    counts = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if doc_id is not None and h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def expected(rows):
    counts = words(rows)
    form, out = {}, []
    beside = {w: [v for v in counts if near(w, v)] for w in counts}
    for w, others in beside.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        if best is not None and counts[best] >= 10 * counts[w]:
            form[w] = best
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(beside[w]), counts.get(form.get(w))))
    return sorted(out, key=repr)


COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def corpus(seed=1, n=80):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcdeé") for _ in range(rng.randrange(7, 15))) for _ in range(12)]
    rows = []
    for i in range(n):
        text = []
        for _ in range(120):
            w = base[min(int(rng.expovariate(0.7)), 11)]
            for _ in range(rng.choice([0] * 12 + [1, 1, 2])):
                at = rng.randrange(len(w))
                w = rng.choice([w[:at] + w[at + 1 :], w[:at] + "x" + w[at:], w[:at] + "y" + w[at + 1 :]])
            text.append(rng.choice([w, w.upper(), w + ",", w + "1"]))
        rows.append((i, " ".join(text), "en", "s", 0))
    return rows


def test_forms_and_roots(spark):
    rows = corpus()
    got = plain(op.spelling_variants(frame(spark, rows).repartition(5)).select(COLUMNS))
    assert got == expected(rows)
    assert any(r[1] for r in got) and any(r[1] != r[2] for r in got if r[1])


@pytest.mark.parametrize("tile", [2, 5])
def test_small_tiles(spark, monkeypatch, tile):
    monkeypatch.setattr(op, "TILE", tile)
    rows = corpus(2, 40)
    assert plain(op.spelling_variants(frame(spark, rows)).select(COLUMNS)) == expected(rows)


@settings(max_examples=200, deadline=None)
@given(st.sets(st.text("abé", min_size=1, max_size=9), min_size=2, max_size=25), st.sampled_from([1, 64, 1 << 20]))
def test_pairs_of_a_tile(found, at_once):
    kept, op.AT_ONCE = op.AT_ONCE, at_once
    try:
        words_ = sorted(found, key=lambda w: hash(w))
        i, j = op.near_pairs(words_)
        got = sorted(zip(i.tolist(), j.tolist()))
    finally:
        op.AT_ONCE = kept
    assert got == [(a, b) for a in range(len(words_)) for b in range(a + 1, len(words_)) if near(words_[a], words_[b])]


def test_words_that_share_a_half_with_a_third_of_all(spark, monkeypatch):
    monkeypatch.setattr(op, "TILE", 16)
    rng = random.Random(4)
    crowd = {"prefix" + "".join(rng.choice("ab") for _ in range(6)) for _ in range(60)}
    rows = [(i, " ".join([*crowd, *crowd, "otherword otherword"]), "en", "s", 0) for i in range(2)]
    assert plain(op.spelling_variants(frame(spark, rows)).select(COLUMNS)) == expected(rows)


def test_very_long_words(spark):
    long = "ab" * 30_000
    rows = [(i, f"{long} {long}c {long[:500]}x{long[500:]} short {long[:-1]}d", "en", "s", 0) for i in range(40, 43)]
    assert plain(op.spelling_variants(frame(spark, rows)).select(COLUMNS)) == expected(rows)


def test_awkward_rows(spark):
    rows = documents()
    assert plain(op.spelling_variants(frame(spark)).select(COLUMNS)) == expected(rows)
    assert op.spelling_variants(frame(spark, [])).count() == 0
    odd = frame(spark).select("*", *[F.lit("x").alias(c) for c in ("id", "word", "n", "key", "form")])
    assert plain(op.spelling_variants(odd).select(COLUMNS)) == expected(rows)
