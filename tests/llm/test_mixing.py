from __future__ import annotations

import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from geoingest.llm import mixing as op
from llm_helpers import DOCS, documents, frame, plain


def fill(budget, children):
    """Deal step by step: whoever is full leaves its rest to the others. ``children``: name to (cap, weight)."""
    given, open_ = dict.fromkeys(children, 0.0), set(children)
    left = budget
    while open_ and left > 1e-9:
        total = sum(children[c][1] for c in open_)
        full = {c for c in open_ if children[c][0] <= left * children[c][1] / total + 1e-12}
        if not full:
            for c in open_:
                given[c] = left * children[c][1] / total
            break
        for c in full:
            given[c] = children[c][0]
            left -= children[c][0]
        open_ -= full
    return given


def leaf_budgets(leaves, total, epochs, weight):
    """``leaves``: (domain, lang, source) to tokens."""
    def cap(prefix):
        return sum(t for p, t in leaves.items() if p[: len(prefix)] == prefix) * epochs

    out = {(): total}
    for depth in (1, 2, 3):
        nodes = {p[:depth] for p in leaves}
        for parent in {n[:-1] for n in nodes}:
            children = {n: (cap(n), weight(depth, n[-1])) for n in nodes if n[:-1] == parent}
            out |= fill(out[parent], children)
    return {p: int(out[p] + 1e-6) for p in leaves}


def tokens_of(text):
    import re

    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def domain_of(source):
    import re

    m = re.search(r"(\d+)$", source or "")
    return op.DOMAINS[int(m[1]) // 5] if m and int(m[1]) < 20 else "unknown"


def slow_copies(rows):
    leaves, members = defaultdict(int), defaultdict(list)
    for row in rows:
        path = (domain_of(row[3]), row[2] or "unknown", row[3] or "unknown")
        leaves[path] += tokens_of(row[1])
        members[path].append(row)
    weights = {1: op.DOMAIN_WEIGHTS, 2: op.LANG_WEIGHTS, 3: {}}
    dealt = leaf_budgets(leaves, float(sum(leaves.values())), op.MAX_EPOCHS, lambda d, n: weights[d].get(n, 1.0))
    out = []
    for path, docs in members.items():
        epochs = dealt[path] // leaves[path] if leaves[path] else 0
        rest = dealt[path] - epochs * leaves[path]
        keyed = defaultdict(list)
        for row in docs:
            key = "" if row[0] is None else str(row[0])
            keyed[int(hashlib.md5(f"{op.SEED}:{epochs + 1}:{key}".encode()).hexdigest()[:15], 16)].append(row)
        running = 0
        for order in sorted(keyed):
            running += sum(tokens_of(r[1]) for r in keyed[order])
            for r in keyed[order]:
                more = tokens_of(r[1]) > 0 and rest > 0 and running <= rest
                out.append((r[0], path, tokens_of(r[1]), dealt[path], epochs + more))
    return sorted(out, key=repr)


def got_copies(df):
    rows = op.mix_documents(df).select(F.col("row.doc_id").alias("i"), "domain", "lang", "source", "tokens", "budget", "copies").collect()
    return sorted(((r[0], (r[1], r[2], r[3]), r[4], r[5], r[6]) for r in rows), key=repr)


def test_copies_match_step_by_step_dealing(spark):
    assert got_copies(frame(spark)) == slow_copies(documents())


def test_hot_source(spark):
    rows = [(i, "w " * (1 + i % 7), "en", "src0" if i % 3 else f"src{i % 20}", 0) for i in range(3000)]
    assert got_copies(frame(spark, rows)) == slow_copies(rows)


@pytest.mark.parametrize("total,expected", [
    (100.0, {"a1": 25, "a2": 25, "b1": 50}),
    # a1 is full at 30: its sibling takes over first, and b only what a as a whole cannot use.
    (200.0, {"a1": 30, "a2": 70, "b1": 100}),
    (400.0, {"a1": 30, "a2": 120, "b1": 250}),
    (9000.0, {"a1": 30, "a2": 120, "b1": 900}),
    (0.0, {"a1": 0, "a2": 0, "b1": 0}),
])
def test_shortages_go_to_siblings_before_ancestors(spark, total, expected):
    rows = [("a", "x", "a1", 30), ("a", "x", "a2", 120), ("b", "x", "b1", 900)]
    leaves = spark.createDataFrame(rows, "domain string, lang string, source string, tokens long")
    one = {n: F.lit(1.0) for n in ("domain", "lang", "source")}
    got = {r["source"]: r["budget"] for r in op.budgets(leaves, F.lit(total), 1, one).collect()}
    assert got == expected


def test_empty_and_clashes(spark):
    assert op.mix_documents(frame(spark, [])).count() == 0
    odd = frame(spark).select("*", *[F.lit(1).alias(c) for c in ("domain", "tokens", "copies", "row", "epochs", "end", "key")])
    col = F.col
    got = op.mix(odd, F.lit("d"), col("lang"), col("source"), F.lit(1).cast("long"), col("doc_id"))
    assert got.count() == len(documents()) and {"key", "end"} <= set(got.columns)


def test_stage_repeats_documents(spark):
    docs = frame(spark)
    got = op.mixing_stage(spark, docs, "")
    assert got.columns == docs.columns
    expected = sorted((repr(r[0]) for r in slow_copies(documents()) for _ in range(r[4])))
    assert sorted(repr(r["doc_id"]) for r in got.collect()) == expected
    assert op.mixing_stage(spark, spark.createDataFrame([], DOCS), "").count() == 0
    assert plain(got) == plain(op.mixing_stage(spark, docs.repartition(7), ""))
