"""Components of near copies against all pairs, and the share of links found on a whole table."""

from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from geoingest.llm import alike as op
from geoingest.llm.registry import table
from geoingest.llm.simhash import simhash_stage
from llm_helpers import frame, prose


def shingles(text):
    w = text.lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()


def linked(a, b):
    return len(a & b) >= 0.8 * len(a | b)


def slow_roots(sets):
    """Smallest place of each component, by comparing all pairs that share a shingle."""
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    met = set()
    for held in holders.values():
        for k, i in enumerate(held):
            for j in held[k + 1 :]:
                if (i, j) not in met:
                    met.add((i, j))
                    a, b = find(i), find(j)
                    if a != b and linked(sets[i], sets[j]):
                        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(sets))], met


def family(seed, n, words=120, edits=range(0, 12)):
    """Copies of one text, each with some words of its own, and copies of copies."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(10**5)}" for _ in range(words)]
    out = [base]
    for _ in range(n - 1):
        copy = list(rng.choice(out[:1] * 3 + out[-5:]))
        for _ in range(rng.choice(edits)):
            copy[rng.randrange(words)] = f"x{rng.randrange(10**6)}"
        out.append(copy)
    return [" ".join(t) for t in out]


def roots_of(spark, texts, seeds=()):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "node long, text string")
    nodes = df.select("node", op.sketches("text").alias("s")).select("node", "s.*")
    got = op.near_copies(nodes, df, spark.createDataFrame(list(seeds), "a long, b long"))
    found = {r["node"]: r["root"] for r in got.collect()}
    return [found.get(i, i) for i in range(len(texts))]


@pytest.mark.parametrize("block", [8, 4096])
def test_families_of_copies(spark, monkeypatch, block):
    monkeypatch.setattr(op, "BLOCK", block)
    texts = [t for k, n in enumerate([2, 3, 5, 30, 120]) for t in family(k, n)] + [prose(i, 60) for i in range(20)]
    texts = list(dict.fromkeys(texts))
    assert roots_of(spark, texts) == slow_roots([shingles(t) for t in texts])[0]


def test_lead_is_not_the_smallest_and_a_chain_holds_together(spark):
    words = [f"w{i}" for i in range(100)]
    far = [f"y{i}" if i % 9 == 0 else w for i, w in enumerate(words)]
    chain = [words[k:] + [f"z{i}" for i in range(k)] for k in range(0, 40, 4)]
    texts = [" ".join(t) for t in [far, *chain[::-1]]]
    expected, _ = slow_roots([shingles(t) for t in texts])
    assert expected[1:] == [1] * 10 and expected[0] == 0
    assert roots_of(spark, texts) == expected


def test_short_and_wordless_texts(spark):
    texts = ["", "one", "One two", "one two three four five", "one two three four five six", "a b c d e f g h i j"]
    assert roots_of(spark, texts) == list(range(len(texts)))


def test_seeds_are_verified(spark):
    texts = family(1, 3, edits=[1]) + [prose(5, 80)]
    assert roots_of(spark, texts, [(0, 3), (3, 1)])[3] == 3


def test_least_hashes_estimate_the_similarity():
    a, b = (op.shingles_of(t.encode()) for t in (" ".join(f"w{i}" for i in range(900)), " ".join(f"w{i}" for i in range(100, 1000))))
    agree = (op.least_hashes(a) == op.least_hashes(b)).mean()
    assert abs(agree - len(np.intersect1d(a, b)) / len(np.union1d(a, b))) < 0.12


def test_recall_on_a_whole_table(spark):
    """Of all pairs of different texts at 0.8 or more, those whose ends the stage takes for one group."""
    sf_dir = "/root/testdata/sf0.01"
    docs = table(spark, sf_dir, "documents")
    texts = [r["text"] or "" for r in docs.orderBy("doc_id").collect()]
    sets = [shingles(t) for t in texts]
    expected, pairs = slow_roots(sets)
    near = [(i, j) for i, j in pairs if sets[i] != sets[j] and linked(sets[i], sets[j])]
    first = {}
    for i, s in enumerate(sets):
        first.setdefault(frozenset(s), i)
    names = sorted(set(first.values()))
    got = roots_of(spark, [texts[i] for i in names])
    root = {frozenset(sets[i]): got[k] for k, i in enumerate(names)}
    caught = sum(root[frozenset(sets[i])] == root[frozenset(sets[j])] for i, j in near)
    assert near and caught >= 0.9 * len(near)
    kept = simhash_stage(spark, docs, sf_dir)
    assert kept.count() == len({expected[first[frozenset(s)]] for s in sets})


def test_a_group_with_a_third_of_all_texts(spark):
    texts = list(dict.fromkeys(family(9, 300, edits=range(0, 20)) + [prose(i, 40) for i in range(400)]))
    assert roots_of(spark, texts) == slow_roots([shingles(t) for t in texts])[0]


def test_stage_on_null_ids_of_one_component(spark):
    text = prose(1, 100)
    docs = frame(spark, [(None, text, "en", "s", 0), (None, text + " end", "en", "s", 0), (None, prose(2, 50), "en", "s", 0)])
    assert simhash_stage(spark, docs, "").count() == 2
    assert simhash_stage(spark, docs.withColumn("node", F.lit(1)).withColumn("sketch", F.lit(2)), "").count() == 2
