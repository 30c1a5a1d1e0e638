from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from geoingest.llm import simhash as op
from geoingest.llm.common import components
from llm_helpers import documents, frame, plain


def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if hashes and 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(prints):
    """Least place reachable over links of three bits, by search."""
    root = list(range(len(prints)))
    for start in range(len(prints)):
        if root[start] != start:
            continue
        todo = [start]
        while todo:
            a = todo.pop()
            for b in range(len(prints)):
                if root[b] > start and bin(prints[a] ^ prints[b]).count("1") <= 3:
                    root[b] = start
                    todo.append(b)
    return root


def test_fingerprints_and_components(spark):
    rows = [r for r in documents() if r[0] is not None]
    got = {r["doc_id"]: r for r in op.simhash_dedup(frame(spark, rows)).collect()}
    rows = sorted({r[0]: r for r in rows}.values())
    prints = [slow_fingerprint(r[1]) for r in rows]
    assert [got[r[0]]["fingerprint"] for r in rows] == [f"{p:016x}" for p in prints]
    assert [got[r[0]]["component_id"] for r in rows] == [rows[k][0] for k in slow_components(prints)]


def clustered(seed, n):
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(6)] + [0]
    return sorted({rng.choice(centres) ^ sum({1 << rng.randrange(64) for _ in range(rng.randrange(5))}) for _ in range(n)})


@pytest.mark.parametrize("short,long_", [(32, 8192), (4, 8192), (2, 8)])
def test_links_connect_what_is_near(spark, monkeypatch, short, long_):
    """Whichever way a bucket is compared, the links give the components of all pairs."""
    monkeypatch.setattr(op, "SHORT_RUN", short)
    monkeypatch.setattr(op, "LONG_RUN", long_)
    prints = clustered(short, 300)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    keys = []
    for segment in (0, 1):
        for wild in range(32):
            for p in prints:
                keys.append(((segment * 32 + wild) << 32 | (p >> 32 * segment & 0xFFFFFFFF & ~(1 << wild)), p))
    keys.sort()
    pairs = op.links_of_runs(np.array([k for k, _ in keys], np.int64), np.array([p for _, p in keys], np.uint64))
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        for x, y in zip(a.tolist(), b.tolist()):
            assert bin(x ^ y).count("1") <= 3
            x, y = find(x), find(y)
            root[max(x, y)] = min(x, y)
    expected = slow_components(prints)
    assert [find(p) for p in prints] == [prints[k] for k in expected]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(signed)], "id long, print long")
    got = {r["print"]: r["component_id"] for r in op.near_components(df).collect()}
    assert [got[s] for s in signed] == expected


def test_recut_finds_all_links():
    rng = np.random.default_rng(3)
    base = np.uint64(0x0123456789ABCDEF)
    low = np.unique(rng.integers(0, 2**12, 600, dtype=np.uint64)) << np.uint64(20)
    run = base ^ low
    linked = {(min(a, b), max(a, b)) for x, y in op._recut(run) for a, b in zip(x.tolist(), y.tolist())}
    root = {p: p for p in run.tolist()}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in linked:
        root[max(find(a), find(b))] = min(find(a), find(b))
    ordered = sorted(run.tolist())
    assert [find(p) for p in ordered] == [ordered[k] for k in slow_components(ordered)]


def test_components_of_a_long_path(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1001), (1001, 1000), (5, 5)]
    random.Random(4).shuffle(edges)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(201)} | {1000: 1000, 1001: 1000}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_empty_nulls_and_clashes(spark):
    assert op.simhash_dedup(frame(spark, [])).count() == 0
    odd = frame(spark).select("*", *[F.lit(1).alias(c) for c in ("print", "id", "row", "component_id", "place", "n")])
    got = op.simhash_dedup(odd)
    assert got.count() == len(documents()) and "print" in got.columns


def test_stage_keeps_one_of_each_component(spark):
    docs = frame(spark, [r for r in documents() if r[0] is not None])
    found = op.simhash_dedup(docs)
    got = op.simhash_stage(spark, docs, "")
    assert got.columns == docs.columns
    assert plain(got.select("doc_id")) == plain(found.select("component_id").distinct())


def test_stage_drops_near_copies_beyond_three_bits(spark):
    """Links are five-word Jaccard of 0.8 or more, also through a third text, whatever the bits say."""
    rng = random.Random(5)
    words = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]

    def edited(text, *places):
        return [f"new{rng.randrange(10**6)}" if i in places else w for i, w in enumerate(text)]

    def alike(a, b):
        x, y = ({tuple(t[i : i + 5]) for i in range(len(t) - 4)} for t in (a, b))
        return len(x & y) / len(x | y)

    texts, far = [], 0
    for k in range(12):
        base = words(120)
        # The ends are linked through the base only; a quarter of the words exchanged is another text.
        family = [edited(base, 20, 60), base, edited(base, 40, 80), edited(base, *range(0, 120, 8))]
        texts += family
        far += bin(slow_fingerprint(" ".join(family[0])) ^ slow_fingerprint(" ".join(base))).count("1") > 3
    assert far >= 6
    docs = frame(spark, [(i, " ".join(t), "en", "s", 0) for i, t in enumerate(texts)])
    root = list(range(len(texts)))
    for _ in range(3):
        for a in range(len(texts)):
            for b in range(a):
                if alike(texts[a], texts[b]) >= 0.8:
                    root[a] = root[b] = min(root[a], root[b])
    assert len(set(root)) == 24
    assert sorted(r["doc_id"] for r in op.simhash_stage(spark, docs, "").collect()) == sorted(set(root))
