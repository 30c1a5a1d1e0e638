"""Near copies by word shingles: candidates from least hashes, every link verified on the shingles themselves.

A text is known by ``HASHES`` least hashes of its five-word shingles, two bytes each. Texts that agree in one of
``BANDS`` bands of them meet in a bucket; a pair of Jaccard similarity ``LEAST`` meets in none with a probability
below 1 in 10 million. Buckets of the same members are one. What a bucket needs is not its pairs but what connects them:

1. Its lead, the member whose buckets are the fullest, is held against all others: in a group of copies of one text
   that is the text itself, and nearly all copies link to it. Links by another index may join in (``seeds``).
2. Each member left apart is held against the one text of another component that agrees with it in most least hashes.
3. Members still apart are held against all of their bucket that could link.

In 2 and 3 pairs are looked at in blocks of arrays, and only such go on to be verified as may link: of two components,
with numbers of shingles that allow ``LEAST``, not told apart by their distances to the lead (the distance 1 - Jaccard
obeys the triangle inequality), and agreeing in ``MAY_LINK`` least hashes, which a pair at ``LEAST`` misses with a
probability of 0.3 %. A pair counts in the first band it shares only. A large bucket is dealt to several tasks, block
against block; no bucket is capped and no pair is sampled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoingest.llm.common import components, staged

WORDS, LEAST = 5, 0.8
BANDS, BAND_ROWS = 32, 4
HASHES = BANDS * BAND_ROWS
#: Agreeing least hashes; at 0.8 their number is 102 on average, with a deviation of 4.5.
MAY_LINK = 90
#: Members of a bucket that one task holds, and pairs that it looks at together.
BLOCK, PAIRS_AT_ONCE = 4096, 1 << 15

_ODD = lambda seed, n: np.random.default_rng(seed).integers(0, 2**63, n, np.uint64) * np.uint64(2) + np.uint64(1)
_PLACES, _FACTORS = _ODD(5, WORDS), _ODD(42, HASHES)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def shingles_of(text: bytes) -> np.ndarray:
    """Hashes of the distinct five-word shingles, in order; of a shorter text its words as one, of a wordless one none.

    Words are what white space parts, A-Z lower-cased.
    """
    words = text.lower().split()
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    n = min(len(words), WORDS)
    if not n:
        return hashes.view(np.int64)
    grams = np.full(len(words) - n + 1, n, np.uint64)
    for j in range(n):
        grams += hashes[j : j + len(grams)] * _PLACES[j]
    grams = (grams ^ (grams >> np.uint64(32))) * _MIX
    return np.unique((grams ^ (grams >> np.uint64(29))).view(np.int64))


def least_hashes(shingles: np.ndarray) -> np.ndarray:
    least = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 512):
        np.minimum(least, (shingles[at : at + 512, None].view(np.uint64) * _FACTORS).min(axis=0), out=least)
    return ((least * _MIX) >> np.uint64(48)).astype(np.uint16)


def majority(hashes: np.ndarray) -> int:
    """Bits set in over half of the hashes, as a signed integer."""
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.int64)[0])


_SKETCH = T.StructType([
    T.StructField("same", T.LongType()),
    T.StructField("size", T.IntegerType()),
    T.StructField("print", T.LongType()),
    T.StructField("sketch", T.BinaryType()),
])


@F.arrow_udf(_SKETCH)
def sketches(texts: pa.Array) -> pa.Array:
    """A digest of the set of shingles, its size, its SimHash fingerprint and its least hashes."""
    rows = []
    for t in texts.cast(pa.binary()):
        shingles = shingles_of(t.as_py() or b"")
        same = xxhash.xxh64_intdigest(shingles.tobytes(), 42) - (1 << 63)
        rows.append((same, len(shingles), majority(shingles), least_hashes(shingles).tobytes()))
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.binary()]
    columns = zip(*rows) if rows else [[]] * len(kinds)
    return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], _SKETCH.names)


@F.arrow_udf(T.ArrayType(T.LongType()))
def _sets(texts: pa.Array) -> pa.Array:
    found = [shingles_of(t.as_py() or b"") for t in texts.cast(pa.binary())]
    ends = pa.array(np.cumsum([0, *map(len, found)]), pa.int32())
    return pa.ListArray.from_arrays(ends, pa.array(np.concatenate(found) if found else [], pa.int64()))


@F.arrow_udf(T.DoubleType())
def _jaccard(a: pa.Array, b: pa.Array) -> pa.Array:
    out = []
    for x, y in zip(a, b):
        x, y = x.values.to_numpy(), y.values.to_numpy()
        if not len(x) or not len(y):
            out.append(float(len(x) == len(y)))
            continue
        at = np.searchsorted(y, x)
        at[at == len(y)] = 0
        both = int((y[at] == x).sum())
        out.append(both / (len(x) + len(y) - both))
    return pa.array(out, pa.float64())


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``a, b`` with their similarity by their ``sets(node, shingles)``."""
    sides = [sets.select(F.col("node").alias(c), F.col("shingles").alias(f"set_{c}")) for c in ("a", "b")]
    met = pairs.join(sides[0].hint("merge"), "a").join(sides[1].hint("merge"), "b")
    return staged(met.select("a", "b", _jaccard("set_a", "set_b").alias("alike")), "alike-verified")


def buckets(nodes: DataFrame) -> DataFrame:
    """``key, band, node, lead`` of buckets of two or more of ``nodes(node, sketch)``, one of those with the same members."""
    wide = 2 * BAND_ROWS
    parts = F.array(*[F.substring("sketch", wide * band + 1, wide) for band in range(BANDS)])
    keyed = nodes.select("node", F.posexplode(parts).alias("band", "part")).select(F.xxhash64("band", "part").alias("key"), "band", "node")
    sizes = keyed.groupBy("key").agg(
        F.min("band").alias("band"), F.count("*").alias("n"), F.expr("bit_xor(xxhash64(node))").alias("x"), F.expr("bit_xor(xxhash64(node, 1))").alias("y")
    )
    # The first band stays: the first that a pair shares is then among those that stay, with this pair in it.
    kept = sizes.where("n > 1").groupBy("n", "x", "y").agg(F.min(F.struct("band", "key")).alias("one"), F.count("*").alias("times"))
    kept = staged(kept.select("one.key", (F.col("n") * F.col("times")).alias("full")), "alike-keys")
    hits = staged(keyed.join(kept.hint("merge"), "key"), "alike-hits")
    scores = hits.groupBy("node").agg(F.sum("full").alias("score"))
    leads = hits.join(scores.hint("merge"), "node").groupBy("key").agg(F.max(F.struct("score", -F.col("node"))).alias("top"))
    leads = leads.select("key", (-F.col("top.col2")).alias("lead"))
    return staged(hits.select("key", "band", "node").join(leads.hint("merge"), "key"), "alike-buckets")


_ROWS = ["group", "role", "node", "root", "apart", "leads", "size", "away", "band"]


class _Members:
    """Rows of one bucket as arrays."""

    def __init__(self, batch: pa.RecordBatch, a: int, z: int) -> None:
        for name in _ROWS[2:]:
            setattr(self, name, batch.column(name).slice(a, z - a).to_numpy(zero_copy_only=False))
        found = batch.column("sketch").slice(a, z - a)
        self.sketch = np.frombuffer(b"".join(found.to_pylist()), np.uint16).reshape(-1, HASHES)

    def __len__(self) -> int:
        return len(self.node)


def _may_link(x: _Members, y: _Members) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Places in ``x`` and ``y`` of pairs that may link, and in how many least hashes they agree."""
    step = max(1, 4 * PAIRS_AT_ONCE // max(len(y), 1))
    for at in range(0, len(x), step):
        rows = slice(at, at + step)
        ok = (x.root[rows, None] != y.root) & ~y.leads & (~y.apart | (x.node[rows, None] < y.node))
        ok &= (5 * x.size[rows, None] >= 4 * y.size) & (4 * x.size[rows, None] <= 5 * y.size)
        ok &= np.abs(x.away[rows, None] - y.away) <= 1 - LEAST + 1e-9
        i, j = np.nonzero(ok)
        for part in range(0, len(i), PAIRS_AT_ONCE):
            a, b = i[part : part + PAIRS_AT_ONCE] + at, j[part : part + PAIRS_AT_ONCE]
            same = x.sketch[a] == y.sketch[b]
            agree = same.sum(axis=1)
            first = same.reshape(-1, BANDS, BAND_ROWS).all(axis=2).argmax(axis=1)
            good = (agree >= MAY_LINK) & (first == x.band[a])
            yield a[good], b[good], agree[good]


def _compared(best_only: bool):
    """Rows of buckets, members apart (role 0) before all (role 1), to pairs: all that may link, or each one's best."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held, best = None, [], []

        def given(a: np.ndarray, b: np.ndarray) -> Iterator[pa.RecordBatch]:
            for at in range(0, len(a), 50_000):
                yield pa.RecordBatch.from_arrays([pa.array(v[at : at + 50_000], pa.int64()) for v in (a, b)], ["a", "b"])

        def ended() -> Iterator[pa.RecordBatch]:
            for x, (n, to) in zip(held, best):
                yield from given(x.node[n > 0], to[n > 0])

        for batch in batches:
            if not batch.num_rows:
                continue
            groups, roles = batch.column("group").to_numpy(), batch.column("role").to_numpy()
            new = np.flatnonzero((groups[1:] != groups[:-1]) | (roles[1:] != roles[:-1])) + 1
            for a, z in zip([0, *new.tolist()], [*new.tolist(), len(groups)]):
                members = _Members(batch, a, z)
                if groups[a] != group:
                    if best_only:
                        yield from ended()
                    group, held, best = groups[a], [], []
                if roles[a] == 0:
                    held.append(members)
                    best.append((np.zeros(len(members), np.int64), np.zeros(len(members), np.int64)))
                    continue
                for x, (n, to) in zip(held, best):
                    for i, j, agree in _may_link(x, members):
                        if not best_only:
                            yield from given(x.node[i], members.node[j])
                            continue
                        order = np.lexsort((-members.node[j], agree))
                        i, j, agree = i[order], j[order], agree[order]
                        # Of pairs with the same member the last, most agreeing one stays.
                        top = np.zeros(len(n), np.int64)
                        last = np.zeros(len(n), np.int64)
                        top[i], last[i] = agree, members.node[j]
                        better = top > n
                        n[better], to[better] = top[better], last[better]
        if best_only:
            yield from ended()

    return run


def _candidates(hits: DataFrame, nodes: DataFrame, met: DataFrame, roots: DataFrame, best_only: bool) -> DataFrame:
    """Distinct pairs ``a, b`` of different components that share a bucket and may link."""
    placed = hits.join(roots.hint("merge"), "node", "left").withColumn("root", F.coalesce("root", "node"))
    lead_roots = roots.select(F.col("node").alias("lead"), F.col("root").alias("lead_root"))
    placed = placed.join(lead_roots.hint("merge"), "lead", "left")
    placed = placed.withColumn("apart", F.col("root") != F.coalesce("lead_root", "lead")).drop("lead_root")
    placed = staged(placed, "alike-placed")
    sizes = placed.groupBy("key").agg(F.sum(F.col("apart").cast("long")).alias("n_apart"), F.count("*").alias("n")).where("n_apart > 0")
    ways = [F.ceil(F.col(c) / BLOCK).cast("int").alias(name) for c, name in (("n_apart", "parts"), ("n", "deals"))]
    open_ = placed.join(sizes.select("key", *ways).hint("merge"), "key")
    pair = [F.least("lead", "node").alias("a"), F.greatest("lead", "node").alias("b")]
    open_ = open_.withColumns(dict(zip("ab", pair))).join(met.select("a", "b", (1 - F.col("alike")).alias("away")).hint("merge"), ["a", "b"], "left")
    leads = F.col("node") == F.col("lead")
    open_ = open_.select("key", "band", "node", "root", "apart", leads.alias("leads"), F.when(leads, 0.0).otherwise(F.col("away")).alias("away"), "parts", "deals")
    open_ = open_.join(nodes.select("node", "size", "sketch").hint("merge"), "node")
    part, deal = F.pmod(F.xxhash64("node"), "parts").cast("int"), F.pmod(F.xxhash64("node", F.lit(1)), "deals").cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    sides = [
        open_.where("apart").withColumn("part", part).withColumn("deal", every("deals")).withColumn("role", F.lit(0)),
        open_.withColumn("deal", deal).withColumn("part", every("parts")).withColumn("role", F.lit(1)),
    ]
    dealt = sides[0].unionByName(sides[1]).withColumn("group", F.xxhash64("key", "part", "deal")).select(*_ROWS, "sketch")
    dealt = dealt.repartition("group").sortWithinPartitions("group", "role")
    found = dealt.mapInArrow(_compared(best_only), "a long, b long")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_copies(nodes: DataFrame, texts: DataFrame, seeds: DataFrame) -> DataFrame:
    """``node, root`` of all nodes that link to another, ``root`` naming the component.

    ``nodes(node, size, sketch)`` are distinct sets of shingles, ``texts(node, text)`` has a text of each, ``seeds(a, b)``
    are pairs that another index takes for near copies.
    """
    hits = buckets(nodes)
    leads = hits.where("node <> lead").select(F.least("lead", "node").alias("a"), F.greatest("lead", "node").alias("b"))
    first = staged(leads.unionByName(seeds.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))).distinct(), "alike-first")
    used = hits.select("node").unionByName(first.select(F.col("a").alias("node"))).unionByName(first.select(F.col("b").alias("node"))).distinct()
    sets = texts.join(used.hint("merge"), "node", "left_semi").select("node", _sets("text").alias("shingles"))
    sets = staged(sets, "alike-sets")
    met = _verified(first, sets)
    links = met.where(F.col("alike") >= LEAST).select("a", "b")
    roots = staged(components(links, "alike-stars"), "alike-roots")
    for best_only in (True, False):
        pairs = staged(_candidates(hits, nodes, met, roots, best_only), "alike-pairs")
        if not pairs.limit(1).count():
            break
        links = links.unionByName(_verified(pairs, sets).where(F.col("alike") >= LEAST).select("a", "b"))
        roots = staged(components(links, "alike-stars"), "alike-roots")
    return roots
