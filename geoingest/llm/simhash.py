"""Near-duplicate documents by SimHash with deletion-variant signatures.

A fingerprint of 64 bits over three-word shingles; two link at ``MAX_BITS`` = 3 differing bits or fewer. The 64
bits are cut into two segments, so that one of them differs by at most one bit. Each segment is indexed
under its 32 variants with one bit wild: linked fingerprints share at least one variant and meet in an
equality bucket, where they are verified. Equal fingerprints are one node from the start, so exact copies
cost nothing; a bucket hands on a spanning forest of its links, never all its pairs. A bucket too large
for plain comparison is cut again, by the same rule, on the bits it does not share. No bucket is capped.

Defined results: a null or wordless text has fingerprint zero, which links like any other; a component's
id is the smallest that is not null, or null if it has none; repeated rows share their component; an empty table gives an empty result. Input columns stay, a result column replaces one
of its name.

The pipeline's stage links by another rule, five-word Jaccard of 0.8 or more: copies of that kind lie up to 11 bits
apart, where buckets of bits no longer tell anything. It takes the links of the variant index over fingerprints of
five-word shingles as candidates, adds those of least hashes (``alike``) and verifies all of them on the shingles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoingest.llm.alike import near_copies, sketches
from geoingest.llm.common import components, join_groups, packed, staged, unpacked
from geoingest.llm.registry import query, table

MAX_BITS = 3
SHINGLE_WORDS = 3
#: Runs up to this length are compared by shifts, longer ones by search, the longest are cut again.
SHORT_RUN, LONG_RUN = 32, 8192
#: Hashes whose bits are counted at once.
HASHES_AT_ONCE = 65_536


def fingerprint(text: bytes) -> int:
    """Majority of each bit over the XXH64 (seed 42) of all shingles, as a signed 64-bit integer.

    On UTF-8 bytes, lower-casing A-Z and splitting at ``[\\x20\\x09-\\x0D]`` are what ``bytes`` does.
    """
    words = text.lower().split()
    n = len(words)
    if not n:
        return 0
    if n <= SHINGLE_WORDS:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(words, words[1:], words[2:]))
    total = max(n - SHINGLE_WORDS + 1, 1)
    hashes = np.fromiter((xxhash.xxh64_intdigest(s, 42) for s in shingles), np.uint64, total)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, total, HASHES_AT_ONCE):
        part = hashes[at : at + HASHES_AT_ONCE]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    packed_bits = np.packbits(2 * ones > total, bitorder="little")
    return int(packed_bits.view(np.int64)[0])


@F.arrow_udf(T.LongType())
def _fingerprints(texts: pa.Array) -> pa.Array:
    return pa.array([fingerprint(t or b"") for t in texts.cast(pa.binary()).to_pylist()], pa.int64())


def _forest(prints: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links that connect what is connected within one long run, found by search from node to node."""
    left = prints
    while len(left):
        frontier, left = [left[0]], left[1:]
        while frontier and len(left):
            node = frontier.pop()
            near = np.bitwise_count(left ^ node) <= MAX_BITS
            if near.any():
                found = left[near]
                left = left[~near]
                yield np.full(len(found), node), found
                frontier.extend(found)


def _recut(prints: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """A run that shares all but one bit of a segment: cut the bits that differ into two, one bit wild each."""
    varying = np.bitwise_or.reduce(prints ^ prints[0])
    places = [b for b in range(64) if int(varying) >> b & 1]
    half = len(places) // 2
    for part in (places[:half], places[half:]):
        mask = np.uint64(sum(1 << b for b in part))
        for wild in part or [None]:
            key = prints & (mask & ~np.uint64(0 if wild is None else 1 << wild))
            order = np.argsort(key, kind="stable")
            ordered, key = prints[order], key[order]
            bounds = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]]))
            for a, b in zip(bounds[:-1], bounds[1:]):
                if b - a > 1:
                    yield from _forest(ordered[a:b])


def links_of_runs(keys: np.ndarray, prints: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Verified links within runs of equal keys; both arrays are ordered by key."""
    bounds = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]]))
    sizes = np.diff(bounds)
    for a, n in zip(bounds[:-1][sizes > SHORT_RUN], sizes[sizes > SHORT_RUN]):
        run = prints[a : a + n]
        yield from _recut(run) if n > LONG_RUN else _forest(run)
    short = np.repeat(sizes <= SHORT_RUN, sizes)
    keys, prints = keys[short], prints[short]
    for step in range(1, SHORT_RUN):
        same = keys[step:] == keys[:-step]
        if not same.any():
            break
        a, b = prints[:-step][same], prints[step:][same]
        near = np.bitwise_count(a ^ b) <= MAX_BITS
        yield a[near], b[near]


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of ``key, print`` in order of key to batches of links; a run may span batches."""
    names = ["a", "b"]
    keys, prints = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    waiting: list[tuple[np.ndarray, np.ndarray]] = []

    def given(pairs):
        for a, b in pairs:
            for at in range(0, len(a), 100_000):
                part = [pa.array(x[at : at + 100_000].view(np.int64)) for x in (a, b)]
                yield pa.RecordBatch.from_arrays(part, names)

    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column("key").to_numpy()
        waiting.append((key, batch.column("print").to_numpy().view(np.uint64)))
        # All of a long run is joined once, when its end is in sight.
        if key[0] == key[-1] and (len(waiting) == 1 or waiting[0][0][0] == key[-1]):
            continue
        keys, prints = (np.concatenate(x) for x in zip(*waiting))
        cut = np.searchsorted(keys, keys[-1])
        yield from given(links_of_runs(keys[:cut], prints[:cut]))
        waiting = [(keys[cut:], prints[cut:])]
    if waiting:
        keys, prints = (np.concatenate(x) for x in zip(*waiting))
        yield from given(links_of_runs(keys, prints))


def fingerprint_links(prints: DataFrame) -> DataFrame:
    """Links ``a, b`` that connect all of the distinct fingerprints ``print`` within ``MAX_BITS`` of each other."""
    low, high = F.col("print").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned("print", 32)
    variants = []
    for segment, bits in enumerate((low, high)):
        for wild in range(32):
            rest = bits.bitwiseAND(F.lit(0xFFFFFFFF ^ (1 << wild)))
            variants.append(rest.bitwiseOR(F.lit((segment * 32 + wild) << 32)))
    keyed = prints.select("print", F.explode(F.array(*variants)).alias("key"))
    dealt = keyed.repartition("key").sortWithinPartitions("key").select("key", "print")
    return dealt.mapInArrow(_links, "a long, b long").distinct()


def near_components(prints: DataFrame) -> DataFrame:
    """From rows ``id, print``: per distinct fingerprint its rows ``n`` and ``component_id``, the smallest id reachable."""
    nodes = staged(prints.groupBy("print").agg(F.min("id").alias("least"), F.count("*").alias("n")), "fingerprint-nodes")
    roots = staged(components(fingerprint_links(nodes.select("print")), "fingerprint-stars"), "fingerprint-roots")
    of = nodes.join(roots.withColumnRenamed("node", "print"), "print", "left")
    of = of.withColumn("root", F.coalesce("root", "print"))
    # A component may hold a third of all fingerprints: its least id is found by partial aggregates.
    least = of.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("prints"))
    joined = join_groups(of.select("print", "root", "n"), least, "root", "prints")
    return joined.select("print", "n", "component_id")


def simhash_rows(df: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """``row, id, print`` of each row, staged, and the components of its fingerprints."""
    rows = packed(df, id=F.col(f"`{id_col}`"), text=F.col(f"`{text_col}`"))
    rows = staged(rows.select("row", "id", _fingerprints("text").alias("print")), "fingerprints")
    return rows, staged(near_components(rows.select("id", "print")), "near-components")


def simhash_dedup(df: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The rows of ``df`` with ``fingerprint`` (16 hex digits) and ``component_id``."""
    rows, found = simhash_rows(df, text_col, id_col)
    joined = join_groups(rows, found, "print", "n")
    shown = F.lower(F.lpad(F.hex("print"), 16, "0"))
    return unpacked(joined, df.columns, fingerprint=shown, component_id=F.col("component_id"))


@query()
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def fingerprint_pairs(nodes: DataFrame) -> DataFrame:
    """From ``node, print``: pairs ``a, b`` that connect all nodes whose fingerprints lie within ``MAX_BITS``."""
    ones = staged(nodes.groupBy("print").agg(F.min("node").alias("one"), F.count("*").alias("n")), "print-nodes")
    same = nodes.join(ones.where("n > 1").select("print", "one"), "print").where("node <> one").select(F.col("one").alias("a"), F.col("node").alias("b"))
    ends = [ones.select(F.col("print").alias(c), F.col("one").alias(f"one_{c}")) for c in ("a", "b")]
    links = fingerprint_links(ones.select("print")).join(ends[0], "a").join(ends[1], "b")
    return same.unionByName(links.select(F.col("one_a").alias("a"), F.col("one_b").alias("b")))


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline: of each component of near copies one document stays, the one with the smallest id (one row of it, if it repeats)."""
    rows = packed(docs.withColumn("_gx_row", F.monotonically_increasing_id()), id=F.col("doc_id"), text=F.col("text"))
    rows = rows.select("row", "id", F.col("row").getField("_gx_row").alias("place"), sketches("text").alias("sketch"))
    rows = staged(rows.select("row", "id", "place", "sketch.*"), "sketches")
    # Texts of the same shingles are one node, named by one of its rows.
    ones = rows.groupBy("same").agg(F.min("place").alias("node"), F.min("id").alias("least"), F.count("*").alias("n"))
    ones = staged(ones, "alike-nodes")
    names = ones.select(F.col("node").alias("place")).hint("merge")
    nodes = rows.select("place", "size", "print", "sketch").join(names, "place", "left_semi").withColumnRenamed("place", "node")
    nodes = staged(nodes, "alike-sketches")
    texts = rows.select(F.col("place").alias("node"), F.col("row").getField("text").alias("text"))
    roots = near_copies(nodes, texts, fingerprint_pairs(nodes.select("node", "print")))
    of = ones.join(roots.hint("merge"), "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = of.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("prints"))
    found = staged(join_groups(of.select("same", "root", "n"), least, "root", "prints").select("same", "n", "root", "component_id"), "near-alike")
    narrow = join_groups(rows.select("id", "same", "place"), found, "same", "n")
    # Without any id in a component, one row of it stays.
    kept = narrow.where("id <=> component_id").groupBy("root").agg(F.min("place").alias("place"))
    kept = staged(kept.select("place"), "near-kept")
    stay = rows.join(kept.hint("merge"), "place", "left_semi")
    return unpacked(stay, docs.columns)
