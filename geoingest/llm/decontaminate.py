"""Benchmark passages in documents by winnowing.

A window of ``length`` words is known by the least hash of its word k-grams, the last of equal ones: k is half of the
length, so a document and an item that share a window keep the same k-gram of it, wherever the window lies. Both
sides keep only the k-grams that are least in some window, each with the span of words that its windows cover;
fingerprints are joined by equality, and the windows of the spans that met are compared as texts, so a
document word is hit if and only if it lies in a window of an item. Items shorter than ``length`` are one window
of their own length; documents are winnowed once per length that items have, ten at most.

Before the join a document's fingerprints pass a bitmap of the items' fingerprints, of a size between fixed bounds,
so that documents without passages send nothing; what passes by chance is sorted out by the join. Documents are
grouped by the set of windows they hold before item ids are listed, so a passage that many documents share is
resolved once.

Defined results: lower-casing A-Z, a word is a run of digits, letters a-z and characters beyond ASCII; a null, empty or wordless text has
no words and no hits; an item without words has no window; rows of items with one id are one item, a null id is an
item written as the empty text; repeated documents get equal results; empty tables give no rows or no hits. Input
columns named in ``carry`` stay, a result column replaces one of its name.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoingest.llm.common import broadcast_within, packed, staged, unpacked
from geoingest.llm.registry import query, table

WINDOW = 10
#: Bits of the items' fingerprints: 16 for each, between these bounds (128 KB and 8 MB).
LEAST_BITS, MOST_BITS = 1 << 20, 1 << 26

_WORD = set(b"0123456789abcdefghijklmnopqrstuvwxyz") | set(range(128, 256))
#: UTF-8 bytes with A-Z lower-cased and all that is no part of a word blank.
_FOLD = bytes(c if c in _WORD else 32 for c in bytes(range(256)).lower())
_FACTORS = np.random.default_rng(11).integers(0, 2**63, WINDOW, np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def winnowed(hashes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fingerprints of the windows of ``length`` words: keys, and the first and last window each stands for."""
    gram = (length + 1) // 2
    windows = len(hashes) - length + 1
    if windows < 1:
        none = np.zeros(0, np.int64)
        return none, none, none
    grams = np.full(len(hashes) - gram + 1, length, np.uint64)
    for j in range(gram):
        grams += hashes[j : j + len(grams)] * _FACTORS[j]
    grams = (grams ^ (grams >> np.uint64(29))) * _MIX
    grams ^= grams >> np.uint64(32)
    least, at = grams[:windows].copy(), np.zeros(windows, np.int64)
    for j in range(1, length - gram + 1):
        other = grams[j : j + windows]
        later = other <= least
        least[later], at[later] = other[later], j
    at += np.arange(windows)
    first = np.flatnonzero(np.diff(at, prepend=-1))
    return least[first].view(np.int64), first, np.append(first[1:], windows) - 1


_MARKS = T.ArrayType(T.StructType([T.StructField("key", T.LongType()), T.StructField("first", T.IntegerType()), T.StructField("length", T.IntegerType()), T.StructField("span", T.StringType())]))


def _marks(lengths: Iterable[int] | None, bits: np.ndarray | None):
    """Texts to ``n_words`` and the fingerprints ``marks``: those that pass the bitmap, or all.

    ``lengths`` are those of the windows; an item has one window length, its own up to ``WINDOW``.
    """

    @F.arrow_udf(T.StructType([T.StructField("n_words", T.LongType()), T.StructField("marks", _MARKS)]))
    def marked(texts: pa.Array) -> pa.Array:
        counts, found, ends = [], [], [0]
        for text in texts.cast(pa.binary()):
            words = words_of(text.as_py() or b"")
            counts.append(len(words))
            hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
            for length in [min(len(words), WINDOW)] if lengths is None else lengths:
                if not length:
                    continue
                keys, first, last = winnowed(hashes, length)
                if bits is not None:
                    at = keys.view(np.uint64)
                    passed = bits[(at >> np.uint64(6)) & np.uint64(len(bits) - 1)] >> (at & np.uint64(63)) & np.uint64(1) == 1
                    keys, first, last = keys[passed], first[passed], last[passed]
                for key, a, z in zip(keys.tolist(), first.tolist(), last.tolist()):
                    found.append((key, a, length, b" ".join(words[a : z + length]).decode("utf-8", "replace")))
            ends.append(len(found))
        columns = list(zip(*found)) or [[]] * 4
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.string()]
        rows = pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["key", "first", "length", "span"])
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rows)
        return pa.StructArray.from_arrays([pa.array(counts, pa.int64()), lists], ["n_words", "marks"])

    return marked


def _windows(df: DataFrame) -> DataFrame:
    """From rows with ``first, length, span`` one row per window with its ``start`` and ``window``, its words."""
    words = F.split("span", " ")
    each = F.transform(
        F.sequence(F.lit(0), F.size("words") - F.col("length")),
        lambda i: F.struct((F.col("first") + i).alias("start"), F.array_join(F.slice("words", i + 1, F.col("length")), " ").alias("window")),
    )
    rest = [c for c in df.columns if c not in ("first", "span")]
    return df.withColumn("words", words).select(*rest, F.explode(each).alias("at")).select(*rest, "at.*")


def _bitmap(keys: DataFrame) -> np.ndarray:
    """Bits of the lower digits of the distinct ``key``; no more than ``MOST_BITS`` come to the driver."""
    n = keys.count()
    size = min(max(1 << max(16 * n - 1, 1).bit_length(), LEAST_BITS), MOST_BITS) // 64
    place = F.shiftrightunsigned("key", 6).bitwiseAND(F.lit(size - 1)).alias("place")
    rows = keys.groupBy(place).agg(F.expr("bit_or(shiftleft(1L, CAST(key & 63 AS INT)))").alias("bits")).toArrow()
    bits = np.zeros(size, np.uint64)
    bits[rows["place"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    return bits


def item_windows(items: DataFrame, text_col: str, id_col: str) -> tuple[DataFrame, DataFrame]:
    """``key, window, window_id`` of the distinct windows of all items, and ``window_id, item`` of those that hold them."""
    marked = items.select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("item"), _marks(None, None)(F.col(f"`{text_col}`")).alias("m"))
    marks = marked.select("item", F.explode("m.marks").alias("m")).select("item", "m.*")
    each = staged(_windows(marks).select("item", "key", "length", "window").distinct(), "item-windows")
    distinct = each.groupBy("window").agg(F.first("key").alias("key"), F.first("length").alias("length"))
    distinct = staged(distinct.withColumn("window_id", F.monotonically_increasing_id()), "windows")
    holders = each.select("window", "item").join(distinct.select("window", "window_id"), "window").select("window_id", "item")
    return distinct, staged(holders, "window-items")


def contaminated(
    df: DataFrame, items: DataFrame, text_col: str = "text", item_text_col: str = "text", item_id_col: str = "item_id", carry: list[str] | None = None
) -> DataFrame:
    """The columns ``carry`` of ``df`` (all, if not given) with the passages of ``items`` in its texts.

    ``n_words``; ``spans``, the runs of hit words ``[start, end)`` in order; ``n_items`` with occurring windows; and
    ``items_sha256``, the digest of their ids, sorted as strings and joined by commas.
    """
    columns = df.columns if carry is None else carry
    windows, holders = item_windows(items, item_text_col, item_id_col)
    lengths = sorted(r["length"] for r in windows.select("length").distinct().collect())
    keys = staged(windows.select("key").distinct(), "item-prints")
    marker = _marks(lengths, _bitmap(keys))
    rows = packed(df.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*columns, text_col])]), text=F.col(f"`{text_col}`"))
    kept = F.struct(*[F.col("row").getField(c).alias(c) for c in columns])
    rows = staged(rows.select(kept.alias("row"), marker("text").alias("m"), F.monotonically_increasing_id().alias("place")), "winnowed")

    prints = rows.select("place", F.explode("m.marks").alias("m")).select("place", "m.*")
    met = prints.join(broadcast_within(keys, 16), "key", "left_semi").select("place", "first", "length", "span")
    small = broadcast_within(windows.select("window", "window_id"), F.octet_length("window") + 16)
    # A window has one fingerprint in a document, so it comes out once per place.
    hits = staged(_windows(met).join(small, "window").select("place", "start", "length", "window_id"), "window-hits")
    # A document's windows, which it holds itself anyway, run together where they touch or overlap.
    before = W.partitionBy("place").orderBy("start", "end")
    runs = hits.withColumn("end", F.col("start") + F.col("length"))
    runs = runs.withColumn("reach", F.max("end").over(before.rowsBetween(W.unboundedPreceding, -1)))
    runs = runs.withColumn("run", F.sum(F.coalesce(F.col("start") > F.col("reach"), F.lit(True)).cast("int")).over(before))
    runs = runs.groupBy("place", "run").agg(
        F.struct(F.min("start").alias("start"), F.max("end").alias("end")).alias("span"), F.collect_set("window_id").alias("held")
    )
    held = runs.groupBy("place").agg(
        F.array_sort(F.collect_list("span")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("held")))).alias("held")
    )
    held = staged(held, "held-windows")
    sets = staged(held.select("held").distinct().withColumn("set", F.monotonically_increasing_id()), "window-sets")
    ids = sets.select("set", F.explode("held").alias("window_id")).join(holders, "window_id").select("set", "item").distinct()
    ids = ids.groupBy("set").agg(F.count("*").alias("n_items"), F.sha2(F.array_join(F.array_sort(F.collect_list("item")), ","), 256).alias("items_sha256"))
    named = sets.join(ids, "set").select("held", "n_items", "items_sha256")
    told = staged(held.join(named, "held").select("place", "spans", "n_items", "items_sha256"), "contaminated")
    # A span and its row take no more than that.
    out = rows.join(broadcast_within(told, F.size("spans") * 8 + 100), "place", "left")
    return unpacked(
        out,
        columns,
        n_words=F.col("m.n_words"),
        spans=F.coalesce("spans", F.array().cast("array<struct<start:int,end:int>>")),
        n_items=F.coalesce("n_items", F.lit(0).cast("long")),
        items_sha256=F.coalesce("items_sha256", F.sha2(F.lit(""), 256)),
    )


@query(
    """
    WITH w AS (
        SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
        FROM documents),
    b AS (
        SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
        FROM benchmark),
    iw AS (
        SELECT DISTINCT item, n, unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS win
        FROM (SELECT *, least(len(w), 10) AS n FROM b WHERE len(w) > 0)),
    lengths AS (SELECT DISTINCT n FROM iw),
    dw AS (
        SELECT r, n, unnest(range(1, len(w) - n + 2)) AS p,
               unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS win
        FROM w, lengths WHERE len(w) >= n),
    hit AS (SELECT dw.r, dw.p, dw.n, iw.item FROM dw JOIN iw ON dw.win = iw.win),
    words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(p, p + n)) AS p FROM hit) GROUP BY r),
    ids AS (SELECT r, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256 FROM (SELECT DISTINCT r, item FROM hit) GROUP BY r)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM w LEFT JOIN words USING (r) LEFT JOIN ids USING (r)
    """
)
def op11_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = contaminated(docs, table(spark, sf_dir, "benchmark"), carry=["doc_id"])
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), "n_items", "items_sha256", (n_hit > 0).alias("contaminated"))
