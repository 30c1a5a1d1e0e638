"""Exact duplicates by an exchange of Golomb-coded fingerprints.

Each block of rows (one task's rows, a bounded number at a time) hashes its normalised texts, sorts the
64-bit fingerprints and sends every owner of a hash range one message: the gaps in Golomb-Rice code and a
bitmap of those the block holds more than once. An owner decodes its messages and answers each with a
bitmap of the fingerprints that occur anywhere else. Only the rows so marked, the suspects, are shuffled
with their texts, and texts are compared byte by byte.

Texts are equal when identical after deleting ``[\\x20\\x09-\\x0D]``. Of equal texts the row with the most code
points stays, then the smallest id; of rows that agree in both, one. A null text counts as empty; a
null id sorts first; an empty table gives an empty result. Input columns stay, a result column replaces
one of its name.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from geoingest.llm.common import join_groups, packed, small_broadcast, staged, unpacked
from geoingest.llm.registry import query, table

BLANK = " \t\n\x0b\x0c\r"
#: A block ends with the Arrow batch that takes it past one of these.
BLOCK_ROWS, BLOCK_BYTES = 50_000, 12 << 20
#: An owner's share of the hashes, and the bounds of the number of owners (powers of two).
OWNER_HASHES, LEAST_OWNERS, MOST_OWNERS = 1 << 18, 16, 1 << 14


def golomb_encode(values: np.ndarray) -> bytes:
    """Golomb-Rice code of a strictly rising uint64 array: count, parameter, first value, unary parts, remainders."""
    if not len(values):
        return b""
    gaps = np.diff(values)
    mean = float(gaps.mean()) if len(gaps) else 1.0
    low = min(max(int(math.floor(math.log2(max(mean * math.log(2), 1.0)))), 0), 62)
    quotients = (gaps >> np.uint64(low)).astype(np.int64)
    unary = np.zeros(int(quotients.sum()) + len(gaps), dtype=np.uint8)
    unary[np.cumsum(quotients + 1) - 1] = 1
    places = np.arange(low, dtype=np.uint64)
    rest = ((gaps[:, None] >> places) & np.uint64(1)).astype(np.uint8)
    head = np.array([len(values), low, values[0], len(unary)], dtype=np.uint64).tobytes()
    return head + np.packbits(unary).tobytes() + np.packbits(rest.ravel()).tobytes()


def golomb_decode(code: bytes) -> np.ndarray:
    if not code:
        return np.zeros(0, dtype=np.uint64)
    n, low, first, n_unary = np.frombuffer(code[:32], dtype=np.uint64)
    n, low, n_unary = int(n), int(low), int(n_unary)
    cut = 32 + (n_unary + 7) // 8
    unary = np.unpackbits(np.frombuffer(code[32:cut], dtype=np.uint8), count=n_unary)
    gaps = np.diff(np.flatnonzero(unary), prepend=-1).astype(np.uint64) - np.uint64(1)
    gaps <<= np.uint64(low)
    if low and n > 1:
        bits = np.unpackbits(np.frombuffer(code[cut:], dtype=np.uint8), count=(n - 1) * low).reshape(n - 1, low)
        gaps += bits.astype(np.uint64) @ (np.uint64(1) << np.arange(low, dtype=np.uint64))
    return first + np.concatenate([np.zeros(1, np.uint64), np.cumsum(gaps, dtype=np.uint64)])


def _fingerprint(owner_bits: int, schema: pa.Schema):
    """Arrow batches of ``row, text`` to rows with digest and place, and one message per block and owner."""

    def block_rows(batches: list[pa.RecordBatch], block: int):
        rows = [b.column("row") for b in batches]
        digests = [
            hashlib.sha256((t.as_buffer().to_pybytes() if t.is_valid else b"").translate(None, BLANK.encode())).digest()
            for b in batches
            for t in b.column("text").cast(pa.binary())
        ]
        prints = np.frombuffer(b"".join(digests), dtype=">u8").astype(np.uint64)[::4]
        distinct, place, counts = np.unique(prints, return_inverse=True, return_counts=True)
        owners = (distinct >> np.uint64(64 - owner_bits)).astype(np.int32)
        named, first, n = np.unique(owners, return_index=True, return_counts=True)
        start = np.repeat(first, n)
        yield pa.RecordBatch.from_arrays(
            [
                (pa.concat_arrays(rows) if len(rows) > 1 else rows[0]).cast(schema.field(0).type),
                pa.array(digests, pa.binary()),
                pa.array(np.full(len(prints), block), pa.int64()),
                pa.array(np.arange(len(prints)), pa.int32()),
                pa.array(owners[place], pa.int32()),
                pa.array((np.arange(len(distinct)) - start)[place], pa.int32()),
                pa.nulls(len(prints), pa.binary()),
                pa.nulls(len(prints), pa.binary()),
                pa.array(np.zeros(len(prints)), pa.int32()),
            ],
            schema=schema,
        )
        codes = [golomb_encode(distinct[a : a + k]) for a, k in zip(first, n)]
        repeats = [np.packbits(counts[a : a + k] > 1).tobytes() for a, k in zip(first, n)]
        m = len(named)
        yield pa.RecordBatch.from_arrays(
            [
                pa.nulls(m, schema.field(0).type),
                pa.nulls(m, pa.binary()),
                pa.array(np.full(m, block), pa.int64()),
                pa.nulls(m, pa.int32()),
                pa.array(named, pa.int32()),
                pa.nulls(m, pa.int32()),
                pa.array(codes, pa.binary()),
                pa.array(repeats, pa.binary()),
                pa.array(np.ones(m), pa.int32()),
            ],
            schema=schema,
        )

    def run(batches):
        block, held, n, size = TaskContext.get().partitionId() << 32, [], 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            n, size = n + batch.num_rows, size + batch.nbytes
            if n >= BLOCK_ROWS or size >= BLOCK_BYTES:
                yield from block_rows(held, block)
                block, held, n, size = block + 1, [], 0, 0
        if held:
            yield from block_rows(held, block)
        pa.default_memory_pool().release_unused()

    return run


def _answer(messages: pd.DataFrame) -> pd.DataFrame:
    """An owner's answer to each of its messages: a bitmap of the fingerprints that occur more than once."""
    lists = [golomb_decode(code) for code in messages["code"]]
    repeated = [np.unpackbits(np.frombuffer(r, dtype=np.uint8), count=len(x)) for r, x in zip(messages["repeats"], lists)]
    distinct, where, counts = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
    marked = (counts > 1)[where] | (np.concatenate(repeated) > 0)
    ends = np.cumsum([len(x) for x in lists])
    bitmaps = [np.packbits(part) for part in np.split(marked, ends[:-1])]
    some = [bool(b.any()) for b in bitmaps]
    return pd.DataFrame({
        "block": messages["block"][some], "owner": messages["owner"][some], "bitmap": [b.tobytes() for b, s in zip(bitmaps, some) if s],
    })


def _bit(bitmap: Column, place: Column) -> Column:
    """Bit ``place`` of a bitmap, highest bit of each byte first."""
    byte = F.conv(F.hex(F.substring(bitmap, F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.floor(byte / F.pow(F.lit(2), 7 - place % 8)) % 2 == 1


def exact_dedup(df: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The rows of ``df`` with ``keep_id``, ``group_size``, ``kept`` and ``text_sha256`` (hex, of the normalised text)."""
    names = ("keep_id", "group_size", "kept", "text_sha256")
    return unpacked(_grouped(df, text_col, id_col), df.columns, **{n: F.col(n) for n in names})


def _grouped(df: DataFrame, text_col: str, id_col: str) -> DataFrame:
    """``row`` and the results beside it."""
    n = df.select(text_col).count()
    owners = min(max(2 ** math.ceil(math.log2(max(n, 1) / OWNER_HASHES)) if n > OWNER_HASHES else 0, LEAST_OWNERS), MOST_OWNERS)
    rows = packed(df, text=F.col(f"`{text_col}`"))
    schema = T.StructType([
        T.StructField("row", rows.schema["row"].dataType),
        T.StructField("sha", T.BinaryType()),
        T.StructField("block", T.LongType()),
        T.StructField("seq", T.IntegerType()),
        T.StructField("owner", T.IntegerType()),
        T.StructField("place", T.IntegerType()),
        T.StructField("code", T.BinaryType()),
        T.StructField("repeats", T.BinaryType()),
        T.StructField("kind", T.IntegerType()),
    ])
    sent = staged(rows.mapInArrow(_fingerprint(int(math.log2(owners)), to_arrow_schema(schema)), schema), "fingerprints", "kind")
    messages = sent.where("kind = 1").select("block", "owner", "code", "repeats")
    bitmaps = messages.groupBy("owner").applyInPandas(_answer, "block long, owner int, bitmap binary")
    bitmaps = staged(bitmaps, "bitmaps")

    row, text = F.col("row"), F.coalesce(F.col("row").getField(text_col), F.lit(""))
    own = sent.where("kind = 0").select("row", "sha", "block", "seq", "owner", "place")
    marked = own.join(small_broadcast(bitmaps), ["block", "owner"], "left")
    suspect = F.col("bitmap").isNotNull() & _bit(F.col("bitmap"), F.col("place"))
    marked = marked.withColumn("suspect", F.coalesce(suspect, F.lit(False)))
    suspects = marked.where("suspect")

    # Byte verification: one digest must stand for one text; the texts go no further than this.
    norm = F.translate(text, BLANK, "")
    texts = suspects.groupBy("sha", norm.alias("norm")).agg(F.count("*").alias("n"))
    groups = texts.groupBy("sha").agg(F.sum("n").alias("group_size"), F.count("*").alias("texts"))
    clash = F.raise_error(F.lit("two texts share a SHA-256 digest"))
    groups = groups.select("sha", F.when(F.col("texts") == 1, F.col("group_size")).otherwise(clash).alias("group_size"))
    order = F.struct(-F.length(text), row.getField(id_col).alias("id"), F.col("block"), F.col("seq"))
    heads = suspects.select("sha", order.alias("head")).groupBy("sha").agg(F.min("head").alias("head"))
    groups = staged(groups.join(heads, "sha"), "exact-groups")

    hit = join_groups(suspects.select("row", "sha", "block", "seq"), groups, "sha", "group_size")
    grouped = hit.select(
        "row", "sha", F.col("head.id").alias("keep_id"), "group_size",
        ((F.col("block") == F.col("head.block")) & (F.col("seq") == F.col("head.seq"))).alias("kept"),
    )
    single = marked.where("not suspect").select(
        "row", "sha", row.getField(id_col).alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept")
    )
    return grouped.unionByName(single).withColumn("text_sha256", F.lower(F.hex("sha")))


@query(
    """
    WITH norm AS (
        SELECT doc_id, length(coalesce(text, '')) AS n,
               regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS body
        FROM documents),
    ranked AS (
        SELECT *, row_number() OVER (PARTITION BY body ORDER BY n DESC, doc_id) AS rank,
               first_value(doc_id) OVER (PARTITION BY body ORDER BY n DESC, doc_id) AS keep_id,
               count(*) OVER (PARTITION BY body) AS group_size
        FROM norm)
    SELECT doc_id, keep_id, group_size, rank = 1 AS kept, sha256(body) AS text_sha256 FROM ranked
    """
)
def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return exact_dedup(docs).drop("text")


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline: of equal texts one document stays."""
    return unpacked(_grouped(docs, "text", "doc_id").where("kept"), docs.columns)
