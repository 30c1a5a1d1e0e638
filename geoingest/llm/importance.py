"""Documents drawn by how much they look like a target: hashed n-gram importance weights and Gumbel top-k.

Texts are cut into words with offsets by a tokenizers pre-tokeniser, an untrained split by a regular expression over the
ASCII-lowered text. Runs of one to three words are windows over pairs of those offsets, each hashed by CRC-32 into
one of ``BUCKETS`` buckets. The bucket histograms of the corpus and of the target give every bucket a gain, the
log ratio of their smoothed shares in thousandths; a document's weight is the sum over its features. With Gumbel noise
from the document's id the highest scores are a sample without replacement in proportion to the weights.

Words are cut once: the buckets of each document are staged as two-byte numbers, and both the histogram and the weights
read them from there. Histograms are summed per task before they are shuffled, and the gains, one number per bucket,
are all that comes to the driver. Ranks come from partitions by range of the score, counted and numbered
apart, so that no task holds all scores.

Defined results: a null or wordless text has no features and weight 0; a document of fewer than ``LEAST_WORDS`` words is
weighed and never drawn; a null id hashes as the empty text and comes first in ties; repeated rows are drawn each on
its own; without documents or target texts counts are 0. Input columns named in ``carry`` stay, a result column
replaces one of its name.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Regex, pre_tokenizers

from geoingest.llm.common import packed, staged, unpacked
from geoingest.llm.registry import query, table
from geoingest.llm.spelling import CRC_OF, CRC_TABLE

BUCKETS = 10_000
MOST_WORDS = 3
LEAST_WORDS = 20
#: Percent of the documents of enough words that are drawn.
DRAWN = 5
#: Everything but digits, letters and what lies beyond ASCII parts words.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@cache
def splitter() -> pre_tokenizers.PreTokenizer:
    return pre_tokenizers.Split(Regex(WORD), behavior="removed", invert=True)


def buckets_of(text: bytes) -> tuple[int, np.ndarray]:
    """Number of words, and the buckets of all features: those of one word, of two, of three.

    The words stand in one buffer, each behind a space, where their offsets follow from those in the text. A window
    goes on from the checksum of the window of one word less with the bytes between both ends.
    """
    tokens = splitter().pre_tokenize_str(text.lower().decode("utf-8", "replace"))
    if not tokens:
        return 0, np.zeros(0, np.uint16)
    words, offsets = zip(*tokens)
    spaced = " " + " ".join(words)
    bounds = np.fromiter(chain.from_iterable(offsets), np.int64, 2 * len(words))
    ends = np.cumsum(bounds[1::2] - bounds[::2] + 1)
    if not spaced.isascii():
        points = np.frombuffer(spaced.encode("utf-32-le"), np.uint32)
        ends = np.cumsum(1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000))[ends - 1]
    ends = ends.tolist()
    parts = list(map(spaced.encode().__getitem__, map(slice, [0, *ends], ends)))
    sums = [zlib.crc32(x[1:]) for x in parts]
    out = [*sums]
    for k in range(1, MOST_WORDS):
        sums = list(map(zlib.crc32, parts[k:], sums))
        out += sums
    return len(words), (np.fromiter(out, np.uint32, len(out)) % BUCKETS).astype(np.uint16)


_FEATURES = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("buckets", T.BinaryType())])


@F.arrow_udf(_FEATURES)
def _features(texts: pa.Array) -> pa.Array:
    found = [buckets_of(t.as_py() or b"") for t in texts.cast(pa.binary())]
    columns = [pa.array([n for n, _ in found], pa.int64()), pa.array([b.tobytes() for _, b in found], pa.binary())]
    return pa.StructArray.from_arrays(columns, ["n_words", "buckets"])


def _histogram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for x in batch.column("buckets"):
            counts += np.bincount(np.frombuffer(x.as_buffer(), np.uint16), minlength=BUCKETS)
    some = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(counts[some])], ["bucket", "n"])


def gains(corpus: DataFrame, target: DataFrame) -> np.ndarray:
    """Gain of each bucket from rows with ``buckets`` of both sides; one row per bucket comes to the driver."""
    sides = []
    for name, df in (("s", corpus), ("t", target)):
        counts = df.select("buckets").mapInArrow(_histogram, "bucket long, n long")
        sides.append(counts.groupBy("bucket").agg(F.sum("n").cast("double").alias(name)))
    every = corpus.sparkSession.range(BUCKETS).select(F.col("id").alias("bucket"))
    both = every.join(sides[0], "bucket", "left").join(sides[1], "bucket", "left").na.fill(0.0, ["s", "t"])
    rows = staged(both, "bucket-counts")
    total = rows.agg(F.sum("s").alias("s"), F.sum("t").alias("t")).first()
    ratio = ((F.col("t") + 1) * (total["s"] + BUCKETS)) / ((F.col("s") + 1) * (total["t"] + BUCKETS))
    found = rows.select("bucket", F.floor(1000 * F.log(ratio)).cast("long").alias("gain")).toArrow()
    out = np.zeros(BUCKETS, np.int64)
    out[found["bucket"].to_numpy()] = found["gain"].to_numpy()
    return out


def _weighed(gain: np.ndarray):
    @F.arrow_udf(T.LongType())
    def weigh(buckets: pa.Array) -> pa.Array:
        return pa.array([int(gain[np.frombuffer(x.as_buffer(), np.uint16)].sum()) for x in buckets], pa.int64())

    return weigh


def gumbel(id_: Column, seed: int = 42) -> Column:
    """Noise in thousandths from the first 32 bits of a digest of seed and id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def ranked(scores: DataFrame, order: list[Column], draw: int) -> DataFrame:
    """``place, rank`` of the first ``draw`` rows in ``order``, which must tell all rows apart.

    Rows are dealt by range of the order; a row's rank is its number in its partition and the rows before that.
    """
    dealt = scores.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    dealt = staged(dealt, "score-ranges")
    # One row per partition.
    before = F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    starts = dealt.groupBy("part").agg(F.count("*").alias("n")).select("part", F.coalesce(before, F.lit(0)).alias("start")).where(F.col("start") < draw)
    inside = F.row_number().over(W.partitionBy("part").orderBy(*order))
    return dealt.join(F.broadcast(starts), "part").withColumn("rank", F.col("start") + inside).where(F.col("rank") <= draw).select("place", "rank")


def importance_sample(
    df: DataFrame, target: DataFrame, text_col: str = "text", id_col: str = "doc_id", target_text_col: str = "text", seed: int = 42, carry: list[str] | None = None
) -> DataFrame:
    """The columns ``carry`` of ``df`` (all, if not given) with ``n_words, n_features, weight, score`` and the ``rank`` of the drawn."""
    columns = df.columns if carry is None else carry
    rows = packed(df.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*columns, text_col, id_col])]))
    text, doc_id = F.col("row").getField(text_col), F.col("row").getField(id_col)
    kept = F.struct(*[F.col("row").getField(c).alias(c) for c in columns])
    rows = rows.select(kept.alias("row"), doc_id.alias("id"), F.monotonically_increasing_id().alias("place"), _features(text).alias("f"))
    rows = staged(rows.select("row", "id", "place", "f.*"), "features")
    goal = target.select(_features(F.col(f"`{target_text_col}`")).alias("f")).select("f.buckets")
    weigh = _weighed(gains(rows, goal))
    scored = rows.select("row", "id", "place", "n_words", F.floor(F.octet_length("buckets") / 2).alias("n_features"), weigh("buckets").alias("weight"))
    scored = staged(scored.withColumn("score", F.col("weight") + gumbel(F.col("id"), seed)), "scores")
    enough = scored.where(F.col("n_words") >= LEAST_WORDS)
    draw = DRAWN * enough.count() // 100
    order = [F.col("score").desc(), F.col("id").asc_nulls_first(), F.col("place")]
    drawn = staged(ranked(enough.select("place", "score", "id"), order, draw), "drawn")
    out = scored.join(drawn.hint("merge"), "place", "left")
    return unpacked(out, columns, **{c: F.col(c) for c in ("n_words", "n_features", "weight", "score", "rank")})


_SQL_WORDS = """regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w"""
_SQL_FEATURES = """unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])
            || list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS f"""


@query(
    f"""
    WITH crc AS ({CRC_TABLE}),
    docs AS (SELECT doc_id, row_number() OVER () AS r, {_SQL_WORDS} FROM documents),
    items AS (SELECT {_SQL_WORDS} FROM benchmark),
    df AS (SELECT r, f, count(*) AS n FROM (SELECT r, {_SQL_FEATURES} FROM docs) GROUP BY r, f),
    bf AS (SELECT f, count(*) AS n FROM (SELECT {_SQL_FEATURES} FROM items) GROUP BY f),
    hashed AS (SELECT f, {CRC_OF.format(x="f")} % 10000 AS bucket FROM (SELECT f FROM df UNION SELECT f FROM bf), crc),
    s AS (SELECT bucket, sum(n) AS s FROM df JOIN hashed USING (f) GROUP BY bucket),
    t AS (SELECT bucket, sum(n) AS t FROM bf JOIN hashed USING (f) GROUP BY bucket),
    both_ AS (
        SELECT b AS bucket, CAST(coalesce(s, 0) AS DOUBLE) AS s, CAST(coalesce(t, 0) AS DOUBLE) AS t
        FROM range(10000) AS r(b) LEFT JOIN s ON s.bucket = b LEFT JOIN t ON t.bucket = b),
    gain AS (
        SELECT bucket, CAST(floor(1000 * ln((t + 1) * (sum(s) OVER () + 10000) / ((s + 1) * (sum(t) OVER () + 10000)))) AS BIGINT) AS gain
        FROM both_),
    weighed AS (SELECT r, CAST(sum(n * gain) AS BIGINT) AS weight FROM df JOIN hashed USING (f) JOIN gain USING (bucket) GROUP BY r),
    scored AS (
        SELECT doc_id, r, len(w) AS n_words, CAST(len(w) + greatest(len(w) - 1, 0) + greatest(len(w) - 2, 0) AS BIGINT) AS n_features,
               coalesce(weight, 0) AS weight,
               coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((
                   ('0x' || substring(sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
        FROM docs LEFT JOIN weighed USING (r)),
    drawn AS (
        SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS FIRST, r) AS rank, count(*) OVER () AS n FROM scored WHERE n_words >= 20)
    SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 5 * n // 100 THEN rank END AS rank FROM scored LEFT JOIN drawn USING (r)
    """
)
def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = importance_sample(docs, table(spark, sf_dir, "benchmark"), carry=["doc_id"])
    return found.select("doc_id", *[F.col(c).cast("long").alias(c) for c in ("n_features", "weight", "score", "rank")])
