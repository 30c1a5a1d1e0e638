"""Exact top-k search by inner product over an impact-ordered index, score at a time.

Vectors are dealt to shards by hash, those of similar length together. A task holds the index of one shard at a time: per dimension
the vectors in order of their component, cut into posting segments of equal quantised impact. The queries come to it
one after the other, so an index is built once and never sent. A query takes all segments of a shard by
descending impact, that is by the most a posting can add to the least contribution of its dimension, and adds
up scores. From time to time it bounds what every vector can still gain; the search stops only when
all vectors but a few provably score below the k-th best so far, and these few are scored exactly.

The best k of each shard meet in one ordered cut per query. Queries meet every shard, so there are as few shards as
``SHARD_BYTES`` and the cores allow.

Defined results: vectors that are null, or hold null or non-finite components take no part, nor do rows without
an id; an empty vector scores 0; rows that repeat an id or a vector are candidates and queries each on their own, only a query's own row is no candidate of it; a
shorter vector is read as if zeros followed; scores beyond 64 bits are held at their ends; fewer candidates than k
give all of them; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from geoingest.llm.common import staged
from geoingest.llm.registry import query, table

K = 10
SCALE = 1024
#: Bytes of a shard's components and its least number of rows, on average; levels of quantised impact per dimension.
SHARD_BYTES, SHARD_ROWS, LEVELS = 64 << 20, 2_000, 8
#: Shares of the segments after which the bounds are looked at; vectors that may remain when the search stops.
LOOKS = (0.35, 0.5, 0.6, 0.7, 0.8, 0.9)
FEW = 512


class Index:
    """The posting segments of one shard."""

    def __init__(self, places: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")
        self.places, self.ids, self.vectors = places[order], ids[order], vectors[order]
        self.order = np.ascontiguousarray(np.argsort(self.vectors, axis=0, kind="stable").astype(np.int32).T)
        #: Components in the order of their postings.
        self.sorted = np.ascontiguousarray(np.sort(self.vectors, axis=0).T)
        self.cuts: list[np.ndarray] = []
        for j in range(vectors.shape[1]):
            values = self.sorted[j].astype(np.float64)
            width = max((values[-1] - values[0]) / LEVELS, 1.0)
            level = np.floor((values - values[0]) / width)
            self.cuts.append(np.concatenate([[0], np.flatnonzero(np.diff(level)) + 1, [len(values)]]))

    def search(self, own: int, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the ``k`` best but for the row at ``own``, ties to the smaller id."""
        dims = min(len(q), self.vectors.shape[1])
        vectors, q = self.vectors[:, :dims], q[:dims]
        most = float(np.abs(vectors).max(initial=0)) * float(np.abs(q).max(initial=0)) * max(dims, 1)
        if most >= 2**62:
            exact = vectors.astype(object) @ q.astype(object)
            return self._best(np.arange(len(exact)), np.clip(exact, -(2**63), 2**63 - 1).astype(np.int64), own, k)
        alive = self._possible(own, q, k)
        return self._best(alive, vectors[alive] @ q, own, k)

    def _best(self, places: np.ndarray, scores: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        other = self.places[places] != own
        places, scores = places[other], scores[other]
        top = np.lexsort((self.ids[places], ~scores))[:k]
        return self.ids[places[top]], scores[top]

    def _possible(self, own: int, q: np.ndarray, k: int) -> np.ndarray:
        """Places of all vectors that may be among the best ``k``."""
        n = len(self.ids)
        segments = []
        least = np.zeros(len(q), dtype=np.int64)
        for j in np.flatnonzero(q):
            w, values, cuts = q[j], self.sorted[j], self.cuts[j]
            least[j] = min(w * values[0], w * values[-1])
            tops = values[cuts[1:] - 1 if w > 0 else cuts[:-1]] * w - least[j]
            segments.extend(zip(tops.tolist(), [int(j)] * len(tops), cuts[:-1].tolist(), cuts[1:].tolist()))
        segments.sort(key=lambda s: -s[0])
        following: dict[int, list[float]] = {}
        for top, j, _, _ in segments:
            following.setdefault(j, []).append(top)
        bound = np.zeros(len(q), dtype=np.float32)
        for j, tops in following.items():
            bound[j] = tops[0]
        taken = dict.fromkeys(following, 0)
        scores = np.zeros(n, dtype=np.int64)
        scores[self.places == own] = np.iinfo(np.int64).min // 2
        open_ = np.ones((len(q), n), dtype=np.float32)
        looks = {int(len(segments) * share) for share in LOOKS}
        for at, (_, j, a, b) in enumerate(segments, 1):
            members = self.order[j, a:b]
            scores[members] += self.sorted[j, a:b] * q[j] - least[j]
            open_[j, members] = 0
            taken[j] += 1
            bound[j] = following[j][taken[j]] if taken[j] < len(following[j]) else 0
            if at in looks and n > k:
                # Nothing is lost below what a vector has so far; rounding is covered by the last factor.
                floor = np.partition(scores, n - k)[n - k]
                alive = np.flatnonzero(scores + (bound @ open_) * np.float32(1.0001) + 1 >= floor)
                if len(alive) <= FEW:
                    return alive
        if n <= k:
            return np.arange(n)
        return np.flatnonzero(scores >= np.partition(scores, n - k)[n - k])


def _matrix(vectors: pa.ListArray) -> np.ndarray:
    """Rows of equal length, padded with zeros."""
    sizes = np.diff(vectors.offsets.to_numpy())
    width = int(sizes.max(initial=0))
    out = np.zeros((len(vectors), width), dtype=np.int64)
    out[np.arange(width) < sizes[:, None]] = vectors.flatten().to_numpy()
    return out


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows in order of shard and role: the vectors of a shard (role 0), then the queries (role 1)."""
        shard, index, held = None, None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            shards, roles = batch.column("shard").to_numpy(), batch.column("role").to_numpy()
            new = np.flatnonzero((shards[1:] != shards[:-1]) | (roles[1:] != roles[:-1])) + 1
            for a, z in zip([0, *new.tolist()], [*new.tolist(), len(shards)]):
                part = batch.slice(a, z - a)
                if shards[a] != shard:
                    shard, index, held = shards[a], None, []
                if roles[a] == 0:
                    held.append(part)
                    continue
                if index is None:
                    columns = [pa.concat_arrays([p.column(c) for p in held]) for c in ("place", "vec_id", "vector")]
                    index, held = Index(columns[0].to_numpy(), columns[1].to_numpy(), _matrix(columns[2])), []
                out: list[tuple[int, int, int, int]] = []
                for place, vec_id, vector in zip(*(part.column(c) for c in ("place", "vec_id", "vector"))):
                    place, vec_id = place.as_py(), vec_id.as_py()
                    ids, scores = index.search(place, vector.values.to_numpy(), k)
                    out.extend(zip([place] * len(ids), [vec_id] * len(ids), ids.tolist(), scores.tolist()))
                columns = zip(*out) if out else [[]] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["place", "query_id", "vec_id", "score"])

    return run


def scaled(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``place, vec_id, vector``, staged: components as ``floor(SCALE * x)``; only vectors that take part."""
    v = F.col(f"`{vector_col}`")
    whole = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    kept = df.where(v.isNotNull() & F.col(f"`{id_col}`").isNotNull() & F.coalesce(whole, F.lit(False)))
    rows = kept.select(
        F.monotonically_increasing_id().alias("place"),
        F.col(f"`{id_col}`").cast("long").alias("vec_id"),
        F.transform(v, lambda x: F.floor(x.cast("double") * SCALE).cast("long")).alias("vector"),
    )
    return staged(rows, "vectors")


def search(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """The ``k`` best of ``vectors(place, vec_id, vector)`` for each of ``queries``, rows of the same kind: ``query_id, rank, vec_id, score``."""
    # Vectors are padded to the longest of their shard: lengths of one power of two go together.
    wide = F.ceil(F.log2(F.greatest(F.size("vector"), F.lit(1)))).cast("int")
    classes = sorted((r["wide"], r["n"]) for r in vectors.groupBy(wide.alias("wide")).agg(F.count("*").alias("n")).collect())
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    shard, total = F.lit(0), 0
    for width, n in classes:
        shards = max(math.ceil(n * 8 * 2**width / SHARD_BYTES), min(cores, math.ceil(n / SHARD_ROWS)))
        dealt = F.pmod(F.xxhash64("place"), F.lit(shards)).cast("int") + total
        shard, total = F.when(wide == width, dealt).otherwise(shard), total + shards
    names = ["shard", "role", "place", "vec_id", "vector"]
    rows = vectors.withColumn("shard", shard).withColumn("role", F.lit(0)).select(*names)
    # The stated queries against every shard.
    asked = queries.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(max(total - 1, 0))))).withColumn("role", F.lit(1))
    # By range, as a hash of so few numbers would put several shards into one task.
    dealt = rows.unionByName(asked.select(*names)).repartitionByRange(max(total, 1), "shard").sortWithinPartitions("shard", "role")
    found = dealt.mapInArrow(_search(k), "place long, query_id long, vec_id long, score long")
    rank = F.row_number().over(W.partitionBy("place").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


@query(
    f"""
    WITH v AS (
        SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS e FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    pairs AS (
        SELECT q.r, q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
        FROM v AS q, v AS c WHERE q.vec_id % 100 = 0 AND q.r <> c.r)
    SELECT query_id, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
    FROM pairs QUALIFY rank <= {K}
    """
)
def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = scaled(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return search(vectors, vectors.where("vec_id % 100 = 0"))
