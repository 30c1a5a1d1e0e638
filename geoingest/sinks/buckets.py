"""Keyed tables in hash buckets, of which a batch rewrites only those that it touches.

The table is plain Parquet, partitioned by ``_bucket``, a hash of the key. A batch names its buckets; they alone are
read, by partition pruning, merged with the batch and put in place by dynamic partition overwrite. The merged buckets
are written beside the table first and stay there until they are in place, so a commit that dies is finished by the
next one instead of leaving a bucket half replaced. Each bucket keeps the tag of the batch it was last written by; a
batch that is replayed with its tag passes over the buckets that hold it. Batches must come one after the other.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoingest.operators.failures import UNKNOWN_KEY, record_failures
from geoingest.operators.merge import DO_UPDATE, soft_delete_entities, upsert_entities
from geoingest.schemas import ENTITY_TABLE, FAILURE_TABLE, KEY

BUCKETS = 64
_OUTCOMES = ("n_inserted", "n_updated", "n_skipped")


class BucketTable:
    """``buckets`` is fixed when the table is made: a bucket should fit a task, as one file of some hundred MB."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, buckets: int = BUCKETS) -> None:
        self.spark, self.path, self.schema, self.buckets = spark, path.rstrip("/"), schema, buckets
        self._stored = T.StructType([*schema.fields, T.StructField("_batch", T.StringType()), T.StructField("_bucket", T.IntegerType())])

    def _at(self, path: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()), where

    def _exists(self, path: str) -> bool:
        fs, where = self._at(path)
        return fs.exists(where)

    def _all(self) -> DataFrame:
        if not self._exists(self.path):
            return self.spark.createDataFrame([], self._stored)
        return self.spark.read.schema(self._stored).parquet(self.path)

    def read(self) -> DataFrame:
        self._finish()
        return self._all().select(*self.schema.fieldNames())

    def bucket_of(self, df: DataFrame) -> DataFrame:
        return df.withColumn("_bucket", F.pmod(F.xxhash64(*KEY), F.lit(self.buckets)).cast("int"))

    def _finish(self) -> None:
        """Put merged buckets in place that a commit has written as a whole, and clear them away."""
        ready = f"{self.path}.ready"
        if self._exists(f"{ready}/_SUCCESS"):
            merged = self.spark.read.schema(self._stored).parquet(ready)
            merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_bucket").parquet(self.path)
        fs, where = self._at(ready)
        fs.delete(where, True)

    def apply(self, batch: DataFrame, change: Callable[[DataFrame, DataFrame], DataFrame], tag: str | None = None) -> list[int]:
        """Replace the buckets that the keys of ``batch`` fall into by ``change(rows of those buckets, batch)``.

        Returns the buckets. ``change`` keeps the keys in their buckets, as all keyed merges do, and drops none.
        """
        self._finish()
        dealt = self.bucket_of(batch)
        # One number per bucket comes to the driver.
        touched = sorted(r[0] for r in dealt.select("_bucket").distinct().collect())
        if tag is not None:
            held = self._all().where(F.col("_bucket").isin(touched) & (F.col("_batch") == tag)).select("_bucket").distinct()
            touched = sorted(set(touched) - {r[0] for r in held.collect()})
        if not touched:
            return []
        rows = self._all().where(F.col("_bucket").isin(touched)).select(*self.schema.fieldNames())
        merged = change(rows, dealt.where(F.col("_bucket").isin(touched)).drop("_bucket"))
        merged = self.bucket_of(merged.select(*self.schema.fieldNames())).withColumn("_batch", F.lit(tag).cast("string"))
        merged.repartition("_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(f"{self.path}.ready")
        self._finish()
        return touched

    def upsert(
        self, entities: DataFrame, now: Column, *, on_conflict: str = DO_UPDATE, soft_delete: bool = True, tag: str | None = None
    ) -> dict[str, int]:
        """``upsert_entities`` on the buckets of ``entities``; what became of the rows, none for buckets that hold the tag."""
        sums = dict.fromkeys(_OUTCOMES, 0)

        def change(rows: DataFrame, batch: DataFrame) -> DataFrame:
            merged, outcomes = upsert_entities(rows, batch, now, on_conflict=on_conflict, soft_delete=soft_delete)
            told = outcomes.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in _OUTCOMES]).first()
            sums.update(told.asDict())
            return merged

        self.apply(entities, change, tag)
        return sums

    def soft_delete(self, keys: DataFrame, now: Column, *, tag: str | None = None) -> int:
        """``soft_delete_entities`` on the buckets of ``keys``; the number of rows removed."""
        removed = 0

        def change(rows: DataFrame, batch: DataFrame) -> DataFrame:
            nonlocal removed
            updated, changed = soft_delete_entities(rows, batch, now)
            removed = changed.count()
            return updated

        self.apply(keys.where("source IS NOT NULL AND source_id IS NOT NULL").select(*KEY), change, tag)
        return removed

    def record_failures(self, events: DataFrame, now: Column, *, tag: str | None = None) -> None:
        """``record_failures`` on the buckets of ``events``; with a tag a replay counts no attempt twice."""
        named = events.withColumns({k: F.coalesce(F.col(k), F.lit(UNKNOWN_KEY)) for k in KEY})
        self.apply(named, lambda rows, batch: record_failures(rows, batch, now), tag)


def bucketed_entities(spark: SparkSession, path: str, buckets: int = BUCKETS) -> BucketTable:
    return BucketTable(spark, path, ENTITY_TABLE, buckets)


def bucketed_failures(spark: SparkSession, path: str, buckets: int = BUCKETS) -> BucketTable:
    return BucketTable(spark, path, FAILURE_TABLE, buckets)
