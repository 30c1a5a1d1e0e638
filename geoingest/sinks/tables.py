"""Versioned Parquet tables, run log append and optional JDBC landing."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoingest.functions.jsonmerge import json_merge, keep_old
from geoingest.operators.merge import as_stored, fold_batch
from geoingest.schemas import ENTITY_TABLE, FAILURE_TABLE, KEY, RUN_LOG


class VersionedTable:
    """A table that is rewritten as a whole: each commit is a new folder, the newest finished one counts.

    A reader of the old version is not disturbed, and a commit that dies leaves an unfinished folder
    which the next commit overwrites. A commit may carry a tag; a tag that was applied already tells a
    replayed batch from a new one.
    """

    _NAME = re.compile(r"^v(\d{10})(?:\.(.+))?$")

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType) -> None:
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    def _versions(self) -> list[tuple[int, str | None, str]]:
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        root = hadoop.Path(self.path)
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(root):
            return []
        found = []
        for entry in fs.listStatus(root):
            m = self._NAME.match(entry.getPath().getName())
            if m and fs.exists(hadoop.Path(entry.getPath(), "_SUCCESS")):
                found.append((int(m[1]), m[2], entry.getPath().toString()))
        return sorted(found)

    def _load(self, location: str | None) -> DataFrame:
        if location is None:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(location)

    def read(self) -> DataFrame:
        versions = self._versions()
        return self._load(versions[-1][2] if versions else None)

    def read_before(self, tag: str) -> DataFrame:
        """The version that the commit with ``tag`` was built on."""
        earlier: str | None = None
        for _, t, location in self._versions():
            if t == tag:
                break
            earlier = location
        return self._load(earlier)

    def read_tagged(self, tag: str) -> DataFrame:
        return self._load(next(location for _, t, location in self._versions() if t == tag))

    def has_version(self, tag: str) -> bool:
        return any(t == tag for _, t, _ in self._versions())

    def has(self, tag: str) -> bool:
        """Whether a commit with ``tag`` was made, also when its version is pruned since."""
        return self.has_version(tag) or self._fs().exists(self._marker(tag))

    def _fs(self):
        root = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return root.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _marker(self, tag: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/tags/{tag}")

    def commit(self, df: DataFrame, tag: str | None = None) -> DataFrame:
        """Write ``df`` as the next version and return it as read back."""
        versions = self._versions()
        number = versions[-1][0] + 1 if versions else 1
        location = f"{self.path}/v{number:010d}" + (f".{tag}" if tag else "")
        df.select(*self.schema.fieldNames()).write.mode("overwrite").parquet(location)
        return self._load(location)

    def prune(self, keep: int = 3) -> None:
        """Delete all but the newest ``keep`` versions; their tags stay known."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        for _, tag, location in self._versions()[: -max(keep, 1)]:
            if tag:
                self._fs().create(self._marker(tag), True).close()
            path = hadoop.Path(location)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def entity_table(spark: SparkSession, path: str) -> VersionedTable:
    return VersionedTable(spark, path, ENTITY_TABLE)


def failure_table(spark: SparkSession, path: str) -> VersionedTable:
    return VersionedTable(spark, path, FAILURE_TABLE)


def read_entities(spark: SparkSession, path: str) -> DataFrame:
    return entity_table(spark, path).read()


def read_failures(spark: SparkSession, path: str) -> DataFrame:
    return failure_table(spark, path).read()


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_LOG).option("recursiveFileLookup", "true").parquet(path)


def write_per_run(df: DataFrame, path: str) -> None:
    """Store rows with a ``run_id`` in a folder per run, in place of what the run has there.

    The files hold ``run_id`` too and are read with ``recursiveFileLookup``, next to files that lie in ``path`` itself.
    """
    dealt = df.withColumn("_run", F.col("run_id"))
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_run").parquet(path)


def append_run_log(log: DataFrame, path: str) -> None:
    """Add the rows of runs; a run that is told again is kept once."""
    write_per_run(log.select(*RUN_LOG.fieldNames()), path)


def write_rate_stats(stats: DataFrame, path: str) -> None:
    """One JSON document per source."""
    stats.write.mode("overwrite").json(path)


def save_bucketed(df: DataFrame, table: str, buckets: int) -> None:
    """Save a keyed table in the catalog, bucketed by its key.

    An upsert against it reads the target in place: only the incoming batch is shuffled.
    """
    df.write.mode("overwrite").bucketBy(buckets, *KEY).sortBy(*KEY).saveAsTable(table)


def merge_into(entities: DataFrame, table: str, now: Column, *, soft_delete: bool = True) -> None:
    """Upsert into a catalog table whose format supports row-level merges.

    Same rules as ``upsert_entities``, but the table format rewrites only the files it has to.
    """
    changes = fold_batch(as_stored(entities)).alias("s")
    old, new = (lambda c: F.col(f"{table}.{c}")), (lambda c: F.col(f"s.{c}"))
    now, never = now.cast("timestamp"), F.lit(None).cast("timestamp")
    update = {
        **{c: new(c) for c in ("entity_type", "geom", "confidence")},
        "attrs": json_merge(old("attrs"), new("attrs")),
        "bbox_country": keep_old(new("bbox_country"), old("bbox_country")),
        "last_seen_at": now,
        **({"removed_at": never} if soft_delete else {}),
    }
    given = [*KEY, "entity_type", "geom", "attrs", "bbox_country", "confidence"]
    insert = {**{c: new(c) for c in given}, "last_seen_at": now, "created_at": now, "removed_at": never}
    same_key = (old("source") == new("source")) & (old("source_id") == new("source_id"))
    changes.mergeInto(table, same_key).whenMatched().update(update).whenNotMatched().insert(insert).merge()


def write_jdbc(df: DataFrame, url: str, table: str, **options: str) -> None:
    """Append to a staging table of a database; merging it is left to the database."""
    writer = df.write.format("jdbc").mode("append").option("url", url).option("dbtable", table)
    for key, value in options.items():
        writer = writer.option(key, value)
    writer.save()
