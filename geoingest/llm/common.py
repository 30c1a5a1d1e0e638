"""Shared by the operators: staged tables, payload columns, hot keys, connected components."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geoingest.session import checkpoint_dir

#: Groups with more than one part in this many of all rows are joined by broadcast: fewer than this many exist.
HEAVY_PARTS = 4096

#: A table of at most this many narrow rows may be broadcast.
SMALL_ROWS = 200_000

#: A staged table whose values take at most so many bytes may be broadcast.
SMALL_BYTES = 8 << 20


#: Folder and catalog tables of the innermost :func:`scratch`.
_SCRATCH: ContextVar[tuple[str, list[str]] | None] = ContextVar("scratch", default=None)


def staging_path(spark: SparkSession, name: str) -> str:
    inner = _SCRATCH.get()
    return f"{inner[0] if inner else f'{checkpoint_dir(spark)}/llm'}/{name}-{uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """What operators stage inside goes when the block ends or fails, so results must be written by then.

    Outside of any such block staged tables stay in ``spark.checkpoint.dir``: a result that is not yet
    computed reads them.
    """
    folder, tables = staging_path(spark, "scratch"), []
    token = _SCRATCH.set((folder, tables))
    try:
        yield folder
    finally:
        _SCRATCH.reset(token)
        for table in tables:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
        remove(spark, folder)


def remove(spark: SparkSession, location: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def staged(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it again: cuts the lineage, survives executors."""
    path = staging_path(df.sparkSession, name)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def staged_by(df: DataFrame, name: str, key: str, *partition_by: str) -> DataFrame:
    """As :func:`staged`, in buckets of ``key``: a join on it leaves these rows where they lie."""
    spark = df.sparkSession
    table = f"llm_{name.replace('-', '_')}_{uuid4().hex}"
    if _SCRATCH.get():
        _SCRATCH.get()[1].append(table)
    writer = df.write.format("parquet").option("compression", "zstd").option("path", staging_path(spark, name))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (writer.partitionBy(*partition_by) if partition_by else writer).bucketBy(buckets, key).saveAsTable(table)
    return spark.table(table)


def packed(df: DataFrame, **more: Column) -> DataFrame:
    """The whole row as one struct ``row`` beside working columns, so that no name can clash."""
    row = F.struct(*[df[f"`{c}`"].alias(c) for c in df.columns]) if df.columns else F.struct()
    return df.select(row.alias("row"), *[c.alias(name) for name, c in more.items()])


def unpacked(df: DataFrame, columns: list[str], **results: Column) -> DataFrame:
    """The columns of ``row`` and then the results; a result replaces a column of its name."""
    kept = [F.col("row").getField(c).alias(c) for c in columns if c not in results]
    return df.select(*kept, *[c.alias(name) for name, c in results.items()])


def small_broadcast(df: DataFrame, max_rows: int = SMALL_ROWS) -> DataFrame:
    """Broadcast hint behind a count; a larger table is joined by shuffle, with the same rows."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def broadcast_within(df: DataFrame, size: Column | int, max_bytes: int = SMALL_BYTES) -> DataFrame:
    """Broadcast hint behind the summed ``size`` of the rows in bytes; a larger table is joined by shuffle, with the same rows.

    ``df`` should be staged, as it is read once for its size.
    """
    each = size if isinstance(size, Column) else F.lit(size)
    total = df.agg(F.coalesce(F.sum(each.cast("long")), F.lit(0)).alias("n")).first()["n"]
    return F.broadcast(df) if total <= max_bytes else df


def join_groups(members: DataFrame, groups: DataFrame, key: str, size: str, how: str = "inner") -> DataFrame:
    """Join rows with one row per group when a group may hold a third of all rows.

    ``groups[size]`` counts the members. Groups above 1/4096 of all rows, fewer than 4,096 of them,
    are broadcast; the others are even enough for a shuffle, which is the plan at every size.
    """
    total = groups.agg(F.coalesce(F.sum(size), F.lit(0)).alias("n")).first()["n"]
    bound = max(total // HEAVY_PARTS, 1000)
    if groups.where(F.col(size) > bound).limit(1).count() == 0:
        return members.join(groups.hint("merge"), key, how)
    heavy = groups.where(F.col(size) > bound)
    flagged = members.join(F.broadcast(heavy.select(key, F.lit(True).alias("_heavy"))), key, "left")
    light = flagged.where("_heavy is null").drop("_heavy").join(groups.where(F.col(size) <= bound).hint("merge"), key, how)
    hot = flagged.where("_heavy").drop("_heavy").join(F.broadcast(heavy), key, "inner")
    return light.unionByName(hot)


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Smallest node of each connected component, by alternating large and small stars.

    ``edges(a, b)`` may repeat and point either way. Returns ``node, root`` for every node that has an
    edge. Each round is written to the checkpoint folder; rounds grow with the logarithm of the
    longest path. No node's neighbours are gathered: a star is a minimum and a join.
    """
    def star(pairs: DataFrame, large: bool) -> DataFrame:
        """Neighbours of ``u``: the larger ones (large) or the smaller ones go to the least of all."""
        low = pairs.groupBy("u").agg(F.min("v").alias("m"))
        if large:
            low = low.withColumn("m", F.least("u", "m"))
            return pairs.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        moved = pairs.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        return moved.unionByName(low.select("u", F.col("m").alias("v")))

    def mark(df: DataFrame) -> tuple:
        row = df.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        return row["n"], row["h"]

    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    down = staged(down, name)
    last = mark(down)
    while last[0]:
        both = down.unionByName(down.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = star(both, large=True).distinct()
        down = staged(star(large, large=False).where("u <> v").distinct(), name)
        now = mark(down)
        if now == last:
            break
        last = now
    leaves = down.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return leaves.unionByName(down.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
