"""From raw documents to token ids, in stages; each stage is written as Parquet and read by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from geoingest.llm.common import remove, scratch, staging_path
from geoingest.llm.exact_dedup import exact_dedup_stage
from geoingest.llm.language_id import language_stage
from geoingest.llm.mixing import mixing_stage
from geoingest.llm.pieces import sentencepiece_stage
from geoingest.llm.registry import table
from geoingest.llm.simhash import simhash_stage

StageFn = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, StageFn]] = [
    ("language_id", language_stage),
    ("exact_dedup", exact_dedup_stage),
    ("simhash_near_dedup", simhash_stage),
    ("mixing", mixing_stage),
    ("sentencepiece", sentencepiece_stage),
]

#: SQL expresses neither the language models nor the token ids; tests hold each stage against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table. What a stage staged goes when its result is written,
    that result when the next one is; the last stays, as the rows that are returned are read from it."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = staging_path(spark, f"pipeline-{name}")
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before is not None:
            remove(spark, before)
        before = path
    return docs
