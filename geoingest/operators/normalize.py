"""From raw records to entities: default projection and user normalizers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoingest.functions.text import error_text

NORMALIZER_NONE = "normalizer_returned_none"


def to_entity(raw: DataFrame) -> DataFrame:
    """Entity columns taken straight from the record; further columns of the record stay."""
    return (
        raw.withColumn("entity_type", F.lit("raw"))
        .withColumn("geom", F.col("coord_hint"))
        .withColumn("attrs", F.col("raw"))
        .withColumn("bbox_country", F.lit(None).cast("string"))
        .withColumn("confidence", F.lit(1.0))
    )


def normalize(raw: DataFrame, fn: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Apply a normalizer and set ``_error`` and ``_outcome`` on the rows it does not yield.

    ``fn`` maps raw records to rows with the entity columns, and keeps the record's columns. It leaves
    ``entity_type`` null where there is no entity (the row is skipped) and may set ``_problem``, a
    message, where it cannot tell (the row failed).
    """
    if fn is None:
        return to_entity(raw).withColumn("_outcome", F.lit(None).cast("string")).withColumn(
            "_error", F.lit(None).cast("string")
        )
    out = fn(raw)
    problem = F.col("_problem") if "_problem" in out.columns else F.lit(None).cast("string")
    return (
        out.withColumn(
            "_outcome",
            F.when(problem.isNotNull(), "failed").when(F.col("entity_type").isNull(), "skipped"),
        )
        .withColumn(
            "_error",
            F.when(problem.isNotNull(), error_text("normalize", F.lit("ValueError"), problem)).when(
                F.col("entity_type").isNull(), NORMALIZER_NONE
            ),
        )
        .drop("_problem")
    )


def split_skipped(locators: DataFrame, records: DataFrame) -> DataFrame:
    """Locators that gave no record; ``_pos`` is unique, so no key is crowded."""
    return locators.join(records.select("_pos"), "_pos", "left_anti").withColumn(
        "error", F.lit("adapter_returned_none")
    )
