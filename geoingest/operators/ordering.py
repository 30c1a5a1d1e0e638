"""Order over rows without sending a whole group to one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

_BITS = 16


def with_row_index(df: DataFrame, order_col: str, index_col: str = "_idx") -> DataFrame:
    """Add the 0-based rank of each row by ``order_col``, a unique BIGINT.

    Ranks are prefix sums over the halves of the key: rows are counted per upper bits, and every
    window is partitioned by a longer prefix, so that none holds more than 65,536 rows however many
    there are and however the keys are spread.
    """
    upper = lambda c: F.shiftright(c, _BITS)
    key = F.col(order_col).cast("bigint")
    level1 = df.select(upper(key).alias("_b1")).groupBy("_b1").agg(F.count("*").alias("_n"))
    level1 = level1.withColumn("_b2", upper(F.col("_b1"))).withColumn("_b3", upper(upper(F.col("_b1"))))
    level2 = level1.groupBy("_b3", "_b2").agg(F.sum("_n").alias("_n"))
    level3 = level2.groupBy("_b3").agg(F.sum("_n").alias("_n"))

    def before(window: W) -> F:
        return F.coalesce(F.sum("_n").over(window.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))

    # At most 2^16 values of the top bits exist, the only window without a partition key.
    start3 = level3.select("_b3", before(W.orderBy("_b3")).alias("_o3"))
    start2 = level2.select(
        "_b3", "_b2", before(W.partitionBy("_b3").orderBy("_b2")).alias("_o2")
    ).join(start3, "_b3")
    start1 = (
        level1.select("_b2", "_b1", before(W.partitionBy("_b2").orderBy("_b1")).alias("_o1"))
        .join(start2, "_b2")
        .select("_b1", (F.col("_o1") + F.col("_o2") + F.col("_o3")).alias("_start"))
    )
    local = F.row_number().over(W.partitionBy("_b1").orderBy(key)) - 1
    return (
        df.withColumn("_b1", upper(key))
        .join(start1, "_b1")
        .withColumn(index_col, F.col("_start") + local)
        .drop("_b1", "_start")
    )
