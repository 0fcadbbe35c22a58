"""Consecutive row numbers without one task for all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioforge.session import cut_lineage


def number_rows(df: DataFrame, name: str) -> DataFrame:
    """df, written to the checkpoint folder, with the bigint column `name`: 0, 1, 2 ... in no stated order.

    A row's number is its place in its partition plus the sizes of the partitions before, one row for each of those.
    """
    held = cut_lineage(df.withColumn("__m", F.monotonically_increasing_id()))
    part = F.shiftright("__m", 33)
    sizes = held.groupBy(part.alias("__p")).agg(F.count(F.lit(1)).alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = held.withColumn("__p", part).join(sizes.select("__p", before.alias("__before")), "__p")
    return placed.withColumn(name, F.col("__before") + F.col("__m").bitwiseAND(F.lit((1 << 33) - 1))).drop("__m", "__p", "__before")
