"""Row numbers over a whole table without bringing it into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from linkloom.session import checkpoint

ROW_BITS = 33


def place_rows(df: DataFrame, order: list[Column]) -> DataFrame:
    """``df`` sorted into ranges and written once, with ``_range`` and ``_at``, which grow with the order."""
    placed = checkpoint(df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()))
    return placed.withColumn("_range", F.shiftright("_at", ROW_BITS))


def number_rows(df: DataFrame, order: list[Column], name: str = "row_no") -> DataFrame:
    """``df`` with the row's place, from 1, in the order given. The order should have no ties.

    The table is sorted by ranges and written once; each row then knows its place in its range,
    and the ranges' sizes, one row per range, give what comes before.
    """
    placed = place_rows(df, order)
    sizes = placed.groupBy("_range").agg(F.count("*").alias("n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    # one row per partition of the sort
    numbered = placed.join(F.broadcast(starts), "_range")
    place = F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << ROW_BITS) - 1)) + 1
    return numbered.withColumn(name, place).drop("_at", "_range", "_before")
