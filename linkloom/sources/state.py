"""Snapshots of a loop's tables, one folder per iteration, and the way back from the last whole one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException


def save_state(whole: dict[str, DataFrame], grown: dict[str, DataFrame], path: str, iteration: int,
               **numbers: int) -> None:
    """Write the ``whole`` tables and what was added to the ``grown`` ones, then the marker that makes it count.

    An iteration that was cut short has no marker; it is ignored, or written over when done again.
    """
    spark = next(iter(whole.values())).sparkSession
    for name, table in {**whole, **grown}.items():
        table.write.mode("overwrite").parquet(f"{path}/{name}/iteration={iteration}")
    marker = spark.range(1).select(
        F.lit(iteration).alias("iteration"), F.array(*map(F.lit, whole)).alias("whole"),
        F.array(*map(F.lit, grown)).alias("grown"), *[F.lit(v).alias(k) for k, v in numbers.items()])
    marker.write.mode("append").parquet(f"{path}/done")


def load_state(spark: SparkSession, path: str) -> tuple[dict[str, DataFrame], dict[str, int]] | None:
    """Tables and numbers as of the last complete iteration, or nothing."""
    try:
        last = spark.read.parquet(f"{path}/done").orderBy(F.desc("iteration")).first()
    except AnalysisException:
        return None
    numbers = last.asDict()
    now, until = F.col("iteration") == last.iteration, F.col("iteration") <= last.iteration
    chosen = {name: now for name in numbers.pop("whole")} | {name: until for name in numbers.pop("grown")}
    tables = {name: spark.read.parquet(f"{path}/{name}").filter(rows).drop("iteration") for name, rows in chosen.items()}
    return tables, numbers
