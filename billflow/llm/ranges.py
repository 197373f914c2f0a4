"""Running sums in a global order, without bringing all rows to one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from billflow.workspace import written


def running_sum(rows: DataFrame, order: list[str], size: Column, name: str) -> DataFrame:
    """The running sum of `size` before each row in a global order: within ranges of the order, plus what
    the ranges before hold (one small row for each range)."""
    parts = max(8, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    placed = written(rows.withColumn("_size", size).repartitionByRange(parts, *order)
                     .withColumn("_range", F.spark_partition_id()), "ranges")
    held = placed.groupBy("_range").agg(F.sum("_size").alias("_held"))
    before = held.select("_range", F.coalesce(F.sum("_held").over(
        Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        .alias("_before"))
    inside = Window.partitionBy("_range").orderBy(*order)
    own = F.coalesce(F.sum("_size").over(inside.rowsBetween(Window.unboundedPreceding, -1)),
                     F.lit(0))
    return placed.withColumn("_own", own).join(before, "_range").withColumn(
        name, F.col("_own") + F.col("_before")).drop("_own", "_before", "_range", "_size")
