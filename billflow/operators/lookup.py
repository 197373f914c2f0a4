"""Key joins that hold up when one key carries a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from billflow.workspace import written



def keyed_lookup(many: DataFrame, one: DataFrame, keys: Sequence[str], how: str = "inner"
                 ) -> DataFrame:
    """Join a large side to a side that is unique per key.

    Adaptive execution splits a hot key's partition of the large side by its measured size and reads the
    unique side's one row again for each part; nothing is repeated where no key is hot. A small
    ``one`` side is broadcast by Spark's own size check and then no row moves at all.
    """
    return many.join(one, list(keys), how)


def known_keys(current: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Those current keys that also arrive: filters the large side by the small one first."""
    return current.select(*keys).join(incoming.select(*keys), list(keys), "left_semi")


def insert_only_new(incoming: DataFrame, current: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Incoming rows whose key is not in the current table."""
    return incoming.join(known_keys(current, incoming, keys), list(keys), "left_anti")


def next_id(current: DataFrame, column: str) -> Column:
    """The current highest id (0 for an empty table), as a scalar subquery."""
    return F.coalesce(current.select(F.max(column)).scalar(), F.lit(0))


def number_rows(rows: DataFrame, order: str, tie: str, name: str, after: Column | int = 0,
                rows_each: int = 1_000_000) -> DataFrame:
    """Gap-free numbers in ``order`` (then ``tie``) without sorting the whole table in one task.

    The rows are written once, each with a mark of its own. Only order, tie and mark are then
    sorted into ranges, as many as the rows need: a total order, so that any number of rows of one
    order value spreads over the ranges. A row's number is its place in its range, which comes with
    the sorted rows, plus the sizes of the ranges before: no window over rows.
    """
    marked = written(rows.withColumn("_mark", F.monotonically_increasing_id()), "numbered")
    ranges = max(1, -(-marked.count() // rows_each))
    keys = list(dict.fromkeys([order, tie, "_mark"]))
    # partition number in the upper bits, place within it in the lower 33
    sorted_rows = marked.select(*keys).repartitionByRange(ranges, *keys).sortWithinPartitions(*keys)
    placed = written(sorted_rows.select("_mark", F.monotonically_increasing_id().alias("_p")),
                     "places").select("_mark", F.shiftright("_p", 33).alias("_range"),
                                      F.col("_p").bitwiseAND((1 << 33) - 1).alias("_place"))
    # One small row for each range of up to `rows_each` rows.
    before = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_size")).selectExpr(
        "_range", "sum(_size) over (order by _range) - _size as _before")
    number = F.col("_place") + F.col("_before") + 1 + (
        after if isinstance(after, Column) else F.lit(after))
    numbers = placed.join(before, "_range").select("_mark", number.cast("bigint").alias(name))
    return marked.join(numbers, "_mark").drop("_mark")
