"""Keeping costly expressions from being copied into every place that uses them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def computed_once(rows: DataFrame, **columns: Column) -> DataFrame:
    """``rows`` with extra columns that later filters and projections do not expand again.

    Catalyst inlines a column's definition into filters pushed below it and into each field
    read from a struct; for parsed documents that multiplies the work and the generated code.
    A one-element explode is a narrow, streaming-safe step it does not look through.
    """
    kept = [c for c in rows.columns if c not in columns]
    prepared = rows.select(*kept, *[c.alias(name) for name, c in columns.items()])
    packed = F.explode(F.array(F.struct(*columns))).alias("_once")
    return prepared.select(*kept, packed).select(
        *kept, *[F.col(f"_once.{name}").alias(name) for name in columns])
