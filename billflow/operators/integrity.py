"""Integrity audits over loaded tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def audit_not_null(table: DataFrame, required: Sequence[str]) -> DataFrame:
    """Null counts of all required columns in one pass: (column_name, n_null)."""
    counts = table.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
    return counts.unpivot([], list(required), "column_name", "n_null")


def audit_unique(table: DataFrame, key: str) -> DataFrame:
    """Key values that occur more than once."""
    return (table.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
            .where((F.col("n_rows") > 1) & F.col(key).isNotNull()))


def audit_foreign_keys(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose parent does not exist. A hot key's rows are first counted down to one."""
    counted = child.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.count(F.lit(1)).alias("n_rows"))
    return counted.join(parent.select(key), key, "left_anti")


def audit_schema_keys(line_items: DataFrame, invoices: DataFrame, known_invoices: DataFrame,
                      vendors: DataFrame) -> DataFrame:
    """(foreign_key, key, n_rows): orphans of both references of the schema, items without an invoice and
    invoices without a vendor. Rows that have no ids yet are told by what their ids are looked up by."""
    orphans = [audit_foreign_keys(child, parent, key).select(
        F.lit(name).alias("foreign_key"), F.col(key).alias("key"), "n_rows")
        for name, child, parent, key in (
            ("line_items.invoice_id", line_items, known_invoices, "invoice_hash"),
            ("invoices.vendor_id", invoices, vendors, "vendor_name"))]
    return orphans[0].unionByName(orphans[1])


def partition_check(documents: DataFrame, valid: DataFrame, rejected: DataFrame,
                    key: str) -> DataFrame:
    """Counts proving that accepted and rejected documents are disjoint and complete."""
    sides = (documents.select(key, F.lit(1).alias("i"), F.lit(0).alias("v"), F.lit(0).alias("r"))
             .unionByName(valid.select(key, F.lit(0).alias("i"), F.lit(1).alias("v"),
                                       F.lit(0).alias("r")))
             .unionByName(rejected.select(key, F.lit(0).alias("i"), F.lit(0).alias("v"),
                                          F.lit(1).alias("r"))))
    per_key = sides.groupBy(key).agg(*[F.sum(c).alias(c) for c in "ivr"])
    return per_key.agg(
        F.sum("i").alias("n_input"), F.sum("v").alias("n_valid"), F.sum("r").alias("n_rejected"),
        F.count_if((F.col("v") > 0) & (F.col("r") > 0)).alias("n_both"),
        F.count_if(F.col("v") + F.col("r") != F.col("i")).alias("n_unbalanced"))
