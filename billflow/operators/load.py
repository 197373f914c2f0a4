"""Fingerprints, in-batch collapse and keyed upserts into the staging tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from billflow.functions.text import invoice_fingerprint
from billflow.operators.lookup import insert_only_new, keyed_lookup, next_id, number_rows
from billflow.operators.validate import unnest_line_items
from billflow.schemas import AMOUNT_TYPE, QUANTITY_TYPE

INSERT_ONLY = ("vendor_name", "invoice_date", "invoice_number")
UPDATED = ("total_amount", "tax_amount")


def load_rows(valid: DataFrame, seq: str = "seq", *keep: Column | str) -> DataFrame:
    """Accepted documents as flat load rows with fingerprint and column types of the tables."""
    doc = F.col("invoice")
    return valid.select(
        invoice_fingerprint(doc["vendor_name"], doc["invoice_date"], doc["total_amount"])
        .alias("invoice_hash"),
        F.col(seq).alias("seq"),
        doc["vendor_name"].alias("vendor_name"),
        F.to_date(doc["invoice_date"], "yyyy-MM-dd").alias("invoice_date"),
        doc["invoice_number"].alias("invoice_number"),
        doc["total_amount"].cast(AMOUNT_TYPE).alias("total_amount"),
        doc["tax_amount"].cast(AMOUNT_TYPE).alias("tax_amount"),
        doc["line_items"].alias("line_items"), *keep)


def collapse_batch(rows: DataFrame) -> DataFrame:
    """One row per fingerprint: the first document inserts, the last one updates.

    Partial aggregation collapses repeats before the shuffle, so a fingerprint delivered
    over and over costs one row per map task.
    """
    last = [c for c in (*UPDATED, "line_items") if c in rows.columns]
    grouped = rows.groupBy("invoice_hash").agg(
        F.min("seq").alias("seq"),
        F.min_by(F.struct(*INSERT_ONLY), "seq").alias("first"),
        F.max_by(F.struct(*last), "seq").alias("last"))
    return grouped.select("invoice_hash", "seq", "first.*", "last.*")


def distinct_vendors(rows: DataFrame) -> DataFrame:
    """Distinct vendor names with the place of their first arrival."""
    return rows.groupBy("vendor_name").agg(F.min("seq").alias("seq"))


def upsert_vendors(current: DataFrame, rows: DataFrame) -> DataFrame:
    """All vendors after the batch; known names keep their id, new ones follow in arrival order."""
    fresh = number_rows(insert_only_new(distinct_vendors(rows), current, ["vendor_name"]),
                        "seq", "vendor_name", "vendor_id", next_id(current, "vendor_id"))
    return current.unionByName(fresh.select(
        "vendor_id", "vendor_name", F.lit(None).cast("string").alias("tax_id")))


def lookup_vendor_id(rows: DataFrame, vendors: DataFrame) -> DataFrame:
    """Attach the vendor id by name; one vendor may own a large share of the rows."""
    return keyed_lookup(rows, vendors.select("vendor_name", "vendor_id"), ["vendor_name"])


def lookup_invoice_id(rows: DataFrame, invoices: DataFrame) -> DataFrame:
    """Attach the invoice id by fingerprint."""
    return keyed_lookup(rows, invoices.select("invoice_hash", "invoice_id"), ["invoice_hash"])


def upsert_invoices(current: DataFrame, batch: DataFrame) -> DataFrame:
    """The invoice table after the batch (a collapsed one).

    A known fingerprint takes the incoming total and tax, even a null one; nothing else
    changes. The current table is joined, not regrouped, so a small batch is broadcast and the
    large table stays in place.
    """
    news = batch.select("invoice_hash", *[F.col(c).alias(f"_{c}") for c in UPDATED],
                        F.lit(True).alias("_incoming"))
    kept = current.join(news, "invoice_hash", "left")
    for c in UPDATED:
        kept = kept.withColumn(c, F.when(F.col("_incoming"), F.col(f"_{c}")).otherwise(F.col(c)))
    kept = kept.select(*current.columns)
    fresh = number_rows(insert_only_new(batch, current, ["invoice_hash"]), "seq",
                        "invoice_hash", "invoice_id", next_id(current, "invoice_id"))
    return kept.unionByName(fresh.select(*current.columns))


def upsert_plan(current: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Which action the upsert takes for each key: insert, update or keep."""
    sides = current.select(key).withColumn("_old", F.lit(1)).join(
        batch.select(key).withColumn("_new", F.lit(1)), key, "full")
    return sides.select(key, F.when(F.col("_old").isNull(), "insert")
                        .when(F.col("_new").isNull(), "keep").otherwise("update").alias("action"))


def line_item_rows(rows: DataFrame, mode: str = "replace") -> DataFrame:
    """Item rows by fingerprint: ``replace`` keeps the last document's, ``append`` all of them."""
    if mode not in ("replace", "append"):
        raise ValueError("mode must be 'replace' or 'append'")
    source = collapse_batch(rows) if mode == "replace" else rows
    return unnest_line_items(source.select("invoice_hash", "seq", "line_items")).select(
        "invoice_hash", "seq", "position", "product_desc",
        F.col("quantity").cast(QUANTITY_TYPE).alias("quantity"),
        F.col("unit_price").cast(AMOUNT_TYPE).alias("unit_price"),
        F.col("total_price").cast(AMOUNT_TYPE).alias("total_price"))


def cascade_delete(vendors: DataFrame, invoices: DataFrame, line_items: DataFrame,
                   doomed: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What is left of the three tables once the doomed vendors (by name) are deleted."""
    gone = vendors.join(doomed.select("vendor_name"), "vendor_name", "left_semi")
    lost = invoices.join(gone.select("vendor_id"), "vendor_id", "left_semi")
    return (
        vendors.join(doomed.select("vendor_name"), "vendor_name", "left_anti"),
        invoices.join(gone.select("vendor_id"), "vendor_id", "left_anti"),
        line_items.join(lost.select("invoice_id"), "invoice_id", "left_anti"))


def vendor_date_rollup(invoices: DataFrame) -> DataFrame:
    """Invoice count and sums by vendor and date; partial sums leave a hot vendor small."""
    return invoices.groupBy("vendor_id", "invoice_date").agg(
        F.count(F.lit(1)).alias("n_invoices"),
        F.sum("total_amount").alias("total_amount"),
        F.sum("tax_amount").alias("tax_amount"))
