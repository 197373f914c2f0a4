"""Audits of the references between the tables."""

from pyspark.sql import functions as F

from billflow.operators import integrity
from checks.queries import QUERIES


def test_orphans_of_both_references(spark):
    items = spark.createDataFrame([("h1", 0), ("h2", 0), ("h2", 1), (None, 0)], "invoice_hash string, position int")
    invoices = spark.createDataFrame([("h1", "A"), ("h3", "B"), ("h4", "B"), ("h5", None)],
                                     "invoice_hash string, vendor_name string")
    vendors = spark.createDataFrame([(1, "A")], "vendor_id bigint, vendor_name string")
    found = integrity.audit_schema_keys(items, invoices, invoices, vendors)
    assert {tuple(r) for r in found.collect()} == {
        ("line_items.invoice_id", "h2", 2), ("invoices.vendor_id", "B", 2)}


def test_query_audits_invoices_without_vendor(spark, tmp_path):
    """Orders 4 and 21 have their amounts as text, which a strict load refuses; customer 8 has no other order."""
    orders = spark.createDataFrame([(4, 8, 10.0), (21, 8, 20.0), (38, 9, 30.0), (1, 9, 40.0)],
                                   "o_orderkey bigint, o_custkey bigint, o_totalprice double")
    orders.withColumn("o_orderdate", F.lit("2024-01-01").cast("timestamp_ntz")).write.parquet(
        str(tmp_path / "orders.parquet"))
    spark.createDataFrame([(4, 1, 2.0, 5.0), (1, 1, 1.0, 5.0)], "l_orderkey bigint, l_partkey bigint, "
                          "l_quantity double, l_extendedprice double").write.parquet(
        str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame([(1, "nut")], "p_partkey bigint, p_name string").write.parquet(
        str(tmp_path / "part.parquet"))
    rows = QUERIES["audit_foreign_keys"](spark, str(tmp_path)).collect()
    assert sorted((r.foreign_key, r.n_rows) for r in rows) == [
        ("invoices.vendor_id", 2), ("line_items.invoice_id", 1)]
    assert [r.key for r in rows if r.foreign_key == "invoices.vendor_id"] == ["Customer 8"]
