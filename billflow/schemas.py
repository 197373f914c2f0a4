"""Table shapes, column limits and the small constant dimensions."""

from __future__ import annotations

from pyspark.sql import types as T

LINE_ITEM = T.StructType([
    T.StructField("product_desc", T.StringType()),
    T.StructField("quantity", T.DoubleType()),
    T.StructField("unit_price", T.DoubleType()),
    T.StructField("total_price", T.DoubleType()),
])

INVOICE = T.StructType([
    T.StructField("vendor_name", T.StringType()),
    T.StructField("invoice_number", T.StringType()),
    T.StructField("invoice_date", T.StringType()),
    T.StructField("total_amount", T.DoubleType()),
    T.StructField("tax_amount", T.DoubleType()),
    T.StructField("line_items", T.ArrayType(LINE_ITEM)),
])

TRUTH = T.StructType([
    T.StructField("vendor_name", T.StringType()),
    T.StructField("invoice_number", T.StringType()),
    T.StructField("date", T.StringType()),
    T.StructField("total_amount", T.DoubleType()),
    T.StructField("tax_amount", T.DoubleType()),
    T.StructField("gstin", T.StringType()),
])

# The scored fields with their labels, in report order.
FIELDS = {
    "vendor_name": "Vendor Name",
    "invoice_number": "Invoice No.",
    "date": "Date",
    "total_amount": "Total Amount",
    "tax_amount": "Tax Amount",
    "gstin": "GSTIN",
}
AMOUNT_FIELDS = ("total_amount", "tax_amount")

# Column widths of the staging tables.
MAX_VENDOR_NAME = 255
MAX_INVOICE_NUMBER = 100
AMOUNT_TYPE = "decimal(15,2)"
QUANTITY_TYPE = "decimal(10,2)"

# List price in dollars for 100 bills, by model. Callers pass their own models.
MODEL_COST_PER_100 = {"m_a": 0.007, "m_b": 0.0, "m_c": 0.0}
MODELS = tuple(MODEL_COST_PER_100)
