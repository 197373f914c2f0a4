"""Accounting expense records and the ledger of their submission."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from billflow.functions import variants as V
from billflow.functions.numbers import number_or_zero
from billflow.functions.text import date_or_today

# Fallback texts and the success code.
NO_REFERENCE = "N/A"
NO_VENDOR = "Unknown"
NO_GSTIN = "N/A"
NO_EXPENSE_ID = "SUCCESS"
FAILED = "Accounting API returned non-zero code"
SUCCESS_CODE = 0


def _falsy_default(value: Column, default: str) -> Column:
    return F.when(V.is_truthy(value), V.js_text(value)).otherwise(default)


def expense_mapping(bills: DataFrame, record: str, account_id: str,
                    as_of: Column | None = None, fallbacks: bool = True) -> DataFrame:
    """A bill record (VARIANT) as the five expense fields; extra columns are kept."""
    doc = F.col(record)
    date, total, number, vendor, gstin = (
        V.member(doc, f"$.{f}") for f in
        ("date", "total_amount", "invoice_number", "vendor_name", "gstin"))
    amount = F.try_variant_get(total, "$", "double")
    if fallbacks:
        kept_amount = F.when(V.is_number(V.kind(total)), amount).otherwise(
            F.when(V.kind(total) == "BOOLEAN", V.is_truthy(total).cast("double")).otherwise(
                number_or_zero(V.as_text(total))))
        parts = (date_or_today(V.as_text(date), as_of), kept_amount,
                 _falsy_default(number, NO_REFERENCE), _falsy_default(vendor, NO_VENDOR),
                 _falsy_default(gstin, NO_GSTIN))
    else:
        parts = (V.as_text(date), amount, V.js_text(number), V.js_text(vendor),
                 V.js_text(gstin))
    on, paid, reference, who, tax_id = parts
    return bills.select(
        *[c for c in bills.columns if c != record],
        F.lit(account_id).alias("account_id"), on.alias("date"), paid.alias("amount"),
        reference.alias("reference_number"),
        F.concat(F.lit("Vendor: "), who, F.lit(" | GSTIN: "), tax_id).alias("description"))


def export_expenses(expenses: DataFrame) -> DataFrame:
    """One JSON text per expense, ready for a text sink."""
    return expenses.select(F.to_json(F.struct(
        "account_id", "date", "amount", "reference_number", "description")).alias("value"))


def sync_ledger(responses: DataFrame, body: str = "body", failed: str = FAILED) -> DataFrame:
    """Success or error of each submission, from the accounting system's JSON answer."""
    doc = V.parse_json(F.col(body))
    answered = responses.withColumn("_doc", doc)
    doc = F.col("_doc")
    code = V.member(doc, "$.code")
    success = F.coalesce(
        V.is_number(V.kind(code)) & (F.try_variant_get(code, "$", "double") == SUCCESS_CODE),
        F.lit(False))
    expense_id = _falsy_default(V.member(doc, "$.expense.expense_id"), NO_EXPENSE_ID)
    message = _falsy_default(V.member(doc, "$.message"), failed)
    return answered.withColumn("success", success).withColumn(
        "expense_id", F.when(success, expense_id)).withColumn(
        "error", F.when(~success, message)).drop("_doc", body)
