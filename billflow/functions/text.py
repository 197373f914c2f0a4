"""Name, date and identity text helpers, as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from billflow.functions.numbers import py_float_text

# Words dropped from vendor names, by profile.
LEGAL_SUFFIXES = {
    "code": "pvt ltd private limited inc corp co llc",
    "spec": "pvt ltd private limited inc corp co llc store traders",
}

# Text shapes.
ISO_DATE = r"\A\d{4}-\d{2}-\d{2}\z"
GSTIN = r"\A[0-9]{2}[A-Z]{5}[0-9]{4}[A-Z]{1}[1-9A-Z]{1}Z[0-9A-Z]{1}\z"


def normalize_vendor(name: Column, profile: str = "code") -> Column:
    """Lower case, punctuation deleted, legal suffix words dropped, spaces collapsed."""
    suffixes = "|".join(LEGAL_SUFFIXES[profile].split())
    kept = F.regexp_replace(F.lower(F.coalesce(name, F.lit(""))), r"(?U)[^a-z0-9\s]", "")
    bare = F.regexp_replace(kept, rf"\b({suffixes})\b", "")
    return F.trim(F.regexp_replace(bare, r"(?U)\s+", " "))


def falsy_default(value: Column, default: Column | str) -> Column:
    """``value`` unless it is null or the empty string."""
    fallback = default if isinstance(default, Column) else F.lit(default)
    return F.when(value.isNull() | (value == ""), fallback).otherwise(value)


def falsy_default_number(value: Column, default: Column) -> Column:
    """``value`` unless it is null, zero or NaN."""
    return F.when(value.isNull() | (value == 0) | F.isnan(value), default).otherwise(value)


def date_or_today(date: Column, as_of: Column | None = None) -> Column:
    """An ISO-shaped date text is kept; anything else becomes the as-of date."""
    today = F.current_date() if as_of is None else as_of
    return F.when(date.rlike(ISO_DATE), date).otherwise(F.date_format(today, "yyyy-MM-dd"))


def invoice_fingerprint(vendor: Column, date: Column, total: Column) -> Column:
    """MD5 over vendor, date and total; a null date takes part as the word ``None``."""
    return F.md5(F.concat(vendor, F.lit("_"), F.coalesce(date, F.lit("None")),
                          F.lit("_"), py_float_text(total)).cast("binary"))


def bill_sequence(file: Column) -> Column:
    """The first run of digits in a bill's file name, as a number."""
    return F.regexp_extract(file, r"([0-9]+)", 1).try_cast("bigint")
