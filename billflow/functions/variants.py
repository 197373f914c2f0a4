"""Reading untyped JSON: VARIANT keeps missing, null, text and number apart."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from billflow.functions.numbers import js_number_text


def parse_json(raw: Column) -> Column:
    """VARIANT, or null where the text is not one JSON document."""
    return F.try_parse_json(raw)


def member(doc: Column, path: str) -> Column:
    """The value at a path as VARIANT; null only where it is missing."""
    return F.try_variant_get(doc, path, "variant")


def kind(value: Column) -> Column:
    """``STRING``, ``BIGINT``, ``DECIMAL(..)``, ``BOOLEAN``, ``VOID``, ...; null if missing."""
    return F.schema_of_variant(value)


def is_object(value: Column) -> Column:
    return F.try_variant_get(value, "$", "map<string,variant>").isNotNull()


def is_number(value_kind: Column) -> Column:
    return value_kind.rlike(r"\A(BIGINT|DECIMAL|DOUBLE|FLOAT)")


def as_text(value: Column) -> Column:
    return F.try_variant_get(value, "$", "string")


def js_text(value: Column) -> Column:
    """A scalar as JavaScript's String() shows it: 525.0 is ``525``; null stays null."""
    number = F.try_variant_get(value, "$", "double")
    return F.when(is_number(kind(value)), js_number_text(number)).otherwise(as_text(value))


def is_truthy(value: Column) -> Column:
    """JavaScript truthiness of a VARIANT: not missing, null, empty text, zero or false."""
    text = as_text(value)
    value_kind = kind(value)
    return F.coalesce(
        F.when(value_kind == "STRING", text != "")
        .when(value_kind == "BOOLEAN", text == "true")
        .when(is_number(value_kind), F.try_variant_get(value, "$", "double") != 0)
        .when(value_kind == "VOID", F.lit(False))
        .otherwise(value.isNotNull()),
        F.lit(False))
