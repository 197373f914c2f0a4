"""Typed validation of raw payloads; every violation of a document is reported together.

All rules are native expressions over VARIANT, so validation is one pass without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from billflow.functions import variants as V
from billflow.functions.numbers import WHOLE_NUMBER_OR_WORD
from billflow.operators.once import computed_once
from billflow.schemas import (
    AMOUNT_TYPE, MAX_INVOICE_NUMBER, MAX_VENDOR_NAME, QUANTITY_TYPE)


def quoted(text: str) -> str:
    """A raw SQL string literal: backslashes of patterns stay as they are."""
    return "r'" + text + "'"


ERRORS = "array<struct<loc:string,type:string>>"

HEADER_RULES = (
    ("vendor_name", "text", True),
    ("invoice_number", "text", False),
    ("invoice_date", "text", False),
    ("total_amount", "number", True),
    ("tax_amount", "number", False),
)
ITEM_RULES = (
    ("product_desc", "text", True, False),
    ("quantity", "number", False, False),
    ("unit_price", "number", False, True),
    ("total_price", "number", False, True),
)


# The rules are put together as SQL text: the planner parses each once, where the same
# expressions built from column objects cost a call into the JVM per node.

NO_ERRORS = f"CAST(array() AS {ERRORS})"


def _listing(checks: list[tuple[str, str]]) -> str:
    """The violations among (place, violation or null) pairs."""
    pairs = ", ".join(f"named_struct('loc', {loc}, 'type', {found})" for loc, found in checks)
    return f"filter(array({pairs}), e -> e.type IS NOT NULL)"


def _none_found(checks: list[tuple[str, str]]) -> str:
    return f"coalesce({', '.join(found for _, found in checks)}) IS NULL"


def _item_listing(items: str, checks: list[tuple[str, str]], wrong_item: str = "") -> str:
    """Violations in a list ``v`` at ``i``; a clean list, the usual case, is only looked through."""
    sound, of_item = _none_found(checks), _listing(checks)
    if wrong_item:
        sound = f"v.is_object AND {sound}"
        of_item = f"CASE WHEN v.is_object THEN {of_item} ELSE {wrong_item} END"
    return (f"CASE WHEN forall({items}, v -> {sound}) THEN {NO_ERRORS}"
            f" ELSE flatten(transform({items}, (v, i) -> {of_item})) END")


def _opened(rules, *more: str) -> str:
    return "struct<" + ",".join(f"{name}:variant" for name in [*(r[0] for r in rules), *more]) + ">"


def _read(opened: str, rules) -> str:
    """Kind, text and number of each named member."""
    members = []
    for name, kind, *_ in rules:
        at = f"{opened}.{name}"
        number = f", 'number', try_variant_get({at}, '$', 'double')" if kind == "number" else ""
        members.append(f"'{name}', named_struct('kind', schema_of_variant({at}),"
                       f" 'text', try_variant_get({at}, '$', 'string'){number})")
    return f"named_struct({', '.join(members)})"


def read_document(documents: DataFrame, doc: str) -> DataFrame:
    """Adds ``_header``, ``_items`` (null unless a list) and ``_listed`` of a VARIANT column.

    Each object is opened into its members in one go, which is several times cheaper than a
    path lookup per member. A member that is missing stays null, a JSON null does not.
    """
    members = _opened(HEADER_RULES, "line_items")
    listed = f"array<{_opened(ITEM_RULES)}>"
    opened = computed_once(documents, _open=F.expr(f"try_variant_get({doc}, '$', '{members}')"))
    items = (f"transform(try_variant_get(_open.line_items, '$', '{listed}'), v -> named_struct("
             f"'is_object', v IS NOT NULL, 'fields', {_read('v', ITEM_RULES)}))")
    return computed_once(
        opened, _header=F.expr(_read("_open", HEADER_RULES)), _items=F.expr(items),
        _listed=F.expr("_open.line_items IS NOT NULL")).drop("_open")


def _problem(field: str, kind: str, required: bool, nullable: bool, strict: bool) -> str:
    cases = [f"WHEN {field}.kind IS NULL THEN {quoted('missing') if required else 'NULL'}"]
    if nullable:
        cases.append(f"WHEN {field}.kind = 'VOID' THEN NULL")
    if kind == "text":
        cases.append(f"WHEN {field}.kind <> 'STRING' THEN 'string_type'")
    else:
        numbers = "BIGINT|DECIMAL|DOUBLE|FLOAT" + ("" if strict else "|BOOLEAN")
        cases.append(f"WHEN {field}.kind RLIKE '^({numbers})' THEN NULL")
        if not strict:
            cases.append(
                f"WHEN {field}.kind = 'STRING' THEN CASE WHEN {field}.text NOT RLIKE "
                f"{quoted(WHOLE_NUMBER_OR_WORD)} THEN 'float_parsing' END")
        cases.append("ELSE 'float_type'")
    return f"CASE {' '.join(cases)} END"


def _value(field: str, kind: str) -> str:
    if kind == "text":
        return f"CASE WHEN {field}.kind = 'STRING' THEN {field}.text END"
    return (f"CASE WHEN {field}.kind <> 'STRING' THEN {field}.number"
            f" WHEN {field}.text RLIKE {quoted(WHOLE_NUMBER_OR_WORD)}"
            f" THEN try_cast(trim({field}.text) AS DOUBLE) END")


def header_errors(header: str = "_header", strict: bool = False) -> Column:
    checks = [(quoted(name), _problem(f"{header}.{name}", kind, required, not required, strict))
              for name, kind, required in HEADER_RULES]
    return F.expr(f"CASE WHEN {_none_found(checks)} THEN {NO_ERRORS} ELSE {_listing(checks)} END")


def line_item_errors(items: str = "_items", listed: str = "_listed",
                     strict: bool = False) -> Column:
    checks = [(f"concat('line_items.', i, '.{name}')",
               _problem(f"v.fields.{name}", kind, required, nullable, strict))
              for name, kind, required, nullable in ITEM_RULES]
    wrong = "array(named_struct('loc', concat('line_items.', i), 'type', 'model_type'))"
    return F.expr(
        f"CASE WHEN {items} IS NOT NULL THEN {_item_listing(items, checks, wrong)}"
        f" WHEN {listed} THEN array(named_struct('loc', 'line_items', 'type', 'list_type'))"
        f" ELSE {NO_ERRORS} END")


def typed_invoice(header: str = "_header", items: str = "_items") -> Column:
    """The document as a typed struct with defaults: quantity 1.0, no line items -> []."""
    values = {name: _value(f"v.fields.{name}", kind) for name, kind, *_ in ITEM_RULES}
    values["quantity"] = (
        f"CASE WHEN v.fields.quantity.kind IS NULL THEN 1.0D ELSE {values['quantity']} END")
    item = ", ".join(f"'{name}', {value}" for name, value in values.items())
    head = ", ".join(f"'{name}', {_value(f'{header}.{name}', kind)}"
                     for name, kind, _ in HEADER_RULES)
    return F.expr(
        f"named_struct({head}, 'line_items', coalesce("
        f"transform({items}, v -> named_struct({item})), array()))")


def load_errors(invoice: str = "_typed") -> Column:
    """What the staging tables would refuse: no such date, too wide a number, too long a text."""

    def too_wide(value: str, column_type: str) -> str:
        return (f"CASE WHEN {value} IS NOT NULL AND try_cast({value} AS {column_type}) IS NULL"
                " THEN 'numeric_overflow' END")

    def too_long(name: str, limit: int) -> str:
        return f"CASE WHEN length({invoice}.{name}) > {limit} THEN 'text_too_long' END"

    date = f"{invoice}.invoice_date"
    checks = [
        ("'vendor_name'", too_long("vendor_name", MAX_VENDOR_NAME)),
        ("'invoice_number'", too_long("invoice_number", MAX_INVOICE_NUMBER)),
        ("'invoice_date'", f"CASE WHEN {date} IS NOT NULL AND "
                           f"try_to_date({date}, 'yyyy-MM-dd') IS NULL THEN 'date_invalid' END"),
        *[(quoted(c), too_wide(f"{invoice}.{c}", AMOUNT_TYPE))
          for c in ("total_amount", "tax_amount")]]
    item_checks = [
        (f"concat('line_items.', i, '.{c}')", too_wide(f"v.{c}", column_type))
        for c, column_type in (("quantity", QUANTITY_TYPE), ("unit_price", AMOUNT_TYPE),
                               ("total_price", AMOUNT_TYPE))]
    of_header = f"CASE WHEN {_none_found(checks)} THEN {NO_ERRORS} ELSE {_listing(checks)} END"
    return F.expr(f"concat({of_header}, {_item_listing(f'{invoice}.line_items', item_checks)})")


def _told(documents: DataFrame) -> list[Column]:
    """What the extractor said about documents it failed on, where such columns came along."""
    return [F.col(c) for c in ("error", "error_message") if c in documents.columns]


def validate(documents: DataFrame, raw: str = "raw", strict: bool = False) -> DataFrame:
    """Adds ``invoice`` (typed, null if invalid), ``errors`` and ``error_type``.

    ``error_type`` is null for a document that can be loaded, else ``json``, ``validation`` or
    ``constraint``. A ready ``error`` or ``error_message`` (a failed extractor) becomes ``extractor``.
    """
    failed = F.coalesce(*_told(documents), F.lit(None)).isNotNull()
    parsed = computed_once(documents, _doc=V.parse_json(F.col(raw)))
    read = read_document(parsed, "_doc")
    doc = F.col("_doc")
    whole = F.when(doc.isNull(), "json_invalid").when(~V.is_object(doc), "model_type")
    unreadable = F.array(F.struct(F.lit("").alias("loc"), whole.alias("type"))).cast(ERRORS)
    found = F.when(whole.isNotNull(), unreadable).otherwise(
        F.concat(header_errors(strict=strict), line_item_errors(strict=strict)))
    typed = computed_once(read, _found=found, _typed=typed_invoice(), _json=doc.isNull()).drop(
        "_doc", "_header", "_items", "_listed")
    sound = F.size("_found") == 0
    refused = F.when(sound, load_errors()).otherwise(F.col("_found"))
    routed = computed_once(
        typed, invoice=F.when(sound, F.col("_typed")), errors=refused, _sound=sound)
    error_type = (
        F.when(failed, "extractor")
        .when(F.col("_json"), "json")
        .when(~F.col("_sound"), "validation")
        .when(F.size("errors") > 0, "constraint"))
    return routed.withColumn("error_type", error_type).drop(
        "_found", "_typed", "_sound", "_json")


def accepted(validated: DataFrame) -> DataFrame:
    return validated.where(F.col("error_type").isNull())


def rejected(validated: DataFrame) -> DataFrame:
    return validated.where(F.col("error_type").isNotNull())


def error_message(errors: Column) -> Column:
    """One readable line out of all violations of a document."""
    return F.array_join(F.transform(errors, lambda e: F.concat_ws(
        ": ", F.when(e["loc"] != "", e["loc"]), e["type"])), "; ")


def dlq_columns(validated: DataFrame, file: str = "file_name", raw: str = "raw") -> list[Column]:
    """_file_name, _error_message and _raw_payload of a document, with its payload kept for review."""
    told = F.coalesce(*_told(validated), error_message(F.col("errors")))
    payload = F.when(F.col(raw) != "", F.to_json(F.struct(F.col(raw).alias("raw"))))
    return [F.col(file).alias("_file_name"), told.alias("_error_message"),
            payload.alias("_raw_payload")]


def dlq_rows(validated: DataFrame, file: str = "file_name", raw: str = "raw",
             seq: str | None = None) -> DataFrame:
    """Dead-letter rows of the rejected documents, with their ``seq`` where it is asked for."""
    name, told, payload = dlq_columns(validated, file, raw)
    kept = [] if seq is None else [seq]
    return rejected(validated).select(name, "error_type", told, payload, *kept).toDF(
        "file_name", "error_type", "error_message", "raw_payload", *kept)


def dlq_compat(dlq: DataFrame) -> DataFrame:
    """The dead-letter view with one constant error type and no payload."""
    return dlq.withColumn("error_type", F.lit("ProcessingError")).withColumn(
        "raw_payload", F.lit(None).cast("string"))


def unnest_line_items(invoices: DataFrame, items: str = "line_items") -> DataFrame:
    """One row per nested item with its position."""
    kept = [c for c in invoices.columns if c != items]
    return invoices.select(*kept, F.posexplode(items).alias("position", "item")).select(
        *kept, "position", "item.*")
