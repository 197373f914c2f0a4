"""The expected result of each query as DuckDB SQL over the same tables.

The inputs follow fixed arithmetic on table keys, so most of these state the expected outcome
by key instead of repeating the operator.
"""

from __future__ import annotations

BILLS = """b AS (
  SELECT o_orderkey AS k, 'bill_' || o_orderkey || '.jpg' AS file,
         'Customer ' || o_custkey AS vendor_name, 'INV-' || o_orderkey AS invoice_number,
         strftime(o_orderdate, '%Y-%m-%d') AS date, o_orderdate, o_totalprice AS total_amount,
         (o_orderkey % 500) / 4.0 AS tax_amount,
         lpad(CAST(o_orderkey % 38 AS VARCHAR), 2, '0') || 'ABCDE'
           || lpad(CAST(o_orderkey % 10000 AS VARCHAR), 4, '0') || 'F1Z5' AS gstin
  FROM orders)"""

LINES = """l AS (
  SELECT l_orderkey AS k, p_name AS product_desc, l_quantity AS quantity,
         l_extendedprice AS total_price,
         row_number() OVER (PARTITION BY l_orderkey
                            ORDER BY p_name, l_quantity, l_extendedprice) - 1 AS position
  FROM lineitem JOIN part ON l_partkey = p_partkey),
n AS (SELECT k, count(*) AS n_items FROM l GROUP BY k)"""


def _class(items: bool) -> str:
    return f"""CASE WHEN k % 29 = 2 THEN 'json' WHEN k % 11 = 3 THEN 'total_text'
         WHEN k % 13 = 5 THEN 'vendor_missing'
         {"WHEN k % 23 = 8 AND n_items > 0 THEN 'item_desc_missing'" if items else ""}
         WHEN k % 19 = 6 THEN 'bad_date' WHEN k % 17 = 4 THEN 'total_numeric_text'
         ELSE 'ok' END"""


DOCS = f"""WITH {BILLS}, {LINES},
x AS (SELECT b.*, coalesce(n_items, 0) AS n_items FROM b LEFT JOIN n USING (k)),
d AS (SELECT *, {_class(True)} AS class FROM x),
ok AS (SELECT *, md5(vendor_name || '_' || date || '_' || CAST(total_amount AS VARCHAR))
         AS invoice_hash FROM d WHERE class IN ('ok', 'total_numeric_text'))"""

HEADS = f"""WITH {BILLS}, d AS (SELECT *, {_class(False)} AS class FROM b),
ok AS (SELECT *, md5(vendor_name || '_' || date || '_' || CAST(total_amount AS VARCHAR))
         AS invoice_hash FROM d WHERE class IN ('ok', 'total_numeric_text')),
v AS (SELECT vendor_name, row_number() OVER (ORDER BY min(k)) AS vendor_id
      FROM ok GROUP BY vendor_name)"""

CHANGED_TAX = ("CASE k % 7 WHEN 0 THEN tax_amount + 1 WHEN 1 THEN NULL "
               "ELSE tax_amount END")

PAIRS = """WITH p AS (
  SELECT p_partkey AS k, p_name AS truth,
         coalesce(lead(p_name) OVER (ORDER BY p_partkey),
                  first_value(p_name) OVER (ORDER BY p_partkey)) AS following FROM part),
q AS (
  SELECT k, truth, CASE k % 8 WHEN 0 THEN truth WHEN 1 THEN upper(truth) || ' Pvt. Ltd.'
    WHEN 2 THEN left(truth, -1) WHEN 3 THEN truth[1] || truth[3:]
    WHEN 4 THEN truth[1] || truth[3] || truth[2] || truth[4:]
    WHEN 5 THEN following WHEN 6 THEN '' END AS extracted FROM p)"""

FIELD_PAIRS = f"""WITH {BILLS}, f AS (
  SELECT k, total_amount AS amount_truth, date AS date_truth,
    CASE k % 6 WHEN 0 THEN total_amount WHEN 1 THEN total_amount
      WHEN 2 THEN floor(total_amount / 1000) WHEN 4 THEN round(total_amount + 0.3, 2) END
      AS number,
    CASE k % 4 WHEN 0 THEN date WHEN 1 THEN strftime(o_orderdate + INTERVAL 1 DAY, '%Y-%m-%d')
      WHEN 2 THEN strftime(o_orderdate, '%d/%m/%Y') END AS date
  FROM b)"""

# A number as JavaScript shows it: the amounts have at most two decimals.
JS = "regexp_replace(CAST({0} AS VARCHAR), '\\.0$', '')"

# One row per attempt with the outcome of each field, by key arithmetic. The vendor is compared
# without the phonetic arm: an empty name has similarity 0.
ATTEMPTS = f"""WITH {BILLS}, a AS (
  SELECT b.*, model, k % 53 <> 0 AS known, (model = 'm_b' AND k % 37 = 1) AS failed
  FROM b, (VALUES ('m_a'), ('m_b'), ('m_c')) m(model)
  WHERE NOT (model = 'm_c' AND k % 41 = 2)),
good AS (
  SELECT *, NOT (model = 'm_c' AND k % 9 = 0) AS vendor_ok,
    NOT (model = 'm_b' AND k % 8 = 0) AS number_ok,
    NOT (model = 'm_b' AND k % 5 = 0) AS date_ok,
    NOT (model = 'm_c' AND k % 2 = 0) AS total_ok, k % 4 <> 3 AS gstin_ok FROM a),
lenient AS (
  SELECT k, file, model, failed, NOT failed AS vendor_name,
    NOT failed AND (number_ok OR NOT known) AS invoice_number,
    NOT failed AND (date_ok OR NOT known) AS date,
    NOT failed AND (total_ok OR NOT known) AS total_amount,
    NOT failed AS tax_amount, NOT failed AS gstin FROM good),
strict AS (
  SELECT k, file, model, failed, known AND NOT failed AS evaluated,
    CASE WHEN known AND NOT failed THEN vendor_ok ELSE NOT failed END AS vendor_name,
    CASE WHEN known AND NOT failed THEN number_ok ELSE NOT failed END AS invoice_number,
    CASE WHEN known AND NOT failed THEN date_ok ELSE NOT failed END AS date,
    CASE WHEN known AND NOT failed THEN total_ok ELSE NOT failed END AS total_amount,
    NOT failed AS tax_amount,
    CASE WHEN known AND NOT failed THEN gstin_ok ELSE NOT failed END AS gstin FROM good),
scored AS (
  SELECT *, CAST(vendor_name AS INT) + CAST(invoice_number AS INT) + CAST(date AS INT)
    + CAST(total_amount AS INT) + CAST(tax_amount AS INT) + CAST(gstin AS INT) AS passed,
    printf('%.1f', passed / 6 * 100) || '%' AS accuracy_score
  FROM strict WHERE evaluated)"""

FIELD_ROWS = """
  UNPIVOT (SELECT model, {0} FROM {1} GROUP BY model)
  ON vendor_name, invoice_number, date, total_amount, tax_amount, gstin
  INTO NAME field VALUE correct"""
SUMS = ", ".join(f"count(*) FILTER (WHERE {f}) AS {f}" for f in (
    "vendor_name", "invoice_number", "date", "total_amount", "tax_amount", "gstin"))


def _metrics(source: str) -> str:
    return (f"{ATTEMPTS}, metrics AS (SELECT model, field, correct, (SELECT count(*) FROM b)"
            f" AS total FROM ({FIELD_ROWS.format(SUMS, source)}))")


def _vendor_norm(name: str, words: str) -> str:
    return (f"trim(regexp_replace(regexp_replace(regexp_replace(lower(coalesce({name}, '')),"
            f" '[^a-z0-9\\s]', '', 'g'), '\\b({words})\\b', '', 'g'), '\\s+', ' ', 'g'))")


CODE_WORDS = "pvt|ltd|private|limited|inc|corp|co|llc"
SPEC_WORDS = CODE_WORDS + "|store|traders"


def _vendor_match(words: str, accept: str) -> str:
    return f"""{PAIRS}, s AS (
  SELECT k, {_vendor_norm('extracted', words)} AS e, {_vendor_norm('truth', words)} AS t FROM q),
j AS (SELECT *, jaro_winkler_similarity(e, t) AS s FROM s)
SELECT k, CASE WHEN e = t THEN 1.0 ELSE round(s, 6) END AS score, e = t OR s {accept} AS is_match,
  CASE WHEN e = t THEN 'Exact match (Normalized)'
    WHEN s {accept} THEN 'Fuzzy match (Jaro-Winkler: ' || printf('%.2f', s) || ')'
    ELSE 'No match (Jaro-Winkler: ' || printf('%.2f', s) || ')' END AS details FROM j"""


def _resolution(names: str, vendors: str) -> str:
    return f"""WITH names AS ({names}), vendors AS ({vendors}),
i AS (SELECT name, {_vendor_norm('name', CODE_WORDS)} AS norm FROM names),
k AS (SELECT {_vendor_norm('vendor', CODE_WORDS)} AS norm, min(vendor) AS vendor
      FROM vendors GROUP BY 1),
u AS (SELECT DISTINCT norm FROM i),
scores AS (SELECT u.norm, k.vendor, CASE WHEN u.norm = k.norm THEN 2.0
             ELSE jaro_winkler_similarity(u.norm, k.norm) END AS s FROM u, k),
best AS (SELECT norm, vendor, s FROM scores WHERE s > 0.88
         QUALIFY row_number() OVER (PARTITION BY norm ORDER BY s DESC, vendor) = 1)
SELECT name, vendor AS vendor_name,
  CASE WHEN s = 2.0 THEN 'exact' WHEN s IS NULL THEN 'none' ELSE 'fuzzy' END AS arm,
  CASE WHEN s = 2.0 THEN 1.0 ELSE round(s, 6) END AS score
FROM i LEFT JOIN best USING (norm)"""


ITEMS_OUT = ("invoice_hash, CAST(position AS INT) AS position, product_desc, quantity,"
             " total_price")
INVOICE_OUT = "invoice_hash, vendor_name, date AS invoice_date, invoice_number, total_amount"

ORACLES = {
    # sources
    "admit_mime": """
SELECT 'bill_' || o_orderkey || '.' || (['jpg', 'JPEG', 'png', 'webp', 'pdf', 'txt'])
         [o_orderkey % 6 + 1] AS file_name,
  (['image/jpeg', 'image/jpeg', 'image/png', 'image/webp', 'application/pdf',
    'application/octet-stream'])[o_orderkey % 6 + 1] AS mime,
  CASE WHEN o_orderkey % 6 >= 4 THEN 'Please upload an image file.' END AS error FROM orders""",
    "scan_ground_truth": f"""WITH {BILLS}
SELECT file, vendor_name, invoice_number, date, total_amount, tax_amount,
  CASE WHEN k % 4 = 3 THEN 'Unspecified' ELSE gstin END AS gstin FROM b WHERE k % 53 <> 0""",
    "scan_ground_truth_object": f"""WITH {BILLS}
SELECT file, CASE WHEN k % 11 <> 0 THEN vendor_name END AS vendor_name,
  CASE WHEN k % 11 <> 0 THEN tax_amount END AS tax_amount, k % 11 = 0 AS broken
FROM b WHERE k % 53 <> 0""",
    "parse_payload": f"""{HEADS}
SELECT file AS file_name, CASE class WHEN 'json' THEN 'json' END AS error_type,
  CASE WHEN class <> 'json' THEN invoice_number END AS invoice_number FROM d""",
    "unwrap_envelope": """
SELECT doc_id, CASE WHEN doc_id % 3 < 2 THEN md5(text) END AS payload_md5 FROM documents""",
    "data_url_encode": """
SELECT doc_id, 'data:image/png;base64,' || to_base64(encode(text)) AS url FROM documents""",
    "data_url_decode": """
SELECT doc_id, 'image/png' AS mime, md5(text) AS content_md5, true AS rebuilt FROM documents""",
    "extract_with_retry": """
SELECT 'bill_' || o_orderkey || '.jpg' AS file_name,
  CASE WHEN o_orderkey % 10 <> 9 AND o_orderkey % 5 < 3
       THEN '{"k": ' || o_orderkey || '}' END AS raw,
  CAST(CASE WHEN o_orderkey % 10 = 9 THEN 1 ELSE least(o_orderkey % 5 + 1, 3) END AS INT)
    AS attempts,
  CASE WHEN o_orderkey % 10 = 9 OR o_orderkey % 5 >= 3 THEN 'extractor' END AS error_type,
  CASE WHEN o_orderkey % 10 = 9 THEN 'unreadable image'
       WHEN o_orderkey % 5 >= 3 THEN 'gave up after 3 attempts: busy' END AS error_message
FROM orders""",
    "model_fanout": """
SELECT 'bill_' || o_orderkey || '.jpg' AS file_name, model,
  CASE WHEN NOT (model = 'm_b' AND o_orderkey % 37 = 1)
       THEN '{"model": "' || model || '", "k": ' || o_orderkey || '}' END AS raw,
  CASE WHEN model = 'm_b' AND o_orderkey % 37 = 1 THEN 'model failed' END AS error_message
FROM orders, (VALUES ('m_a'), ('m_b'), ('m_c')) m(model)""",
    # validation and projections
    "validate_header": f"""{HEADS}
SELECT file AS file_name, CASE class WHEN 'json' THEN 'json'
  WHEN 'total_text' THEN 'total_amount: float_parsing'
  WHEN 'vendor_missing' THEN 'vendor_name: missing' ELSE '' END AS problems FROM d""",
    "validate_line_items": f"""{DOCS}
SELECT file AS file_name, CASE class WHEN 'json' THEN 'json'
  WHEN 'item_desc_missing' THEN 'line_items.0.product_desc: missing' ELSE '' END AS problems
FROM d""",
    "apply_defaults": """
SELECT o_orderkey AS k, CAST(o_orderkey % 2 AS INT) AS n_items,
  CASE WHEN o_orderkey % 2 = 0 THEN 0.0 WHEN o_orderkey % 3 = 0 THEN 1.0
       ELSE CAST(o_orderkey % 7 + 1 AS DOUBLE) END AS quantity, true AS tax_is_null FROM orders""",
    "route_valid_dlq": f"""{DOCS}
SELECT file AS file_name,
  CASE WHEN class IN ('ok', 'total_numeric_text') THEN 'load' ELSE 'dlq' END AS route,
  CASE WHEN class IN ('ok', 'total_numeric_text') THEN 'none' WHEN class = 'json' THEN 'json'
       WHEN class = 'bad_date' THEN 'constraint' ELSE 'validation' END AS error_type FROM d""",
    "check_load_constraints": f"""WITH {BILLS}
SELECT k, concat_ws('; ',
  CASE WHEN k % 31 = 2 THEN 'vendor_name: text_too_long' END,
  CASE WHEN k % 29 = 3 AND length(invoice_number) * 40 > 100
       THEN 'invoice_number: text_too_long' END,
  CASE WHEN k % 19 = 6 THEN 'invoice_date: date_invalid' END,
  CASE WHEN k % 23 = 1 THEN 'total_amount: numeric_overflow' END,
  CASE WHEN k % 17 = 5 THEN 'line_items.0.quantity: numeric_overflow' END) AS problems FROM b""",
    "evaluation_gate": f"{ATTEMPTS} SELECT file, model, evaluated FROM strict",
    "resolve_nested": "SELECT o_orderkey AS k, o_orderkey AS n FROM orders",
    "falsy_default": f"""WITH {BILLS}
SELECT k, CASE WHEN k % 3 = 1 THEN vendor_name ELSE 'Unknown' END AS vendor_name,
  CASE WHEN k % 4 = 1 THEN total_amount ELSE -1.0 END AS amount FROM b""",
    "expense_mapping": f"""WITH {BILLS}
SELECT k, 'ACC-1' AS account_id, CASE WHEN k % 3 = 0 THEN date ELSE '2024-01-31' END AS date,
  CASE WHEN k % 5 < 2 THEN total_amount ELSE 0.0 END AS amount,
  CASE WHEN k % 4 = 1 THEN 'N/A' ELSE invoice_number END AS reference_number,
  'Vendor: ' || CASE WHEN k % 4 = 0 THEN 'Unknown' ELSE vendor_name END || ' | GSTIN: '
    || CASE WHEN k % 4 = 2 THEN 'null' ELSE 'N/A' END AS description FROM b""",
    "expense_mapping_strict": f"""WITH {BILLS}
SELECT k, 'ACC-1' AS account_id, date, total_amount AS amount,
  invoice_number AS reference_number,
  'Vendor: ' || vendor_name || ' | GSTIN: ' || gstin AS description FROM b""",
    "export_expenses": f"""WITH {BILLS}
SELECT '{{"account_id":"ACC-1","date":"' || CASE WHEN k % 3 = 0 THEN date ELSE '2024-01-31' END
  || '","amount":' || CAST(CASE WHEN k % 5 < 2 THEN total_amount ELSE 0.0 END AS VARCHAR)
  || ',"reference_number":"' || CASE WHEN k % 4 = 1 THEN 'N/A' ELSE invoice_number END
  || '","description":"Vendor: ' || CASE WHEN k % 4 = 0 THEN 'Unknown' ELSE vendor_name END
  || ' | GSTIN: ' || CASE WHEN k % 4 = 2 THEN 'null' ELSE 'N/A' END || '"}}' AS value FROM b""",
    "sync_ledger": """
SELECT o_orderkey AS k, o_orderkey % 6 < 3 AS success,
  CASE WHEN o_orderkey % 6 = 0 THEN 'E' || o_orderkey WHEN o_orderkey % 6 < 3 THEN 'SUCCESS' END
    AS expense_id,
  CASE WHEN o_orderkey % 6 = 3 THEN 'limit' WHEN o_orderkey % 6 > 3
       THEN 'Accounting API returned non-zero code' END AS error FROM orders""",
    "unnest_line_items": f"""WITH {LINES}
SELECT k, CAST(position AS INT) AS position, product_desc, quantity, total_price FROM l""",
    "field_unpivot": f"""WITH {BILLS}, t AS (
  SELECT file, vendor_name, invoice_number, date, CAST(total_amount AS VARCHAR) AS total_amount,
    CAST(CAST(tax_amount AS DOUBLE) AS VARCHAR) AS tax_amount,
    CASE WHEN k % 4 = 3 THEN 'Unspecified' ELSE gstin END AS gstin FROM b WHERE k % 53 <> 0)
SELECT * FROM (UNPIVOT t ON vendor_name, invoice_number, date, total_amount, tax_amount, gstin
               INTO NAME field VALUE value)""",
    # loading
    "invoice_fingerprint": f"""WITH {BILLS}
SELECT k, md5(vendor_name || '_' || CASE WHEN k % 3 = 0 THEN 'None' ELSE date END || '_'
              || CAST(total_amount AS VARCHAR)) AS invoice_hash FROM b""",
    "collapse_batch": f"{HEADS} SELECT {INVOICE_OUT}, {CHANGED_TAX} AS tax_amount FROM ok",
    "upsert_vendors": f"""{HEADS}, first_load AS (
  SELECT vendor_name, row_number() OVER (ORDER BY min(k)) AS vendor_id FROM ok
  WHERE class = 'ok' GROUP BY vendor_name),
later AS (SELECT vendor_name, min(k) AS k FROM ok GROUP BY vendor_name
          HAVING vendor_name NOT IN (SELECT vendor_name FROM first_load))
SELECT vendor_id, vendor_name FROM first_load UNION ALL
SELECT (SELECT count(*) FROM first_load) + row_number() OVER (ORDER BY k), vendor_name
FROM later""",
    "upsert_invoices": f"""{HEADS}
SELECT row_number() OVER (ORDER BY class = 'total_numeric_text', k) AS invoice_id,
  invoice_hash, vendor_name, date AS invoice_date, CASE
    WHEN class = 'total_numeric_text' AND k % 7 = 0 THEN invoice_number || '-B'
    ELSE invoice_number END AS invoice_number, total_amount, {CHANGED_TAX} AS tax_amount
FROM ok""",
    "load_line_items": f"{DOCS} SELECT {ITEMS_OUT} FROM ok JOIN l USING (k)",
    "load_line_items_append": f"""{DOCS}
SELECT invoice_hash, CAST(position AS INT) AS position, CAST(2 AS BIGINT) AS n_rows
FROM ok JOIN l USING (k)""",
    "dlq": f"""{DOCS}
SELECT file AS file_name, CASE class WHEN 'json' THEN 'json' WHEN 'bad_date' THEN 'constraint'
    ELSE 'validation' END AS error_type,
  CASE class WHEN 'json' THEN 'json_invalid' WHEN 'bad_date' THEN 'invoice_date: date_invalid'
    WHEN 'total_text' THEN 'total_amount: float_parsing'
    WHEN 'vendor_missing' THEN 'vendor_name: missing'
    ELSE 'line_items.0.product_desc: missing' END AS error_message, true AS has_payload
FROM d WHERE class NOT IN ('ok', 'total_numeric_text')""",
    "dlq_compat": f"""{DOCS}
SELECT file AS file_name, 'ProcessingError' AS error_type, true AS no_payload
FROM d WHERE class NOT IN ('ok', 'total_numeric_text')""",
    "atomic_document_load": f"""{DOCS}, i AS (SELECT count(*) AS n FROM ok JOIN l USING (k))
SELECT (SELECT count(*) FROM d) - count(*) AS n_failed, count(*) AS n_loaded,
  count(DISTINCT vendor_name) AS n_vendors, count(*) AS n_invoices,
  count(*) AS n_invoices_with_vendor, (SELECT n FROM i) AS n_items,
  (SELECT n FROM i) AS n_items_with_invoice FROM ok""",
    "lookup_vendor_id": f"{HEADS} SELECT invoice_number, vendor_id FROM ok JOIN v USING (vendor_name)",
    "lookup_invoice_id": f"""{DOCS}, h AS (SELECT *, {_class(False)} AS head_class FROM x),
ids AS (SELECT k, row_number() OVER (ORDER BY k) AS invoice_id FROM h
        WHERE head_class IN ('ok', 'total_numeric_text'))
SELECT invoice_id, CAST(position AS INT) AS position, product_desc
FROM ok JOIN ids USING (k) JOIN l USING (k)""",
    "upsert_match": f"""{HEADS}
SELECT invoice_hash, CASE class WHEN 'ok' THEN 'update' ELSE 'insert' END AS action FROM ok""",
    "insert_only_new": f"""{HEADS}
SELECT invoice_hash, CASE WHEN k % 7 = 0 THEN invoice_number || '-B' ELSE invoice_number END
  AS invoice_number FROM ok WHERE class = 'total_numeric_text'""",
    "cascade_delete": f"""{DOCS}, h AS (SELECT *, {_class(False)} AS head_class FROM x)
SELECT 'vendors' AS table_name, count(DISTINCT vendor_name) AS n_rows FROM h
  WHERE head_class IN ('ok', 'total_numeric_text') AND vendor_name NOT LIKE '%7' UNION ALL
SELECT 'invoices', count(*) FROM ok WHERE vendor_name NOT LIKE '%7' UNION ALL
SELECT 'line_items', count(*) FROM ok JOIN l USING (k) WHERE vendor_name NOT LIKE '%7'""",
    "distinct_vendors": f"""{HEADS}
SELECT vendor_name, min(k) AS first_seq FROM ok GROUP BY vendor_name""",
    "vendor_date_rollup": f"""{HEADS}
SELECT vendor_id, date AS invoice_date, count(*) AS n_invoices,
  CAST(sum(CAST(total_amount AS DECIMAL(15,2))) AS DOUBLE) AS total_amount,
  CAST(sum(CAST(tax_amount AS DECIMAL(15,2))) AS DOUBLE) AS tax_amount
FROM ok JOIN v USING (vendor_name) GROUP BY vendor_id, date""",
    "assign_surrogates": """
SELECT o_orderkey, o_totalprice,
  1000 + row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS id FROM orders""",
    "dlq_partition": f"""{DOCS}
SELECT count(*) AS n_input, (SELECT count(*) FROM ok) AS n_valid,
  count(*) - (SELECT count(*) FROM ok) AS n_rejected, CAST(0 AS BIGINT) AS n_both,
  CAST(0 AS BIGINT) AS n_unbalanced FROM d""",
    # integrity
    "audit_not_null": f"""{HEADS}, c AS (
  SELECT count(*) FILTER (WHERE class IN ('json', 'vendor_missing')) AS vendor_name,
    count(*) FILTER (WHERE class IN ('json', 'total_text')) AS total_amount,
    count(*) FILTER (WHERE class = 'json') AS invoice_number FROM d)
UNPIVOT c ON vendor_name, total_amount, invoice_number INTO NAME column_name VALUE n_null""",
    "audit_unique": f"""{HEADS}
SELECT invoice_hash, CAST(2 AS BIGINT) AS n_rows FROM ok WHERE class = 'ok'""",
    "audit_foreign_keys": f"""{DOCS}, h AS (SELECT *, {_class(False)} AS head_class FROM x)
SELECT 'line_items.invoice_id' AS foreign_key, invoice_hash AS key,
  CAST(n_items AS BIGINT) AS n_rows FROM ok
WHERE class = 'total_numeric_text' AND n_items > 0 UNION ALL
SELECT 'invoices.vendor_id', vendor_name, count(*) FROM ok
WHERE vendor_name NOT IN (SELECT vendor_name FROM h WHERE head_class = 'ok') GROUP BY vendor_name""",
    "audit_idempotent_replay": f"""{DOCS}, c AS (
  SELECT 'vendors' AS table_name, count(DISTINCT vendor_name) AS n FROM ok UNION ALL
  SELECT 'invoices', count(*) FROM ok UNION ALL
  SELECT 'line_items', count(*) FROM ok JOIN l USING (k))
SELECT table_name, n AS n_before, n AS n_after FROM c""",
    # scalar functions
    "normalize_vendor": f"""{PAIRS}
SELECT k, {_vendor_norm('extracted', CODE_WORDS)} AS norm, truth || ' store' AS code,
  truth AS spec FROM q""",
    "jaro_winkler": f"""{PAIRS}
SELECT k, round(jaro_winkler_similarity(extracted, truth), 6) AS similarity FROM q
WHERE extracted IS NOT NULL""",
    "match_vendor": _vendor_match(CODE_WORDS, "> 0.88"),
    "spec_vendor_match": _vendor_match(SPEC_WORDS, ">= 0.85"),
    "match_float": f"""{FIELD_PAIRS}
SELECT k, CASE WHEN k % 6 < 2 THEN 1.0 ELSE 0.0 END AS score, k % 6 < 2 AS is_match,
  CASE WHEN k % 6 < 2 THEN 'Exact float match' WHEN number IS NULL THEN 'Invalid number format'
    ELSE 'Mismatch: expected ' || {JS.format('amount_truth')} || ', got '
      || {JS.format('number')} END AS details FROM f""",
    "match_date": """
SELECT o_orderkey AS k, CASE WHEN o_orderkey % 4 = 0 THEN 1.0 ELSE 0.0 END AS score,
  o_orderkey % 4 = 0 AS is_match,
  CASE o_orderkey % 4 WHEN 0 THEN 'Exact date match' WHEN 1 THEN 'Date mismatch'
    ELSE 'Invalid format. Expected YYYY-MM-DD' END AS details FROM orders""",
    "match_gstin": """
SELECT o_orderkey AS k, CASE WHEN o_orderkey % 4 = 0 THEN 1.0 ELSE 0.0 END AS score,
  o_orderkey % 4 = 0 AS is_match,
  CASE o_orderkey % 4 WHEN 0 THEN 'Exact GSTIN match' WHEN 1 THEN 'GSTIN mismatch'
    ELSE 'Fails standard GSTIN regex format' END AS details FROM orders""",
    "match_invoice_number": """
SELECT o_orderkey AS k, o_orderkey % 4 = 0 OR o_orderkey % 8 = 7 AS is_match,
  CASE WHEN o_orderkey % 4 = 0 OR o_orderkey % 8 = 7 THEN 'Exact match' ELSE 'Mismatch' END
    AS details FROM orders""",
    "match_field_lenient": f"""{FIELD_PAIRS}
SELECT k, CASE WHEN k % 7 = 0 THEN true WHEN k % 6 = 5 THEN false WHEN k % 6 = 2 THEN
    abs(floor(amount_truth) - amount_truth) < 0.5 ELSE true END AS amount,
  k % 4 = 0 AS date, k % 4 <> 1 AS gstin FROM f""",
    "evaluate_extraction": f"""{ATTEMPTS}
SELECT file, model, accuracy_score, CAST(passed AS INT) AS passed, vendor_name, invoice_number,
  date, total_amount, tax_amount, gstin FROM scored""",
    "field_correct": f"""{ATTEMPTS}
SELECT file, model, vendor_name, invoice_number, date, total_amount, tax_amount, gstin
FROM strict""",
    "py_float_text": f"""WITH {BILLS}
SELECT k, CASE k % 6 WHEN 0 THEN CAST(total_amount AS VARCHAR)
  WHEN 1 THEN CAST(CAST(floor(total_amount) AS BIGINT) AS VARCHAR) || '.0'
  WHEN 2 THEN CAST(CAST(round(total_amount * 1000) AS BIGINT) AS VARCHAR) || '.0'
  WHEN 3 THEN CASE WHEN k % 1000000 = 0 THEN CAST(k // 1000000 AS VARCHAR) || '.0'
    WHEN k >= 100 THEN regexp_replace(CAST(CAST(k / 1e6 AS DECIMAL(18, 6)) AS VARCHAR), '0+$', '')
    WHEN k % 10 = 0 THEN CAST(k // 10 AS VARCHAR) || 'e-05'
    WHEN k > 10 THEN CAST(k // 10 AS VARCHAR) || '.' || CAST(k % 10 AS VARCHAR) || 'e-05'
    ELSE CAST(k AS VARCHAR) || 'e-06' END
  WHEN 4 THEN CASE WHEN floor(total_amount) >= 10000 THEN
      regexp_replace(regexp_replace(left(CAST(CAST(floor(total_amount) AS BIGINT) AS VARCHAR), 1)
        || '.' || substr(CAST(CAST(floor(total_amount) AS BIGINT) AS VARCHAR), 2), '0+$', ''),
        '\\.$', '') || 'e+' || CAST(11 + length(CAST(CAST(floor(total_amount) AS BIGINT)
        AS VARCHAR)) AS VARCHAR)
    ELSE CAST(CAST(floor(total_amount) AS BIGINT) AS VARCHAR) || repeat('0', 12) || '.0' END
  ELSE '-' || CAST(total_amount AS VARCHAR) END AS shown FROM b""",
    "js_number_text": f"""WITH {BILLS}
SELECT k, CASE k % 6 WHEN 0 THEN CAST(CAST(floor(total_amount) AS BIGINT) AS VARCHAR)
  WHEN 1 THEN CAST(CAST(floor(total_amount) AS BIGINT) AS VARCHAR)
  WHEN 2 THEN CAST(CAST(floor(total_amount * 1000) AS BIGINT) AS VARCHAR)
  WHEN 3 THEN CAST(k // 1000000 AS VARCHAR)
  WHEN 4 THEN CAST(CAST(floor(total_amount) AS BIGINT) AS VARCHAR) || repeat('0', 12)
  ELSE CAST(CAST(floor(-total_amount) AS BIGINT) AS VARCHAR) END AS shown FROM b""",
    "date_or_today": f"""{FIELD_PAIRS}
SELECT k, CASE WHEN k % 4 < 2 THEN date ELSE '2024-01-31' END AS date FROM f""",
    "number_or_zero": f"""{FIELD_PAIRS}
SELECT k, CASE WHEN k % 6 IN (0, 1, 4) THEN number ELSE 0.0 END AS amount FROM f""",
    # evaluation reports
    "union_models": f"{ATTEMPTS} SELECT file, model, failed FROM a",
    "join_ground_truth": f"""{ATTEMPTS}
SELECT file, model, known, CASE WHEN known THEN total_amount END AS truth_total FROM a""",
    "result_grid": f"""{ATTEMPTS}, c AS (
  SELECT model, count(*) FILTER (WHERE NOT failed) AS n FROM a GROUP BY model)
SELECT model, field, (SELECT count(*) FROM b) AS n_cells,
  (SELECT count(*) FROM b) - n AS n_without_extraction
FROM c, (VALUES ('vendor_name'), ('invoice_number'), ('date'), ('total_amount'), ('tax_amount'),
         ('gstin')) f(field)""",
    "pairwise_compare": f"""{ATTEMPTS}
SELECT file, model, vendor_name, invoice_number, date, total_amount, tax_amount, gstin
FROM lenient""",
    "field_metrics": f"{_metrics('lenient')} SELECT * FROM metrics",
    "field_metrics_strict": f"{_metrics('strict')} SELECT * FROM metrics",
    "field_accuracy_pct": f"""{_metrics('lenient')}
SELECT model, field, CAST(round(correct / total * 100) AS INT) AS pct FROM metrics""",
    "document_score": f"""{ATTEMPTS}
SELECT model, accuracy_score, count(*) AS n_bills FROM scored GROUP BY ALL""",
    "accuracy_matrix": f"""{_metrics('lenient')}
SELECT field, CAST(max(round(correct / total * 100)) FILTER (WHERE model = 'm_a') AS INT) AS m_a,
  CAST(max(round(correct / total * 100)) FILTER (WHERE model = 'm_b') AS INT) AS m_b,
  CAST(max(round(correct / total * 100)) FILTER (WHERE model = 'm_c') AS INT) AS m_c,
  CASE field WHEN 'vendor_name' THEN 'High (Cursive)' WHEN 'gstin' THEN 'High (15-digit OCR)'
    ELSE 'Medium' END AS difficulty FROM metrics GROUP BY field""",
    "progress": f"""{ATTEMPTS}
SELECT count(*) AS evaluated, count(*) FILTER (WHERE k % 53 <> 0) AS expected FROM b""",
    "progress_observed": f"""{ATTEMPTS}
SELECT count(DISTINCT k % 5) AS n_batches, count(*) AS n_attempts,
  count(*) FILTER (WHERE failed) AS n_failed, max(k) AS last_bill FROM a""",
    "extract_resumed": f"""WITH {BILLS}
SELECT file AS file_name, '{{"k": ' || k || '}}' AS raw, 1 AS attempts, k % 2 = 0 AS from_ledger,
  CAST(NULL AS VARCHAR) AS error_message FROM b""",
    "model_cost": f"""{ATTEMPTS}
SELECT model, count(*) AS n_bills, CASE model WHEN 'm_a' THEN 0.007 ELSE 0.0 END::DOUBLE
  AS cost_per_100, count(*) * (CASE model WHEN 'm_a' THEN 0.007 ELSE 0.0 END)::DOUBLE / 100
  AS run_cost FROM a GROUP BY model""",
    "rank_models": f"""{_metrics('lenient')}, r AS (
  SELECT model, round(avg(correct / total * 100), 6) AS mean_accuracy,
    (CASE model WHEN 'm_a' THEN 0.007 ELSE 0.0 END)::DOUBLE AS cost_per_100
  FROM metrics GROUP BY model)
SELECT *, CAST(row_number() OVER (ORDER BY mean_accuracy DESC, cost_per_100, model) AS INT)
  AS place FROM r""",
    "top_model": f"""{_metrics('lenient')}
SELECT model, CAST(1 AS INT) AS place FROM metrics GROUP BY model
ORDER BY avg(correct / total) DESC, model LIMIT 1""",
    "status_band": f"""{ATTEMPTS}
SELECT s.file, s.model, CASE WHEN passed IS NULL THEN 'not run' WHEN passed >= 5 THEN 'good'
    ELSE 'weak' END AS band,
  CASE WHEN s.failed THEN 'failed' WHEN passed = 6 THEN 'perfect' ELSE 'partial' END AS run,
  CASE WHEN s.failed THEN 'Error / Failed'
    ELSE coalesce(passed, 0) || ' / 6 (' || coalesce(accuracy_score, '0%') || ')' END AS label
FROM strict s LEFT JOIN scored USING (k, model)""",
    "evaluate_run": f"""{ATTEMPTS}, every AS (
  SELECT b.k, b.file, model, a.k IS NULL AS silent, coalesce(a.failed, true) AS failed
  FROM b CROSS JOIN (VALUES ('m_a'), ('m_b'), ('m_c')) m(model) LEFT JOIN a USING (k, model))
SELECT e.file, e.model,
  CASE WHEN silent THEN 'model gave no output' WHEN e.failed THEN 'model failed' END AS error,
  CASE WHEN passed IS NULL THEN 'not run' WHEN passed >= 5 THEN 'good' ELSE 'weak' END AS band,
  CASE WHEN e.failed THEN 'failed' WHEN passed = 6 THEN 'perfect' ELSE 'partial' END AS run,
  CASE WHEN e.failed THEN 'Error / Failed'
    ELSE coalesce(passed, 0) || ' / 6 (' || coalesce(accuracy_score, '0%') || ')' END AS label
FROM every e LEFT JOIN scored USING (k, model)""",
    "evaluation_document_read": f"""{ATTEMPTS}, every AS (
  SELECT b.k, b.file, model, a.k IS NULL AS silent, coalesce(a.failed, true) AS failed,
    CASE WHEN a.k IS NOT NULL AND NOT a.failed AND NOT (model = 'm_b' AND b.k % 8 = 0)
      THEN b.invoice_number END AS invoice_number
  FROM b CROSS JOIN (VALUES ('m_a'), ('m_b'), ('m_c')) m(model) LEFT JOIN a USING (k, model))
SELECT e.file, e.model,
  CASE WHEN silent THEN 'model gave no output' WHEN e.failed THEN 'model failed' END AS error,
  e.invoice_number, passed, accuracy_score
FROM every e LEFT JOIN scored USING (k, model)""",
    "field_difficulty": f"""{_metrics('lenient')}
SELECT model, field, CASE field WHEN 'vendor_name' THEN 'High (Cursive)'
  WHEN 'gstin' THEN 'High (15-digit OCR)' ELSE 'Medium' END AS difficulty FROM metrics""",
    "results_in_bill_order": f"""{ATTEMPTS}
SELECT file, model, k AS bill_seq FROM a ORDER BY k, model""",
    # vendor resolution
    "vendor_resolution": _resolution(
        f"{PAIRS} SELECT DISTINCT extracted AS name FROM q",
        "SELECT p_name AS vendor FROM part"),
    "vendor_resolution_customers": _resolution(
        "SELECT DISTINCT lower(c_name) AS name FROM customer",
        "SELECT replace(s_name, 'Supplier#0', 'Customer#') AS vendor FROM supplier"),
    # streaming
    "stream_ingest_upsert": f"""{DOCS}
SELECT CAST(n_items AS BIGINT) AS n_items, {INVOICE_OUT}, tax_amount FROM ok""",
    "stream_ingest_stateful": f"""{DOCS}
SELECT CAST(n_items AS BIGINT) AS n_items, {INVOICE_OUT},
  CASE WHEN k % 5 = 0 THEN {CHANGED_TAX} ELSE tax_amount END AS tax_amount FROM ok""",
    "stream_dedup": f"""{HEADS}
SELECT invoice_hash, 'kept' AS outcome, strftime(DATE '2024-05-01' + CAST(k % 5 AS INT), '%Y-%m-%d')
  AS arrived, false AS has_reason FROM ok
UNION ALL SELECT invoice_hash, 'late', '2024-04-21', true FROM ok WHERE k % 10 = 1""",
    "field_metrics_reattempted": f"{_metrics('lenient')} SELECT * FROM metrics",
    "stream_field_metrics": f"{_metrics('lenient')} SELECT * FROM metrics",
    "stream_token_bucket": f"""{ATTEMPTS}
SELECT model, count(*) AS n_released, count(*) AS n_requests, true AS within_pace
FROM a GROUP BY model""",
    "stream_rate_limit": """
SELECT o_orderkey % 5 AS batch_id, (SELECT count(*) FROM orders) / 5 * (o_orderkey % 5 + 1)
  AS n_bills FROM orders GROUP BY 1""",
}
