"""One checkable query per operator, over whole test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from billflow import fixtures as X
from billflow.functions import match as M, numbers as N, text as T, variants as V
from billflow.functions import phonetic as P
from billflow.functions.similarity import jaro_winkler
from billflow.operators import evaluate as E, expense, integrity, load, validate as val
from billflow.operators.lookup import insert_only_new, number_rows
from billflow.operators.once import computed_once
from billflow.operators.resolve import resolve_vendors
from billflow.operators.vendor_match import match_vendors
from billflow.plans.etl import evaluate_run, load_summary, run_log
from billflow.plans.store import StagingStore
from billflow.schemas import FIELDS, MODEL_COST_PER_100, MODELS
from billflow.sources import extract, files, ledger, payloads
from billflow.sources.members import open_files
from billflow.streaming import ingest, state
from billflow.workspace import fresh_dir, shuffles_going, written

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# Shared inputs -------------------------------------------------------------------------------

def _rows(spark, sf, items=False, changed=False, strict=False) -> DataFrame:
    """Load rows of the accepted documents, validated once and written."""
    docs = X.documents(spark, sf, items, changed)
    return written(load.load_rows(val.accepted(val.validate(docs, strict=strict))), "rows")


def _empty(spark, ddl: str) -> DataFrame:
    return spark.createDataFrame([], ddl)


def _invoice_columns(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.col("invoice_id") if "invoice_id" in rows.columns else F.lit(None).alias("invoice_id"),
        "invoice_hash", "vendor_name", "invoice_date", "invoice_number", "total_amount",
        "tax_amount")


def _current_invoices(spark, sf) -> DataFrame:
    """The invoice table after a strict first load."""
    batch = load.collapse_batch(_rows(spark, sf, strict=True).drop("line_items"))
    return _invoice_columns(number_rows(batch, "seq", "invoice_hash", "invoice_id"))


def _changed_batch(spark, sf) -> DataFrame:
    return load.collapse_batch(_rows(spark, sf, changed=True).drop("line_items"))


def _shown(invoices: DataFrame, *extra: str) -> DataFrame:
    return invoices.select(
        *extra, "invoice_hash", "vendor_name",
        F.date_format("invoice_date", "yyyy-MM-dd").alias("invoice_date"), "invoice_number",
        F.col("total_amount").cast("double").alias("total_amount"),
        F.col("tax_amount").cast("double").alias("tax_amount"))


def _vendors(spark, sf) -> DataFrame:
    none = _empty(spark, "vendor_id bigint, vendor_name string, tax_id string")
    return load.upsert_vendors(none, _rows(spark, sf))


def _attempts(spark, sf) -> DataFrame:
    outputs = X.model_outputs(spark, sf)
    return E.parse_attempts(E.union_models(outputs))


def _joined(spark, sf) -> DataFrame:
    return E.join_ground_truth(_attempts(spark, sf), X.truth(spark, sf))


def _scored(spark, sf) -> DataFrame:
    return E.evaluate(_joined(spark, sf), phonetic=False)


def _metrics(spark, sf) -> DataFrame:
    return E.field_metrics(_joined(spark, sf), MODELS)


def _result(column: str) -> list:
    value = F.col(column)
    return [F.round(value["score"], 6).alias("score"), value["is_match"].alias("is_match"),
            value["details"].alias("details")]


def _stored(spark, rows: DataFrame, purpose: str, by=None, files: int = 5) -> str:
    """Write rows to the shared folder, one file for each value 0, 1, ... of ``by``, for file sources."""
    path = fresh_dir(spark, purpose)
    if by is not None:
        parts = rows.withColumn("_part", by.cast("int"))
        rows = parts.repartitionById(files, F.col("_part")).drop("_part")
    with shuffles_going(spark):
        rows.write.parquet(path)
    return path


def _one_file(spark, lines: DataFrame, path: str) -> None:
    """Ordered lines as the one file of a folder: many tasks write their ranges, and one copies these together,
    a piece at a time."""
    parts = fresh_dir(spark, "ranges")
    lines.write.text(parts)

    def copied(batches):
        for batch in batches:
            if batch.num_rows:
                system, found = open_files(parts)
                folder = "/".join([found[0][0].rsplit("/", 2)[0], path.rsplit("/", 1)[1]])
                system.create_dir(folder)
                with system.open_output_stream(f"{folder}/whole.json") as whole:
                    for name, _ in found:
                        with system.open_input_stream(name) as part:
                            while data := part.read(1 << 24):
                                whole.write(data)
            yield batch
    spark.range(1, numPartitions=1).mapInArrow(copied, "id bigint").collect()


# Sources -------------------------------------------------------------------------------------

@query
def scan_files(spark, sf):
    return files.scan_files(spark, sf, "*.parquet").select("file_name", "mime", "length")


@query
def admit_mime(spark, sf):
    k = F.col("o_orderkey")
    kinds = F.array(*[F.lit(x) for x in ("jpg", "JPEG", "png", "webp", "pdf", "txt")])
    name = F.concat(F.lit("bill_"), k, F.lit("."), F.get(kinds, (k % 6).cast("int")))
    listed = X.table(spark, sf, "orders").select(name.alias("file_name"))
    admitted = files.admit_images(listed.withColumn("mime", files.mime_type(F.col("file_name"))))
    return admitted.select("file_name", "mime", "error")


@query
def scan_ground_truth(spark, sf):
    path = fresh_dir(spark, "truth")
    truth = X.truth(spark, sf)
    body = F.to_json(F.struct(*[F.col(f) for f in FIELDS]))
    truth.select(F.concat(F.lit('{"'), "file", F.lit('":'), body, F.lit("}"))).write.text(path)
    return payloads.scan_ground_truth(spark, path, whole_file=False)


@query
def scan_ground_truth_object(spark, sf):
    """All truth as one object of one file, each seventh amount as text, each eleventh record broken."""
    path, k = fresh_dir(spark, "truth"), F.regexp_extract("file", r"(\d+)", 1).cast("bigint")
    fields = [F.when(k % 7 == 0, F.concat(F.col(f).cast("string"), F.lit(" INR"))).otherwise(
        F.col(f).cast("string")).alias(f) if f == "tax_amount" else F.col(f) for f in FIELDS]
    body = F.to_json(F.struct(*fields))
    body = F.when(k % 11 == 0, F.regexp_replace(body, '^.', "{oops ")).otherwise(body)
    lines = X.truth(spark, sf).select(k.alias("k"), F.concat(F.lit('"'), "file", F.lit('": '), body,
                                                             F.lit(",")).alias("value"))
    ends = spark.createDataFrame([(-1, "{"), (1 << 60, '"last": {}}')], "k bigint, value string")
    _one_file(spark, lines.unionByName(ends).orderBy("k").select("value"), path)
    truth = payloads.read_truth(spark, path, split_bytes=1 << 16)
    return truth.where("file <> 'last'").select(
        "file", "vendor_name", "tax_amount", F.col("error").isNotNull().alias("broken"))


@query
def parse_payload(spark, sf):
    parsed = payloads.parse_payloads(X.documents(spark, sf, items=False))
    return parsed.select("file_name", "error_type", V.as_text(
        V.member(F.col("doc"), "$.invoice_number")).alias("invoice_number"))


@query
def unwrap_envelope(spark, sf):
    pages = X.table(spark, sf, "documents")
    quoted = F.to_json(F.struct(F.col("text").alias("t")))
    text = F.expr("substring(q, 6, length(q) - 6)")
    first = F.concat(F.lit('{"candidates":[{"content":{"parts":[{"text":'), text, F.lit("}]}}]}"))
    second = F.concat(F.lit('{"choices":[{"message":{"content":'), text, F.lit("}}]}"))
    k = F.col("doc_id")
    body = F.when(k % 3 == 0, first).when(k % 3 == 1, second).otherwise('{"error":"quota"}')
    return (pages.withColumn("q", quoted).select("doc_id", body.alias("body"))
            .select("doc_id", F.md5(payloads.unwrap_envelope(F.col("body")).cast("binary"))
                    .alias("payload_md5")))


def _data_urls(spark, sf) -> DataFrame:
    url = files.encode_data_url(F.lit("image/png"), F.encode("text", "UTF-8"))
    return X.table(spark, sf, "documents").select("doc_id", url.alias("url"))


@query
def data_url_encode(spark, sf):
    return _data_urls(spark, sf)


@query
def data_url_decode(spark, sf):
    url = F.col("url")
    return _data_urls(spark, sf).select(
        "doc_id", files.data_url_mime(url).alias("mime"),
        F.md5(F.unbase64(files.data_url_base64(url))).alias("content_md5"),
        (files.rebuild_data_url(url) == url).alias("rebuilt"))


@query
def extract_with_retry(spark, sf):
    tried: dict = {}

    def extractor(file: str) -> dict:
        k = int(file[len("bill_"):-len(".jpg")])
        tried[file] = tried.get(file, 0) + 1
        if k % 10 == 9:
            raise ValueError("unreadable image")
        if tried[file] <= k % 5:
            raise extract.TransientExtractorError("busy")
        return {"k": k}

    listed = X.bills(spark, sf).select(F.col("file").alias("file_name"))
    return extract.extract_with_retry(listed, extractor, partitions=16, pause=None)


@query
def model_fanout(spark, sf):
    def extractor(file: str, model: str) -> dict:
        k = int(file[len("bill_"):-len(".jpg")])
        if model == "m_b" and k % 37 == 1:
            raise ValueError("model failed")
        return {"model": model, "k": k}

    listed = X.bills(spark, sf).select(F.col("file").alias("file_name"))
    return extract.model_fanout(listed, MODELS, extractor, partitions=16, pause=None).select(
        "file_name", "model", "raw", "error_message")


@query
def extract_resumed(spark, sf):
    """A run over every second bill, then one over all: stored answers are not asked for again."""
    def extractor(file: str) -> dict:
        return {"k": int(file[len("bill_"):-len(".jpg")])}

    listed = X.bills(spark, sf).select("k", F.col("file").alias("file_name"))
    root = fresh_dir(spark, "ledger")
    first = ledger.extract_through_ledger(listed.where("k % 2 = 0"), extractor, root, partitions=16)
    written(first, "first-run")
    return ledger.extract_through_ledger(listed, extractor, root, partitions=16).select(
        "file_name", "raw", "attempts", "from_ledger", "error_message")


# Validation and projections ------------------------------------------------------------------

def _parsed(spark, sf, items) -> DataFrame:
    return val.read_document(computed_once(
        X.documents(spark, sf, items), doc=V.parse_json(F.col("raw"))), "doc")


@query
def validate_header(spark, sf):
    told = val.error_message(val.header_errors())
    return _parsed(spark, sf, False).select("file_name", F.when(
        F.col("doc").isNull(), "json").otherwise(told).alias("problems"))


@query
def validate_line_items(spark, sf):
    told = val.error_message(val.line_item_errors())
    return _parsed(spark, sf, True).select("file_name", F.when(
        F.col("doc").isNull(), "json").otherwise(told).alias("problems"))


@query
def apply_defaults(spark, sf):
    k = F.col("k")
    item = F.concat(F.lit('{"product_desc":"x"'), F.when(k % 3 == 0, "").otherwise(
        F.concat(F.lit(',"quantity":'), (k % 7 + 1).cast("string"))), F.lit("}"))
    items = F.when(k % 2 == 0, "").otherwise(
        F.concat(F.lit(',"line_items":['), item, F.lit("]")))
    raw = F.concat(F.lit('{"vendor_name":"V","total_amount":'), F.col("total_amount"), items,
                   F.lit("}"))
    parsed = computed_once(X.bills(spark, sf), doc=V.parse_json(raw))
    typed = val.read_document(parsed, "doc").select(
        "k", val.typed_invoice().alias("i"))
    return typed.select(
        "k", F.size("i.line_items").alias("n_items"),
        F.coalesce(F.get("i.line_items", 0)["quantity"], F.lit(0.0)).alias("quantity"),
        F.col("i.tax_amount").isNull().alias("tax_is_null"))


@query
def route_valid_dlq(spark, sf):
    checked = val.validate(X.documents(spark, sf))
    return checked.select("file_name", F.when(F.col("error_type").isNull(), "load").otherwise(
        "dlq").alias("route"), F.coalesce("error_type", F.lit("none")).alias("error_type"))


@query
def check_load_constraints(spark, sf):
    k = F.col("k")
    invoice = F.struct(
        F.when(k % 31 == 2, F.repeat("vendor_name", 40)).otherwise(F.col("vendor_name"))
        .alias("vendor_name"),
        F.when(k % 29 == 3, F.repeat("invoice_number", 40)).otherwise(F.col("invoice_number"))
        .alias("invoice_number"),
        F.when(k % 19 == 6, X.BAD_DATE).otherwise(F.col("date")).alias("invoice_date"),
        F.when(k % 23 == 1, F.lit(1e16)).otherwise(F.col("total_amount")).alias("total_amount"),
        "tax_amount",
        F.array(F.struct(F.lit("x").alias("product_desc"),
                         F.when(k % 17 == 5, F.lit(1e9)).otherwise(1.0).alias("quantity"),
                         F.lit(None).cast("double").alias("unit_price"),
                         F.col("total_amount").alias("total_price"))).alias("line_items"))
    typed = X.bills(spark, sf).select("k", invoice.alias("i"))
    return typed.select("k", val.error_message(val.load_errors("i")).alias("problems"))


@query
def evaluation_gate(spark, sf):
    return _scored(spark, sf).select(
        "file", "model", F.col("evaluation").isNotNull().alias("evaluated"))


@query
def resolve_nested(spark, sf):
    k = F.col("k")
    inner = F.concat(F.lit('{"n":'), k.cast("string"), F.lit("}"))
    body = F.concat(
        F.when(k % 6 == 0, F.concat(F.lit('{"m_a":{"extracted":'), inner, F.lit("}}")))
        .when(k % 6 == 1, F.concat(F.lit('{"data":{"m_a":'), inner, F.lit("}}")))
        .when(k % 6 == 2, F.concat(F.lit('{"results":{"m_a":'), inner, F.lit("}}")))
        .when(k % 6 == 3, F.concat(F.lit('{"m_a":null,"extracted":'), inner, F.lit("}")))
        .when(k % 6 == 4, F.concat(F.lit('{"m_a":"","data":{"m_a":{"extracted":'), inner,
                                   F.lit("}}}")))
        .otherwise(inner))
    record = payloads.resolve_provider(V.parse_json(body), "m_a")
    found = X.bills(spark, sf).select("k", payloads.resolve_extracted(record).alias("r"))
    return found.select("k", F.try_variant_get("r", "$.n", "bigint").alias("n"))


@query
def falsy_default(spark, sf):
    k = F.col("k")
    name = F.when(k % 3 == 0, "").when(k % 3 == 1, F.col("vendor_name"))
    amount = F.when(k % 4 == 0, 0.0).when(k % 4 == 1, F.col("total_amount")).when(
        k % 4 == 2, F.lit(float("nan")))
    return X.bills(spark, sf).select(
        "k", T.falsy_default(name, "Unknown").alias("vendor_name"),
        T.falsy_default_number(amount, F.lit(-1.0)).alias("amount"))


def _expense_bills(spark, sf) -> DataFrame:
    """Bill records with the shapes the mapping must survive."""
    k = F.col("k")
    total = F.when(k % 5 == 0, F.col("total_amount").cast("string")).when(
        k % 5 == 1, F.concat(F.lit('" '), F.col("total_amount"), F.lit(' "'))).when(
        k % 5 == 2, '"1,500"').when(k % 5 == 3, '""').otherwise("null")
    date = F.when(k % 3 == 0, F.col("date")).when(k % 3 == 1, "25/10/2023").otherwise("null")
    raw = F.concat(
        F.lit('{"vendor_name":'), F.when(k % 4 == 0, '""').otherwise(
            F.concat(F.lit('"'), "vendor_name", F.lit('"'))),
        F.when(k % 4 == 1, "").otherwise(
            F.concat(F.lit(',"invoice_number":"'), "invoice_number", F.lit('"'))),
        F.lit(',"date":"'), date, F.lit('","total_amount":'), total,
        F.when(k % 4 == 2, ',"gstin":"null"').when(k % 4 == 3, ',"gstin":null').otherwise(""),
        F.lit("}"))
    return X.bills(spark, sf).select("k", V.parse_json(raw).alias("record"))


@query
def expense_mapping(spark, sf):
    return expense.expense_mapping(_expense_bills(spark, sf), "record", "ACC-1",
                                   F.lit("2024-01-31").cast("date"))


@query
def expense_mapping_strict(spark, sf):
    rows = X.bills(spark, sf).withColumn("gstin", X.gstin_of(F.col("k")))
    record = V.parse_json(F.to_json(F.struct(*[F.col(f) for f in FIELDS])))
    return expense.expense_mapping(rows.select("k", record.alias("record")), "record", "ACC-1",
                                   fallbacks=False)


@query
def export_expenses(spark, sf):
    return expense.export_expenses(expense_mapping(spark, sf))


@query
def sync_ledger(spark, sf):
    k = F.col("k")
    body = F.when(k % 6 == 0, F.concat(
        F.lit('{"code":0,"expense":{"expense_id":"E'), k, F.lit('"}}'))).when(
        k % 6 == 1, '{"code":0,"expense":{"expense_id":""}}').when(
        k % 6 == 2, '{"code":0}').when(
        k % 6 == 3, F.concat(F.lit('{"code":'), k, F.lit(',"message":"limit"}'))).when(
        k % 6 == 4, '{"code":5,"message":""}').otherwise("<html>")
    answers = X.bills(spark, sf).select("k", body.alias("body"))
    return expense.sync_ledger(answers)


@query
def unnest_line_items(spark, sf):
    rows = X.order_items(spark, sf)
    return val.unnest_line_items(rows, "items")


@query
def field_unpivot(spark, sf):
    rows = X.truth(spark, sf).withColumn("total_amount", N.py_float_text(F.col("total_amount"))
                                         ).withColumn("tax_amount", N.py_float_text(
                                             F.col("tax_amount")))
    return E.field_unpivot(rows, ["file"])


# Loading -------------------------------------------------------------------------------------

@query
def invoice_fingerprint(spark, sf):
    return X.bills(spark, sf).select("k", T.invoice_fingerprint(
        F.col("vendor_name"), F.when(F.col("k") % 3 != 0, F.col("date")), F.col("total_amount"))
        .alias("invoice_hash"))


@query
def collapse_batch(spark, sf):
    both = _rows(spark, sf).unionByName(_rows(spark, sf, changed=True)).drop("line_items")
    return _shown(load.collapse_batch(both))


@query
def upsert_vendors(spark, sf):
    none = _empty(spark, "vendor_id bigint, vendor_name string, tax_id string")
    first = load.upsert_vendors(none, _rows(spark, sf, strict=True))
    return load.upsert_vendors(first, _rows(spark, sf, changed=True)).select(
        "vendor_id", "vendor_name")


@query
def upsert_invoices(spark, sf):
    after = load.upsert_invoices(_current_invoices(spark, sf), _changed_batch(spark, sf))
    return _shown(after, "invoice_id")


@query
def load_line_items(spark, sf):
    both = _rows(spark, sf, True).unionByName(_rows(spark, sf, True, changed=True))
    items = load.line_item_rows(both, "replace")
    return items.select("invoice_hash", "position", "product_desc",
                        F.col("quantity").cast("double").alias("quantity"),
                        F.col("total_price").cast("double").alias("total_price"))


@query
def load_line_items_append(spark, sf):
    both = _rows(spark, sf, True).unionByName(_rows(spark, sf, True, changed=True))
    return load.line_item_rows(both, "append").groupBy("invoice_hash", "position").agg(
        F.count(F.lit(1)).alias("n_rows"))


@query
def dlq(spark, sf):
    return val.dlq_rows(val.validate(X.documents(spark, sf))).select(
        "file_name", "error_type", "error_message",
        F.col("raw_payload").startswith('{"raw":"').alias("has_payload"))


@query
def dlq_compat(spark, sf):
    return val.dlq_compat(val.dlq_rows(val.validate(X.documents(spark, sf)))).select(
        "file_name", "error_type", F.col("raw_payload").isNull().alias("no_payload"))


@query
def atomic_document_load(spark, sf):
    store = StagingStore(spark, fresh_dir(spark, "store")).create()
    docs = X.documents(spark, sf)
    store.load(docs, 0)
    return load_summary(store, docs)


@query
def lookup_vendor_id(spark, sf):
    rows = _rows(spark, sf).select("invoice_number", "vendor_name", "seq")
    return load.lookup_vendor_id(rows, _vendors(spark, sf)).select("invoice_number", "vendor_id")


@query
def lookup_invoice_id(spark, sf):
    invoices = number_rows(load.collapse_batch(_rows(spark, sf).drop("line_items")), "seq",
                           "invoice_hash", "invoice_id")
    items = load.line_item_rows(_rows(spark, sf, True))
    return load.lookup_invoice_id(items, invoices).select("invoice_id", "position",
                                                          "product_desc")


@query
def upsert_match(spark, sf):
    return load.upsert_plan(_current_invoices(spark, sf), _changed_batch(spark, sf),
                            "invoice_hash")


@query
def insert_only_new_rows(spark, sf):
    return insert_only_new(_changed_batch(spark, sf), _current_invoices(spark, sf),
                           ["invoice_hash"]).select("invoice_hash", "invoice_number")


QUERIES["insert_only_new"] = QUERIES.pop("insert_only_new_rows")


@query
def cascade_delete(spark, sf):
    rows = _rows(spark, sf, True)
    vendors = _vendors(spark, sf)
    invoices = number_rows(load.lookup_vendor_id(
        load.collapse_batch(rows.drop("line_items")), vendors),
        "seq", "invoice_hash", "invoice_id")
    items = load.lookup_invoice_id(load.line_item_rows(rows), invoices)
    doomed = vendors.where(F.col("vendor_name").endswith("7"))
    left = load.cascade_delete(vendors, invoices, items, doomed)
    counted = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"),
                                                               "n_rows")
               for name, df in zip(("vendors", "invoices", "line_items"), left)]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


@query
def distinct_vendors(spark, sf):
    return load.distinct_vendors(_rows(spark, sf)).select("vendor_name",
                                                          F.col("seq").alias("first_seq"))


@query
def vendor_date_rollup(spark, sf):
    invoices = load.lookup_vendor_id(
        load.collapse_batch(_rows(spark, sf).drop("line_items")), _vendors(spark, sf))
    return load.vendor_date_rollup(invoices).select(
        "vendor_id", F.date_format("invoice_date", "yyyy-MM-dd").alias("invoice_date"),
        "n_invoices", F.col("total_amount").cast("double").alias("total_amount"),
        F.col("tax_amount").cast("double").alias("tax_amount"))


@query
def assign_surrogates(spark, sf):
    return number_rows(X.table(spark, sf, "orders").select("o_orderkey", "o_totalprice"),
                       "o_totalprice", "o_orderkey", "id", after=1000)


@query
def dlq_partition(spark, sf):
    docs = X.documents(spark, sf)
    checked = val.validate(docs)
    return integrity.partition_check(docs, val.accepted(checked), val.rejected(checked),
                                     "file_name")


# Integrity -----------------------------------------------------------------------------------

@query
def audit_not_null(spark, sf):
    typed = _parsed(spark, sf, False).select(
        val.typed_invoice().alias("i"))
    return integrity.audit_not_null(typed.select("i.*"), ["vendor_name", "total_amount",
                                                          "invoice_number"])


@query
def audit_unique(spark, sf):
    both = _rows(spark, sf).unionByName(_rows(spark, sf, changed=True, strict=True))
    return integrity.audit_unique(both, "invoice_hash")


@query
def audit_foreign_keys(spark, sf):
    """Items and invoices of a lenient load against the invoices and vendors of a strict one."""
    rows, strict = _rows(spark, sf, True), _rows(spark, sf, strict=True)
    none = _empty(spark, "vendor_id bigint, vendor_name string, tax_id string")
    return integrity.audit_schema_keys(
        load.line_item_rows(rows), load.collapse_batch(rows.drop("line_items")),
        load.collapse_batch(strict.drop("line_items")), load.upsert_vendors(none, strict))


@query
def audit_idempotent_replay(spark, sf):
    store = StagingStore(spark, fresh_dir(spark, "store")).create()
    store.load(X.documents(spark, sf), 0)

    def counts(column: str) -> DataFrame:
        parts = [df.agg(F.count(F.lit(1)).alias(column)).select(F.lit(n).alias("table_name"),
                                                               column)
                 for n, df in (("vendors", store.vendors()), ("invoices", store.invoices()),
                               ("line_items", store.line_items()))]
        return parts[0].unionByName(parts[1]).unionByName(parts[2])

    before = counts("n_before")
    store.load(X.documents(spark, sf, changed=True), 1)
    return before.join(counts("n_after"), "table_name")


# Scalar functions ----------------------------------------------------------------------------

@query
def normalize_vendor(spark, sf):
    return X.name_pairs(spark, sf).select(
        "k", T.normalize_vendor(F.col("extracted")).alias("norm"),
        T.normalize_vendor(F.concat(F.col("truth"), F.lit(" & Co., Store"))).alias("code"),
        T.normalize_vendor(F.concat(F.col("truth"), F.lit(" & Co., Store")), "spec")
        .alias("spec"))


@query
def double_metaphone_codes(spark, sf):
    names = X.table(spark, sf, "part").select(F.col("p_name").alias("name")).distinct()
    return names.withColumn("dm", P.double_metaphone(F.col("name"))).select("name", "dm.*")


QUERIES["double_metaphone"] = QUERIES.pop("double_metaphone_codes")


@query
def phonetic_match(spark, sf):
    pairs = X.name_pairs(spark, sf).where(F.col("extracted").isNotNull())
    heard = pairs.withColumn("heard_alike", P.phonetic_match(F.col("extracted"), F.col("truth")))
    return heard.select("k", "heard_alike")


@query
def jaro_winkler_similarity(spark, sf):
    pairs = X.name_pairs(spark, sf).where(F.col("extracted").isNotNull())
    return pairs.select("k", F.round(jaro_winkler(F.col("extracted"), F.col("truth")), 6)
                        .alias("similarity"))


QUERIES["jaro_winkler"] = QUERIES.pop("jaro_winkler_similarity")


def _vendor_match(spark, sf, **options) -> DataFrame:
    matched = match_vendors(X.name_pairs(spark, sf), F.col("extracted"), F.col("truth"), **options)
    return matched.select("k", *_result("vendor_match"))


@query
def match_vendor(spark, sf):
    return _vendor_match(spark, sf, phonetic=False)


@query
def match_vendor_phonetic(spark, sf):
    return _vendor_match(spark, sf)


@query
def spec_vendor_match(spark, sf):
    return _vendor_match(spark, sf, phonetic=False, profile="spec")


@query
def match_float(spark, sf):
    return X.field_pairs(spark, sf).withColumn(
        "m", M.match_float(F.col("amount"), F.col("amount_truth"))).select("k", *_result("m"))


@query
def match_date(spark, sf):
    return X.field_pairs(spark, sf).withColumn(
        "m", M.match_date(F.col("date"), F.col("date_truth"))).select("k", *_result("m"))


@query
def match_gstin(spark, sf):
    return X.field_pairs(spark, sf).withColumn(
        "m", M.match_gstin(F.col("gstin"), F.col("gstin_truth"))).select("k", *_result("m"))


@query
def match_invoice_number(spark, sf):
    k, number = F.col("k"), F.col("invoice_number")
    given = F.when(k % 4 == 0, number).when(k % 4 == 1, F.lower(number)).when(
        k % 4 == 2, F.concat(number, F.lit(" ")))
    truth = F.when(k % 8 != 7, number)
    return X.bills(spark, sf).withColumn("m", M.match_invoice_number(given, truth)).select(
        "k", F.col("m.is_match"), F.col("m.details"))


@query
def match_field_lenient(spark, sf):
    e = X.field_pairs(spark, sf)
    amount_truth = F.when(F.col("k") % 7 != 0, F.format_string("%.2f", "amount_truth"))
    return e.select(
        "k", M.match_field_lenient(F.col("amount"), amount_truth, "total_amount").alias("amount"),
        M.match_field_lenient(F.col("date"), F.col("date_truth"), "date").alias("date"),
        M.match_field_lenient(F.col("gstin"), F.concat(F.lit("GST "), "gstin_truth"), "gstin")
        .alias("gstin"))


@query
def evaluate_extraction(spark, sf):
    scored = _scored(spark, sf).where(F.col("evaluation").isNotNull())
    fields = [F.col(f"evaluation.field_breakdown.{f}.is_match").alias(f) for f in FIELDS]
    return scored.select("file", "model", "evaluation.accuracy_score",
                         F.col("evaluation.passed").alias("passed"), *fields)


@query
def field_correct(spark, sf):
    scored = _scored(spark, sf)
    flags = E.correct_flags(scored, "strict")
    return scored.select("file", "model", *[flag.alias(f) for f, flag in flags.items()])


def _floats(spark, sf) -> DataFrame:
    k, total = F.col("k"), F.col("total_amount")
    value = (F.when(k % 6 == 0, total).when(k % 6 == 1, F.floor(total).cast("double"))
             .when(k % 6 == 2, total * 1000).when(k % 6 == 3, k / F.lit(1e6))
             .when(k % 6 == 4, F.floor(total) * 1e12).otherwise(-total))
    return X.bills(spark, sf).select("k", value.alias("value"))


@query
def py_float_text(spark, sf):
    return _floats(spark, sf).select("k", N.py_float_text(F.round("value", 6)).alias("shown"))


@query
def js_number_text(spark, sf):
    return _floats(spark, sf).select("k", N.js_number_text(F.floor("value").cast("double"))
                                     .alias("shown"))


@query
def date_or_today(spark, sf):
    return X.field_pairs(spark, sf).select("k", T.date_or_today(
        F.col("date"), F.lit("2024-01-31").cast("date")).alias("date"))


@query
def number_or_zero(spark, sf):
    return X.field_pairs(spark, sf).select(
        "k", N.number_or_zero(F.col("amount")).alias("amount"))


# Evaluation reports --------------------------------------------------------------------------

@query
def union_models(spark, sf):
    return E.union_models(X.model_outputs(spark, sf)).select(
        "file", "model", F.col("error").isNotNull().alias("failed"))


@query
def join_ground_truth(spark, sf):
    return _joined(spark, sf).select("file", "model", F.col("truth").isNotNull().alias("known"),
                                     F.col("truth.total_amount").alias("truth_total"))


@query
def result_grid(spark, sf):
    grid = E.result_grid(_attempts(spark, sf), MODELS)
    return grid.groupBy("model", "field").agg(
        F.count(F.lit(1)).alias("n_cells"),
        F.count_if(F.col("extracted").isNull()).alias("n_without_extraction"))


@query
def pairwise_compare(spark, sf):
    joined = _joined(spark, sf)
    flags = E.correct_flags(joined)
    return joined.select("file", "model", *[flag.alias(f) for f, flag in flags.items()])


@query
def field_metrics(spark, sf):
    return _metrics(spark, sf)


@query
def field_metrics_strict(spark, sf):
    return E.field_metrics(_scored(spark, sf), MODELS, "strict")


@query
def field_accuracy_pct(spark, sf):
    return E.field_accuracy(_metrics(spark, sf))


@query
def document_score(spark, sf):
    scored = _scored(spark, sf).where(F.col("evaluation").isNotNull())
    return scored.groupBy("model", F.col("evaluation.accuracy_score").alias("accuracy_score")
                          ).agg(F.count(F.lit(1)).alias("n_bills"))


@query
def accuracy_matrix(spark, sf):
    return E.accuracy_matrix(_metrics(spark, sf), MODELS)


@query
def progress(spark, sf):
    return E.progress(_attempts(spark, sf), X.truth(spark, sf))


@query
def progress_observed(spark, sf):
    """What a stream reports batch by batch while it runs, added up."""
    rows = E.union_models(X.model_outputs(spark, sf))
    path = _stored(spark, rows, "arriving", F.col("k") % 5)
    stream = ingest.document_stream(spark, path, rows.schema, files_per_batch=1)
    seen, _ = E.observed_progress(E.parse_attempts(stream))
    running = ingest.run_to_table(seen, fresh_dir(spark, "seen"), fresh_dir(spark, "checkpoint"))
    running.awaitTermination()
    told = ingest.observed_batches(running, "progress")
    reports = spark.createDataFrame(told, "batch_id bigint, n_attempts bigint, n_failed bigint,"
                                          " last_bill bigint")
    return reports.agg(F.count(F.lit(1)).alias("n_batches"), F.sum("n_attempts").alias("n_attempts"),
                       F.sum("n_failed").alias("n_failed"), F.max("last_bill").alias("last_bill"))


@query
def model_cost(spark, sf):
    return E.model_cost(_attempts(spark, sf), MODEL_COST_PER_100)


@query
def rank_models(spark, sf):
    ranked = E.rank_models(_metrics(spark, sf), MODEL_COST_PER_100)
    return ranked.withColumn("mean_accuracy", F.round("mean_accuracy", 6))


@query
def top_model(spark, sf):
    return E.top_model(_metrics(spark, sf), MODEL_COST_PER_100).select("model", "place")


@query
def status_band(spark, sf):
    e = F.col("evaluation")
    return _scored(spark, sf).select(
        "file", "model", M.status_band(e["accuracy_pct"]).alias("band"),
        M.run_band(F.col("error").isNotNull(), e["passed"]).alias("run"),
        M.run_label(F.col("error").isNotNull(), e["passed"], e["accuracy_score"])
        .alias("label"))


@query
def field_difficulty(spark, sf):
    return _metrics(spark, sf).select(
        "model", "field", M.field_difficulty(F.col("field")).alias("difficulty"))


@query
def results_in_bill_order(spark, sf):
    ordered = E.results_in_bill_order(_attempts(spark, sf).select("file", "model"))
    return ordered.select("file", "model", "bill_seq")


def _answers(spark, sf) -> DataFrame:
    """Model outputs as their providers send them: in one of the two envelopes, or bare."""
    rows = E.union_models(X.model_outputs(spark, sf))
    said = F.struct(F.struct(F.col("payload").alias("content")).alias("message"))
    parts = F.struct(F.struct(F.array(F.struct(F.col("payload").alias("text"))).alias("parts")).alias("content"))
    raw = F.when(F.col("payload").isNull(), F.lit(None)).when(
        F.col("model") == "m_a", F.to_json(F.struct(F.array(said).alias("choices")))).when(
        F.col("model") == "m_b", F.to_json(F.struct(F.array(parts).alias("candidates")))).otherwise(F.col("payload"))
    return rows.select("file", "model", "error", raw.alias("raw"))


def _run(spark, sf) -> DataFrame:
    return evaluate_run(_answers(spark, sf), X.truth(spark, sf), MODELS, X.bills(spark, sf), phonetic=False)


@query
def evaluate_run_log(spark, sf):
    """The evaluation flow from provider answers to a line for each bill and model, silent models included."""
    return run_log(_run(spark, sf))


QUERIES["evaluate_run"] = QUERIES.pop("evaluate_run_log")


@query
def evaluation_document(spark, sf):
    return E.evaluation_documents(_run(spark, sf), MODELS)


@query
def evaluation_document_read(spark, sf):
    """The nested documents read back: what each says of each model."""
    documents = E.evaluation_documents(_run(spark, sf), MODELS)
    told = documents.select("file", F.explode(F.array(*[
        F.struct(F.lit(m).alias("model"), *[F.get_json_object("document", f"$.{m}.{path}").alias(name)
                                            for name, path in (("error", "extracted.error"),
                                                               ("invoice_number", "extracted.invoice_number"),
                                                               ("passed", "evaluation.passed"),
                                                               ("accuracy_score", "evaluation.accuracy_score"))])
        for m in MODELS])).alias("one"))
    return told.select("file", "one.*").withColumn("passed", F.col("passed").cast("int"))


# Vendor resolution ---------------------------------------------------------------------------

def _resolution(spark, sf, phonetic: bool) -> DataFrame:
    pairs = X.name_pairs(spark, sf)
    found = resolve_vendors(pairs, "extracted", X.table(spark, sf, "part"), "p_name", phonetic)
    return found.select("name", "vendor_name", "arm", F.round("score", 6).alias("score"))


@query
def vendor_resolution(spark, sf):
    return _resolution(spark, sf, False)


@query
def vendor_resolution_phonetic(spark, sf):
    return _resolution(spark, sf, True)


@query
def vendor_resolution_customers(spark, sf):
    """Near-equal numbered names: every name resembles every other one."""
    left = X.table(spark, sf, "customer").select(F.lower("c_name").alias("name"))
    right = X.table(spark, sf, "supplier").select(
        F.regexp_replace("s_name", "Supplier#0", "Customer#").alias("s_name"))
    return resolve_vendors(left, "name", right, "s_name", phonetic=False).select(
        "name", "vendor_name", "arm", F.round("score", 6).alias("score"))


# Streaming -----------------------------------------------------------------------------------

DOCUMENT = "k bigint, file_name string, seq bigint, raw string"


@query
def stream_ingest_upsert(spark, sf):
    path = _stored(spark, X.documents(spark, sf), "arriving", F.col("k") % 5)
    store = StagingStore(spark, fresh_dir(spark, "store")).create()
    stream = ingest.document_stream(spark, path, DOCUMENT, files_per_batch=2)
    ingest.stream_ingest(stream, store, fresh_dir(spark, "checkpoint")).awaitTermination()
    items = store.line_items().groupBy("invoice_id").agg(F.count(F.lit(1)).alias("n"))
    named = store.invoices().join(store.vendors(), "vendor_id").join(items, "invoice_id", "left")
    return _shown(named.withColumn("n_items", F.coalesce("n", F.lit(0))), "n_items")


@query
def stream_ingest_stateful(spark, sf):
    """Two starts of one stream; the second goes on with the state of the first."""
    path = _stored(spark, X.documents(spark, sf), "arriving", F.col("k") % 5)
    store = state.StatefulIngest(spark, fresh_dir(spark, "stateful"))
    checkpoint = fresh_dir(spark, "checkpoint")
    again = X.documents(spark, sf, changed=True).where("k % 5 = 0")
    for arriving in (None, again):
        if arriving is not None:
            arriving.coalesce(1).write.mode("append").parquet(path)
        stream = ingest.document_stream(spark, path, DOCUMENT, files_per_batch=2)
        store.start(stream, checkpoint).awaitTermination()
    items = store.line_items().groupBy("invoice_id").agg(F.count(F.lit(1)).alias("n_items"))
    named = store.invoices().join(store.vendors(), "vendor_name").join(items, "invoice_id", "left")
    return _shown(named.withColumn("n_items", F.coalesce("n_items", F.lit(0))), "n_items")


def _arrivals(spark, sf) -> str:
    """Fingerprints with their time of arrival, in six files: part p arrives on day p and again on day p + 1; with
    the last file come some that were on their way since long before."""
    first = F.lit("2024-05-01 00:00:00").cast("timestamp")
    rows = written(_rows(spark, sf).select(
        "invoice_hash", F.substring_index("invoice_number", "-", -1).cast("bigint").alias("k")),
        "arrivals")
    path = fresh_dir(spark, "arriving")
    for day in range(6):
        parts = rows.where(F.col("k") % 5 == day).unionByName(rows.where(F.col("k") % 5 == day - 1))
        stamped = parts.withColumn("arrived", first + F.make_interval(days=F.lit(day)))
        if day == 5:
            lost = first - F.make_interval(days=F.lit(10))
            stamped = stamped.unionByName(rows.where("k % 10 = 1").withColumn("arrived", lost))
        stamped.drop("k").coalesce(1).write.mode("append").parquet(path)
    return path


@query
def stream_dedup(spark, sf):
    stream = ingest.document_stream(spark, _arrivals(spark, sf),
                                    "invoice_hash string, arrived timestamp", files_per_batch=1)
    out = fresh_dir(spark, "deduped")
    told = state.stream_deliveries(stream, "arrived", "1 day", live_days=3)
    ingest.run_to_table(told, out, fresh_dir(spark, "checkpoint")).awaitTermination()
    return spark.read.schema(told.schema).parquet(out).select(
        "invoice_hash", "outcome", F.date_format("arrived", "yyyy-MM-dd").alias("arrived"),
        F.col("reason").isNotNull().alias("has_reason"))


def _reattempted(spark, sf) -> DataFrame:
    """All attempts, and for a third of the bills an earlier, perfect one of every model."""
    outputs = X.model_outputs(spark, sf)
    last = E.union_models(outputs).withColumn("attempt", F.lit(2))
    better = outputs["m_a"].where("k % 3 = 0")
    early = E.union_models({"m_a": better, "m_b": better, "m_c": better.where("k % 41 <> 2")})
    return last.unionByName(early.withColumn("attempt", F.lit(1)))


@query
def field_metrics_reattempted(spark, sf):
    joined = E.join_ground_truth(E.parse_attempts(_reattempted(spark, sf)), X.truth(spark, sf))
    return E.field_metrics(joined, MODELS)


@query
def stream_field_metrics(spark, sf):
    rows = _reattempted(spark, sf)
    path = _stored(spark, rows, "arriving", (F.col("k") + F.col("attempt")) % 5)
    stream = ingest.document_stream(spark, path, rows.schema, files_per_batch=2)
    joined = E.join_ground_truth(E.parse_attempts(stream), X.truth(spark, sf))
    changes = state.stream_metric_changes(joined)
    out = fresh_dir(spark, "changes")
    ingest.run_to_table(changes, out, fresh_dir(spark, "checkpoint")).awaitTermination()
    return state.metrics_from_changes(spark.read.schema(changes.schema).parquet(out))


@query
def stream_rate_limit(spark, sf):
    path = _stored(spark, X.bills(spark, sf).select("k", "file"), "arriving", F.col("k") % 5)
    stream = ingest.document_stream(spark, path, "k bigint, file string", files_per_batch=1)
    out = fresh_dir(spark, "paced")
    counted = stream.agg(F.count(F.lit(1)).alias("n_bills"))
    ingest.run_to_table(counted, out, fresh_dir(spark, "checkpoint"),
                        "complete").awaitTermination()
    return spark.read.parquet(out).select(F.col("batch_id").cast("bigint"), "n_bills")


@query
def stream_token_bucket(spark, sf):
    """All requests of each model, let through in bursts of a fifth; never more than the pace allows."""
    requests = E.union_models(X.model_outputs(spark, sf)).select("model", F.col("file").alias(
        "request"))
    n, burst = requests.count(), max(1, X.bills(spark, sf).count() // 5)
    pace = 2.0 / burst  # a fifth each two seconds
    path = _stored(spark, requests, "arriving")
    stream = ingest.document_stream(spark, path, "model string, request string")
    paced = state.stream_paced(stream, pace, burst)
    out = fresh_dir(spark, "released")
    running = ingest.run_to_table(paced, out, fresh_dir(spark, "checkpoint"), pace="0 seconds")
    table = ingest.wait_for_rows(running, out, paced.schema, n)
    seconds = (F.max("released_ms") - F.min("released_ms")) / 1000
    return table.groupBy("model").agg(
        F.count(F.lit(1)).alias("n_released"), F.count_distinct("request").alias("n_requests"),
        (F.count(F.lit(1)) <= burst + seconds / pace + 1).alias("within_pace"))
