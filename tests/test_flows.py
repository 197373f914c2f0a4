"""Loading, streaming, resolution and plans on small inputs."""

import json
import os
import random
import subprocess
import sys

import duckdb
import pytest
from pyspark.sql import functions as F

from billflow.functions.similarity import jaro_winkler
from billflow.functions.text import normalize_vendor
from billflow.operators import evaluate as E, load, validate as val
from billflow.operators.lookup import keyed_lookup, number_rows
from billflow.operators.resolve import RUNGS, met_pairs, resolve_vendors, similar_pairs, with_tokens
from billflow.plans.etl import routing_summary, run_pipeline
from billflow.plans.store import StagingStore
from billflow.sources.files import admit_images, scan_files
from billflow.sources.payloads import scan_ground_truth
from billflow.streaming import ingest

GOOD = {"vendor_name": "Kiran Stores", "invoice_number": "KS/77", "invoice_date": "2024-02-29",
        "total_amount": 812.25, "tax_amount": 38.0, "line_items": [
            {"product_desc": "Rice", "quantity": 3, "unit_price": 200, "total_price": 600},
            {"product_desc": "Lentils", "quantity": 1, "unit_price": 174.25, "total_price": 174.25}]}
BAD = {"vendor_name": "Torn Bill", "total_amount": "about eighty"}
ENTRY = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                     "__spark_entry__.py")
DDL = "file_name string, seq bigint, raw string"


def three_documents(spark):
    return spark.createDataFrame([("1.jpg", 1, json.dumps(GOOD)), ("2.pdf", 2, json.dumps(GOOD)),
                                  ("3.jpg", 3, json.dumps(BAD))], DDL)


def problems(spark, *documents, strict=False):
    rows = [(str(i), i, d if isinstance(d, str) or d is None else json.dumps(d))
            for i, d in enumerate(documents)]
    found = val.validate(spark.createDataFrame(rows, DDL), strict=strict)
    told = found.select("seq", "error_type", val.error_message(F.col("errors"))).orderBy("seq")
    return [(r[1], r[2]) for r in told.collect()]


def test_validation_rules(spark):
    got = problems(
        spark, GOOD, {"vendor_name": 5, "total_amount": None, "invoice_date": 7},
        {"vendor_name": "V", "total_amount": " 12 ", "line_items": None},
        {"vendor_name": "V", "total_amount": "12d"}, {"vendor_name": "V", "total_amount": True},
        {"vendor_name": "V", "total_amount": 1, "line_items": [
            {"product_desc": "x", "quantity": None}, 5, {"quantity": "2"}]},
        [1], "{", None, {"vendor_name": "V" * 256, "total_amount": 1e16},
        {"vendor_name": "V", "total_amount": 1, "invoice_date": "2023-13-45"},
        {"vendor_name": "V", "total_amount": 1, "line_items": {"a": 1}})
    assert got == [
        (None, ""),
        ("validation", "vendor_name: string_type; invoice_date: string_type;"
                       " total_amount: float_type"),
        ("validation", "line_items: list_type"),
        ("validation", "total_amount: float_parsing"), (None, ""),
        ("validation", "line_items.0.quantity: float_type; line_items.1: model_type;"
                       " line_items.2.product_desc: missing"),
        ("validation", "model_type"), ("json", "json_invalid"), ("json", "json_invalid"),
        ("constraint", "vendor_name: text_too_long; total_amount: numeric_overflow"),
        ("constraint", "invoice_date: date_invalid"), ("validation", "line_items: list_type")]


def test_strict_rejects_number_text(spark):
    documents = ({"vendor_name": "V", "total_amount": "12"},
                 {"vendor_name": "V", "total_amount": True})
    assert [p[0] for p in problems(spark, *documents)] == [None, None]
    assert [p[0] for p in problems(spark, *documents, strict=True)] == ["validation"] * 2


@pytest.mark.parametrize("mode, items", [("replace", 2), ("append", 4)])
def test_two_files_one_invoice(spark, tmp_path, mode, items):
    store = StagingStore(spark, str(tmp_path / "s"), mode).create()
    store.load(three_documents(spark), 0)
    assert (store.vendors().count(), store.invoices().count(), store.line_items().count(),
            store.dlq().count()) == (1, 1, items, 1)
    store.load(three_documents(spark), 0)  # the same batch again is not loaded
    assert store.line_items().count() == items
    again = dict(GOOD, tax_amount=None, invoice_number="other")
    store.load(spark.createDataFrame([("4.jpg", 4, json.dumps(again))], DDL), 1)
    invoice = store.invoices().first()
    assert (invoice.invoice_id, invoice.invoice_number, invoice.tax_amount) == (
        1, GOOD["invoice_number"], None)
    assert store.line_items().count() == (2 if mode == "replace" else 6)


def test_unpublished_batch_is_invisible(spark, tmp_path):
    store = StagingStore(spark, str(tmp_path / "s")).create()
    store._publish = lambda *name: None
    store.load(three_documents(spark), 0)
    assert store.vendors().count() == store.invoices().count() == store.dlq().count() == 0


def test_streaming_equals_batch_with_redelivery(spark, tmp_path):
    source = tmp_path / "in"
    documents = three_documents(spark)
    store = StagingStore(spark, str(tmp_path / "s")).create()

    def run():
        stream = ingest.document_stream(spark, str(source), DDL, files_per_batch=1)
        ingest.stream_ingest(stream, store, str(tmp_path / "c")).awaitTermination()

    documents.where("seq < 3").coalesce(1).write.parquet(str(source))
    run()
    documents.coalesce(1).write.mode("append").parquet(str(source))  # delivered again
    run()
    batch = StagingStore(spark, str(tmp_path / "b")).create()
    batch.load(documents, 0)
    for table in ("vendors", "invoices", "line_items"):
        drop = ("created_at", "updated_at", "line_item_id")
        got, want = (sorted(map(str, getattr(s, table)().drop(*drop).select(
            *sorted(c for c in getattr(s, table)().columns if c not in drop)).collect()))
            for s in (store, batch))
        assert got == want
    assert [r.file_name for r in store.dlq().collect()] == ["3.jpg"]


def test_late_documents_are_dropped_by_watermark(spark, tmp_path):
    for part in ([("a", "2024-01-10"), ("a", "2024-01-10")], [("b", "2020-01-01")]):
        spark.createDataFrame(part, "invoice_hash string, at string").coalesce(1).write.mode(
            "append").parquet(str(tmp_path / "in"))
        stream = ingest.document_stream(spark, str(tmp_path / "in"),
                                        "invoice_hash string, at string")
        kept = ingest.stream_dedup(stream, "at", "1 day")
        ingest.run_to_table(kept, str(tmp_path / "o"), str(tmp_path / "c")).awaitTermination()
    assert [r[0] for r in spark.read.schema("invoice_hash string").parquet(
        str(tmp_path / "o")).collect()] == ["a"]


def test_number_rows_ignores_partitioning(spark):
    rows = spark.range(0, 1000).selectExpr("(id * 7919) % 1000 as seq", "id as k")
    got = [number_rows(rows.repartition(n), "seq", "k", "id", after=5).orderBy("seq").collect()
           for n in (1, 8)]
    assert got[0] == got[1]
    assert [r.id for r in got[0]] == list(range(6, 1006))


def test_lookup_of_a_hot_key(spark):
    many = spark.range(0, 3000).selectExpr("if(id % 3 = 0, 'hot', cast(id as string)) k", "id")
    one = many.select("k").distinct().withColumn("v", F.length("k"))
    got = keyed_lookup(many, one, ["k"])
    assert got.count() == 3000 and got.where(F.col("v") != F.length("k")).count() == 0


def names(rng, n):
    words = ("sri krishna bakery traders general store green metal bolt house "
             "union paper mills city fresh fruit").split()
    made = set()
    while len(made) < n:
        name = " ".join(rng.sample(words, rng.randint(1, 3)))
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(name))
            name = name[:at] + rng.choice(["", rng.choice("aeioxyz ")]) + name[at + 1:]
        made.add(" ".join(name.split()))
    return sorted(made - {""})


@pytest.mark.parametrize("threshold", RUNGS)
def test_block_keys_lose_no_pair(spark, threshold):
    rng = random.Random(int(threshold * 1000))
    left, right = names(rng, 250), names(rng, 250)
    long = ["a very long vendor name with many words in it " + x for x in ("north", "south")]
    longer = [" ".join([long[0]] * 4) + x for x in (" q", " r")]
    left = left + long[:1] + longer[:1] + ["ab", "abc"]
    right = right + long[1:] + longer[1:] + ["abd", "ba"]
    df = [spark.createDataFrame([(x,) for x in xs], f"{n} string")
          for xs, n in ((left, "norm"), (right, "v_norm"))]
    rows = [(r[0], r[1]) for r in similar_pairs(*df, threshold).collect()]
    con = duckdb.connect()
    con.execute("CREATE TABLE l AS SELECT unnest(?) AS a", [left])
    con.execute("CREATE TABLE r AS SELECT unnest(?) AS b", [right])
    want = set(con.execute("SELECT a, b FROM l, r WHERE a <> b AND "
                           f"jaro_winkler_similarity(a, b) > {threshold}").fetchall())
    assert want and set(rows) == want
    assert len(rows) == len(want)  # each pair once


def test_large_blocks_are_split(spark, monkeypatch):
    """With blocks of very few names every key is cut into parts, and nothing is lost."""
    from billflow.operators import resolve
    rng = random.Random(3)
    left = [f"customer {rng.randrange(10 ** 6):06d}" for _ in range(120)]
    right = [f"customer {rng.randrange(10 ** 6):06d}" for _ in range(120)]
    df = [spark.createDataFrame([(x,) for x in sorted(set(xs))], f"{n} string")
          for xs, n in ((left, "norm"), (right, "v_norm"))]
    whole = sorted(map(tuple, similar_pairs(*df, 0.92).collect()))
    monkeypatch.setattr(resolve, "BLOCK", 3)
    assert whole and sorted(map(tuple, similar_pairs(*df, 0.92).collect())) == whole


def test_near_equal_names_meet_fewer_than_all_pairs(spark):
    """Numbered names that all resemble each other: the rows met at all rungs stay below the number of pairs."""
    sf = "/root/testdata/sf0.1"
    customers = spark.read.parquet(f"{sf}/customer.parquet").select(F.regexp_replace(
        F.lower("c_name"), "#", "").alias("norm"))
    suppliers = spark.read.parquet(f"{sf}/supplier.parquet").select(F.regexp_replace(
        "s_name", "Supplier#0", "customer").alias("v_norm"))
    left = customers.join(suppliers, customers["norm"] == suppliers["v_norm"], "left_anti")
    n_pairs = left.count() * suppliers.count()
    left, right = with_tokens(left, suppliers)
    met = 0
    for threshold in RUNGS:
        pairs = met_pairs(left, right, threshold).cache()
        met += pairs.count()
        above = pairs.withColumn("s", jaro_winkler(F.col("norm"), F.col("v_norm"))).where(
            F.col("s") > threshold)
        left = left.join(above.select("norm"), "norm", "left_anti").cache()
        if left.isEmpty():
            break
    assert met < n_pairs / 2


def test_resolution_keeps_null_names(spark):
    incoming = spark.createDataFrame([(None,), ("Asha Stores",), ("",), (None,)], "name string")
    vendors = spark.createDataFrame([("Asha Storse",), (None,)], "vendor_name string")
    got = {r.name: (r.vendor_name, r.arm) for r in resolve_vendors(
        incoming, "name", vendors, phonetic=False).collect()}
    assert got == {None: (None, "exact"), "": (None, "exact"),
                   "Asha Stores": ("Asha Storse", "fuzzy")}


def test_ground_truth_file(spark, tmp_path):
    record = {"vendor_name": "V", "invoice_number": "1", "date": "2024-01-01",
              "total_amount": 5.0, "tax_amount": 0.0, "gstin": "Unspecified"}
    (tmp_path / "t.json").write_text(json.dumps({"b1.jpg": record, "b2.jpg": record}, indent=2))
    assert sorted(r.file for r in scan_ground_truth(spark, str(tmp_path)).collect()) == [
        "b1.jpg", "b2.jpg"]


def test_scan_files_keeps_all_and_says_why(spark, tmp_path):
    for name in ("a.jpg", "b.PNG", "c.gif", "d.HEIC", "e.pdf", "f.txt"):
        (tmp_path / name).write_bytes(b"x")
    got = admit_images(scan_files(spark, str(tmp_path))).select("file_name", "error").collect()
    assert sorted(r[0] for r in got) == ["a.jpg", "b.PNG", "c.gif", "d.HEIC", "e.pdf", "f.txt"]
    assert sorted(r[0] for r in got if r[1]) == ["e.pdf", "f.txt"]


def test_reused_numbers_of_other_writers_are_loaded(spark, tmp_path):
    store = StagingStore(spark, str(tmp_path / "s")).create()

    def bill(k):
        return spark.createDataFrame(
            [(f"{k}.jpg", k, json.dumps(GOOD | {"total_amount": float(k)}))], DDL)
    store.load(bill(1), 0, writer="one")
    store.load(bill(2), 1, writer="one")
    store.load(bill(3), 0, writer="two")
    store.load(bill(4), 0, writer="two")  # a replay by name
    assert sorted(int(r.total_amount) for r in store.invoices().collect()) == [1, 2, 3]


def test_run_pipeline_keeps_causes(spark, tmp_path):
    def extractor(file_name):
        if file_name == "b.jpg":
            raise ValueError("unreadable image")
        return GOOD if file_name == "a.jpg" else BAD
    files = spark.createDataFrame([("a.jpg", "image/jpeg", 1), ("b.jpg", "image/jpeg", 2),
                                   ("c.png", "image/png", 3), ("d.txt", "text/plain", 4)],
                                  "file_name string, mime string, seq bigint")
    store = StagingStore(spark, str(tmp_path / "s")).create()
    run_pipeline(files, extractor, store, 0, pause=None)
    assert store.invoices().count() == 1
    got = {r.file_name: (r.error_type, r.error_message) for r in store.dlq().collect()}
    assert got["b.jpg"] == ("extractor", "unreadable image")
    assert got["c.png"][0] == "validation"
    assert got["d.txt"] == ("extractor", "Please upload an image file.")


def test_error_payloads_and_repeats_in_metrics(spark):
    said = {"vendor_name": "V", "invoice_number": "1", "date": "2024-01-01", "total_amount": 5,
            "tax_amount": 0, "gstin": "x"}
    rows = [("f", "m", None, json.dumps(said)), ("f", "m", None, json.dumps(said)),
            ("g", "m", None, json.dumps({"error": "quota"}))]
    parsed = E.parse_attempts(spark.createDataFrame(
        rows, "file string, model string, error string, payload string"))
    assert {r.file: r.error for r in parsed.collect()} == {"f": None, "g": "quota"}
    truth = spark.createDataFrame([("f", "V", "1", "2024-01-01", 5.0, 0.0, "x")],
                                  "file string, vendor_name string, invoice_number string,"
                                  " date string, total_amount double, tax_amount double, gstin string")
    scored = E.evaluate(E.join_ground_truth(parsed, truth), phonetic=False)
    metrics = E.field_metrics(scored, ["m", "n"]).collect()
    assert all(r.correct <= r.total == 2 for r in metrics)
    none = E.field_accuracy(E.field_metrics(scored.limit(0), ["m"])).collect()
    assert [r.pct for r in none] == [None] * 6


def test_equal_sentinels_can_count(spark):
    rows = [("f", "m", None, json.dumps({"gstin": "Unspecified", "vendor_name": "V"}))]
    attempts = E.parse_attempts(spark.createDataFrame(
        rows, "file string, model string, error string, payload string"))
    truth = spark.createDataFrame(
        [("f", "V", "1", "2024-01-01", 1.0, 0.0, "Unspecified")],
        "file string, vendor_name string, invoice_number string, date string,"
        " total_amount double, tax_amount double, gstin string")
    joined = E.join_ground_truth(attempts, truth)
    passed = [E.evaluate(joined, sentinels=s).select("evaluation.passed").first()[0]
              for s in ((), ("Unspecified",))]
    assert passed == [1, 2]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_validation_is_one_narrow_native_pass(spark):
    checked = val.validate(three_documents(spark))
    assert "Exchange" not in plan(checked) and "Python" not in plan(checked)


def test_evaluation_scores_without_moving_rows(spark, tmp_path):
    rows = spark.createDataFrame([("a", "b")], "e string, t string")
    from billflow.operators.vendor_match import match_vendors
    assert "Exchange" not in plan(match_vendors(rows, F.col("e"), F.col("t")))


def test_no_cartesian_product(spark, sf_dir):
    from checks.queries import QUERIES
    for name in ("field_metrics", "result_grid"):
        assert "CartesianProduct" not in plan(QUERIES[name](spark, sf_dir))


def test_routing_summary(spark):
    got = {(r.route, r.error_type): r.n_documents
           for r in routing_summary(three_documents(spark)).collect()}
    assert got == {("load", "none"): 2, ("dlq", "validation"): 1}


def test_cascade_delete_and_null_tax(spark):
    vendors = spark.createDataFrame([(1, "a"), (2, "b")], "vendor_id long, vendor_name string")
    invoices = spark.createDataFrame([(1, 1), (2, 2)], "invoice_id long, vendor_id long")
    items = spark.createDataFrame([(1,), (1,), (2,)], "invoice_id long")
    left = load.cascade_delete(vendors, invoices, items, vendors.where("vendor_name = 'a'"))
    assert [df.count() for df in left] == [1, 1, 1]


def test_normalisation_is_stable(spark, sf_dir):
    names_in = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_name").distinct()
    once = normalize_vendor(F.col("p_name"))
    assert names_in.where(normalize_vendor(once) != once).count() == 0


def test_workers_need_no_installed_package(tmp_path):
    """The Python functions travel by value, so a session elsewhere can run them."""
    script = (
        "import importlib.util as u\n"
        "from pyspark.sql import SparkSession\n"
        "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false')"
        ".getOrCreate()\n"
        f"p = u.spec_from_file_location('e', r'{ENTRY}')\n"
        "m = u.module_from_spec(p); p.loader.exec_module(m)\n"
        "for n in ('match_vendor_phonetic', 'double_metaphone', 'model_fanout'):\n"
        "    assert m.queries()[n](s, '/root/testdata/sf0.001').collect()\n")
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, capture_output=True,
                          text=True, timeout=180)
    assert done.returncode == 0, done.stderr[-2000:]


def test_evaluation_run_keeps_silent_models_and_last_attempts(spark):
    """Each bill has a row a model: the last attempt decides, an error payload fails, a silent model has its error."""
    from billflow.plans.etl import evaluate_run, run_log
    good = json.dumps({"vendor_name": "V", "invoice_number": "1", "date": "2024-01-01", "total_amount": 1.0,
                       "tax_amount": 0.0, "gstin": "27ABCDE1234F1Z5"})
    poor = json.dumps({"vendor_name": "V"})
    wrapped = json.dumps({"choices": [{"message": {"content": good}}]})
    answers = spark.createDataFrame([
        ("f", "m1", None, good, 1), ("f", "m1", None, poor, 2), ("f", "m1", None, poor, 2),
        ("f", "m2", None, poor, 1), ("f", "m2", None, wrapped, 3), ("f", "m3", None, '{"error": "quota"}', 1),
        ("g", "m1", "refused", None, 1), ("g", "other", None, good, 1)],
        "file string, model string, error string, raw string, attempt int")
    truth = spark.createDataFrame(
        [(f, "V", "1", "2024-01-01", 1.0, 0.0, "27ABCDE1234F1Z5") for f in "fh"],
        "file string, vendor_name string, invoice_number string, date string,"
        " total_amount double, tax_amount double, gstin string")
    scored = evaluate_run(answers, truth, ("m1", "m2", "m3"), phonetic=False)
    got = {(r.file, r.model): (r.error, r.run) for r in run_log(scored).collect()}
    silent = ("model gave no output", "failed")
    assert got.pop(("f", "m1"))[1] == "partial" and got.pop(("f", "m2")) == (None, "perfect")
    assert got == {("f", "m3"): ("quota", "failed"), ("g", "m1"): ("refused", "failed"), ("g", "m2"): silent,
                   ("g", "m3"): silent, ("h", "m1"): silent, ("h", "m2"): silent, ("h", "m3"): silent}


def test_a_boolean_total_is_a_number(spark):
    from billflow.functions.variants import parse_json
    from billflow.operators.expense import expense_mapping
    bills = spark.createDataFrame([(1, '{"total_amount": true}'), (2, '{"total_amount": false}'),
                                   (3, '{"total_amount": "0x10"}'), (4, '{"total_amount": null}')], "k int, t string")
    got = expense_mapping(bills.select("k", parse_json(F.col("t")).alias("r")), "r", "acc")
    assert [r.amount for r in got.orderBy("k").collect()] == [1.0, 0.0, 16.0, 0.0]
