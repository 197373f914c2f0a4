"""One row per branch and boundary of the scalar rules."""

import random

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from billflow.functions import match as M, numbers as N, text as T
from billflow.functions.phonetic import codes
from billflow.functions.similarity import jaro_winkler_series
from billflow.operators.vendor_match import match_vendors
from billflow.sources import files
from billflow.sources.extract import wait_before


def column(spark, rows, ddl, *expressions):
    df = spark.createDataFrame(rows, ddl)
    return [tuple(r) if len(expressions) > 1 else r[0]
            for r in df.select(*expressions).collect()]


def test_normalize_vendor(spark):
    names = {"A.B. Ltd": "ab", "  Foo   Pvt. Ltd. ": "foo", "Ltd Company": "company",
             "a b": "a b", "मधु": "", None: "", "": "", "Incorp Inc": "incorp"}
    got = column(spark, [(n,) for n in names], "n string", T.normalize_vendor(F.col("n")))
    assert got == list(names.values())


def test_prefix_and_whole_numbers(spark):
    rows = {"1,500": (1.0, None), " 12.5abc": (12.5, None), "₹500": (None, None),
            "null": (None, None), " 12 ": (12.0, 12.0), ".5": (0.5, 0.5), "5.": (5.0, 5.0),
            "1e3": (1000.0, 1000.0), "12d": (12.0, None), "-Infinity": (-float("inf"),
                                                                     -float("inf")), "": (None, None)}
    got = column(spark, [(n,) for n in rows], "n string", N.prefix_number(F.col("n")),
                 N.whole_number(F.col("n")))
    assert got == list(rows.values())
    zero = column(spark, [(n,) for n in rows], "n string", N.number_or_zero(F.col("n")))
    assert zero == [0.0, 0.0, 0.0, 0.0, 12.0, 0.5, 5.0, 1000.0, 0.0, -float("inf"), 0.0]


def test_numbers_in_other_forms(spark):
    rows = {"Infinity": float("inf"), " +Infinity ": float("inf"), "infinity": 0.0, "inf": 0.0, "NaN": 0.0,
            "0x1A": 26.0, "0Xff ": 255.0, "0b101": 5.0, "0o17": 15.0, "0x": 0.0, "-0x1A": 0.0, "0b2": 0.0,
            "0x" + "f" * 20: float(16 ** 20 - 1), None: 0.0, "true": 0.0}
    got = column(spark, [(n,) for n in rows], "n string", N.number_or_zero(F.col("n")))
    assert got == list(rows.values())


def test_float_text_is_pythons(spark):
    values = [525.0, 1500.5, 12345678.9, 0.1, 0.00012, 999999999999.99, 1e16, 1e-5, 1.5e-7, 0.0,
              -0.0, -2.5, 123456789012345680.0, 9999999999999998.0, 1e100, float("inf"),
              float("-inf"), float("nan"), 0.001, 1e7, 1234567.125]
    got = column(spark, [(v,) for v in values], "v double", N.py_float_text(F.col("v")))
    assert got == [repr(v) for v in values]


def test_number_text_is_javascripts(spark):
    values = {525.0: "525", 0.0: "0", 1e21: "1e+21", 1e-7: "1e-7", 1e-6: "0.000001",
              1.5e20: "150000000000000000000", -1.25: "-1.25", 1.5e-7: "1.5e-7"}
    got = column(spark, [(v,) for v in values], "v double", N.js_number_text(F.col("v")))
    assert got == list(values.values())


def test_fingerprint_golden(spark):
    got = column(spark, [("ABC Corp", "2023-10-25", 1500.5)], "v string, d string, t double",
                 T.invoice_fingerprint(F.col("v"), F.col("d"), F.col("t")))
    assert got == ["e082c9312f92576d758828b8cef218e0"]


def test_match_float_boundaries(spark):
    rows = [("525.004", 525.0), ("525.01", 525.0), ("1.005", 1.0), ("1,500", 1500.0), (None, 1.0)]
    got = column(spark, rows, "e string, t double", M.match_float(F.col("e"), F.col("t")))
    assert [(r.score, r.is_match) for r in got] == [
        (1.0, True), (0.0, False), (1.0, True), (0.0, False), (0.0, False)]
    assert got[3].details == "Mismatch: expected 1500, got 1"
    assert got[4].details == M.BAD_NUMBER


def test_date_and_tax_id_shapes(spark):
    rows = [("2023-13-45", "2023-13-45"), ("2023-01-02\n", "2023-01-02"), (None, "2023-01-02")]
    got = column(spark, rows, "e string, t string", M.match_date(F.col("e"), F.col("t")))
    assert [r.is_match for r in got] == [True, False, False]
    rows = [("32ABCDE1234F1Z5", "32ABCDE1234F1Z5"), ("Unspecified", "Unspecified")]
    got = column(spark, rows, "e string, t string", M.match_gstin(F.col("e"), F.col("t")))
    assert [r.is_match for r in got] == [True, False]


def test_lenient_match(spark):
    rows = [("anything", None, "date"), (None, "x", "date"), ("", "x", "date"),
            (" ABC ", "abcd", "date"), ("100.5", "100", "total_amount"),
            ("100.49", "100", "total_amount"), ("-100", "100", "total_amount"),
            ("none", "100", "total_amount")]
    want = [True, False, True, True, False, True, True, False]
    df = spark.createDataFrame(rows, "e string, t string, f string")
    got = df.select(F.when(F.col("f") == "date", M.match_field_lenient(
        F.col("e"), F.col("t"), "date")).otherwise(M.match_field_lenient(
            F.col("e"), F.col("t"), "total_amount"))).collect()
    assert [r[0] for r in got] == want


def test_vendor_cascade(spark):
    rows = [("Foo Ltd", "foo"), ("Sri Bakery", "Sree Bakery"), ("martha stores", "marhta shop"),
            ("", "foo"), (None, ""), ("green bolt", "zzz")]
    df = spark.createDataFrame(rows, "e string, t string")
    got = [r[0] for r in match_vendors(df, F.col("e"), F.col("t")).select("vendor_match").collect()]
    assert [(r.is_match, r.details.split(" (")[0]) for r in got] == [
        (True, "Exact match"), (True, "Phonetic match"), (False, "No match"),
        (False, "No match"), (True, "Exact match"), (False, "No match")]


@pytest.mark.parametrize("name, primary, secondary", [
    ("Smith", "SM0", "XMT"), ("Schmidt", "XMT", "SMT"), ("Thompson", "TMPSN", "TMPSN"),
    ("Jose", "HS", "HS"), ("Xavier", "SF", "SFR"), ("Michael", "MKL", "MXL"),
    ("Filipowicz", "FLPTS", "FLPFX"), ("Bacher", "PKR", "PKR"), ("Arnow", "ARN", "ARNF"),
    ("Tagliaro", "TKLR", "TLR"), ("Cabrillo", "KPRL", "KPR"), ("Rogier", "RJ", "RJR"),
    ("Sri", "SR", "SR"), ("Sree", "SR", "SR"), ("Wasserman", "ASRMN", "FSRMN"),
    ("Laugh", "LF", "LF"), ("Edgar", "ATKR", "ATKR"), ("Edge", "AJ", "AJ"), ("", "", "")])
def test_double_metaphone(name, primary, secondary):
    assert codes(name) == (primary, secondary)


def test_jaro_winkler_equals_duckdb():
    rng = random.Random(7)
    words = ["".join(rng.choice("abcd e") for _ in range(rng.randint(0, rng.choice((3, 9, 30)))))
             for _ in range(8000)]
    left, right = pd.Series(words[:4000]), pd.Series(words[4000:])
    pairs = pd.DataFrame({"a": left, "b": right})  # noqa: F841 - read by the query below
    want = [r[0] for r in duckdb.sql(
        "SELECT jaro_winkler_similarity(a, b) FROM pairs").fetchall()]
    got = jaro_winkler_series(left, right)
    assert max(abs(g - w) for g, w in zip(got, want)) < 1e-12
    assert (jaro_winkler_series(right, left) - got).abs().max() < 1e-12
    assert jaro_winkler_series(pd.Series([None, "a"]), pd.Series(["a", "a"])).isna().tolist() == [
        True, False]


def test_data_url_has_no_line_breaks(spark):
    df = spark.createDataFrame([(bytes(range(200)),)], "c binary")
    url = df.select(files.encode_data_url(F.lit("image/png"), F.col("c"))).first()[0]
    assert len(url) == len("data:image/png;base64,") + 268


def test_retry_waits():
    assert [wait_before(n) for n in (1, 2, 3, 4)] == [2.0, 4.0, 8.0, 10.0]
