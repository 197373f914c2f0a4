import re

import pytest
from pyspark.sql import functions as F

from billflow.functions.lets import let
from billflow.functions.match import match_float
from billflow.operators.evaluate import cells_of, evaluate, parse_attempts, result_grid
from billflow.schemas import TRUTH

JIT_LIMIT = 8000  # bytes; the JVM interprets a longer method for ever


def largest_method(spark, df) -> int:
    told = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "codegen")
    return max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", told)))


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Attempts, and attempts joined to their truth, as tables."""
    root = str(tmp_path_factory.mktemp("lets"))
    payloads = ['{"vendor_name":"A","invoice_number":7,"date":"2024-01-02","total_amount":12.5,"tax_amount":"1e3"}',
                '{"total_amount":-0.0,"tax_amount":true,"gstin":{"b":1},"error":0}', '{"error":"busy"}', "[1]", None]
    spark.createDataFrame([(f"bill_{k}.jpg", "m", None, p) for k, p in enumerate(payloads)],
                          "file string, model string, error string, payload string").write.parquet(f"{root}/a")
    attempts = spark.read.parquet(f"{root}/a")
    truth = F.from_json(F.lit('{"vendor_name":"A","total_amount":12.5,"tax_amount":1000}'), TRUTH)
    parse_attempts(attempts).withColumn("truth", truth).write.parquet(f"{root}/j")
    return attempts, spark.read.parquet(f"{root}/j")


def test_generated_methods_of_parsing_and_scoring_can_be_compiled(spark, stored):
    attempts, joined = stored
    scored = evaluate(joined, phonetic=False)
    steps = {"parse": parse_attempts(attempts), "score": scored, "lenient": cells_of(joined),
             "strict": cells_of(scored, "strict")}
    sizes = {name: largest_method(spark, df) for name, df in steps.items()}
    assert all(size < JIT_LIMIT for size in sizes.values()), sizes


def test_fields_are_read_as_before(stored):
    rows = {r["file"]: r for r in stored[0].transform(parse_attempts).collect()}
    first, second = (rows[f"bill_{k}.jpg"]["extracted"] for k in (0, 1))
    assert tuple(first) == ("A", "7", "2024-01-02", "12.5", "1e3", None, False)
    assert tuple(second)[3:6] == ("0", "true", '{"b":1}')
    assert [rows[f"bill_{k}.jpg"]["error"] for k in range(5)] == [
        None, None, "busy", "payload is no JSON object", "payload is no JSON object"]


def test_zeros_of_either_sign_print_differently(spark):
    rows = [("-0", 0.0), ("0", 0.0), ("-0", -0.0), ("12.5", 12.5), ("12.501", 12.5), ("x", 1.0), ("1", None)]
    df = spark.createDataFrame(rows, "e string, t double")
    got = [r[0] for r in df.select(match_float(F.col("e"), F.col("t"))["is_match"]).collect()]
    assert got == [False, True, True, True, True, False, False]


def test_let_names_a_value_and_keeps_null(spark):
    df = spark.createDataFrame([(1,), (None,)], "v int")
    got = [r[0] for r in df.select(let(F.col("v") + 1, lambda x: F.coalesce(x * x, F.lit(-1)))).collect()]
    assert got == [4, -1]


def test_grid_computes_attempts_once_and_shuffles_only_names(spark):
    rows = [("a", "m", "x"), ("a", "m", "y"), ("a", "other", "z"), ("b", "n", None), (None, "m", "w"), ("c", None, "v")]
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def noted(text):
        seen.add(1)
        return text

    attempts = spark.createDataFrame(rows, "file string, model string, error string").withColumn(
        "extracted", noted("error"))
    grid = result_grid(attempts, ["m", "n"], ["f", "g"])
    assert grid.columns == ["file", "model", "error", "extracted", "field"]
    got = sorted((tuple(r) for r in grid.where("field = 'f'").drop("error", "field").collect()), key=repr)
    want = [("a", "m", "x"), ("a", "m", "y"), ("a", "n", None), ("b", "m", None), ("b", "n", None), (None, "m", None),
            (None, "n", None), ("c", "m", None), ("c", "n", None)]
    assert got == sorted(want, key=repr)
    assert grid.where("field = 'g'").count() == len(want)
    assert seen.value == len(rows)
