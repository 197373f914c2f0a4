"""Scoring extraction attempts against ground truth, and the reports built from the scores."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, functions as F

from billflow.functions import match as M
from billflow.functions.lets import let
from billflow.functions.text import bill_sequence
from billflow.functions.variants import parse_json
from billflow.operators.once import computed_once
from billflow.operators.vendor_match import match_vendors
from billflow.schemas import FIELDS, TRUTH
from billflow.sources.payloads import extracted_fields, open_fields
from billflow.workspace import written


NO_OUTPUT = "model gave no output"


def parse_attempts(attempts: DataFrame, payload: str = "payload") -> DataFrame:
    """(file, model, error, extracted), and ``attempt`` where there is one: a payload that is no JSON object becomes that row's error, as does
    a truthy ``error`` member of it."""
    more = [c for c in ("attempt",) if c in attempts.columns]
    parsed = computed_once(attempts.select("file", "model", "error", payload, *more),
                           _open=open_fields(parse_json(F.col(payload))))
    opened = F.col("_open")
    said = F.get_json_object(payload, "$.error")
    failed = F.coalesce(F.col("error"), F.when(opened.isNull(), "payload is no JSON object"),
                        F.when(~said.isin("", "false", "0", "null"), said))
    return computed_once(
        parsed, error=failed, extracted=F.when(failed.isNull(), extracted_fields(opened))
    ).select("file", "model", "error", "extracted", *more)


def union_models(outputs: Mapping[str, DataFrame]) -> DataFrame:
    """Per-model outputs as one long table with a ``model`` column."""
    tagged = [df.withColumn("model", F.lit(model)) for model, df in outputs.items()]
    whole = tagged[0]
    for df in tagged[1:]:
        whole = whole.unionByName(df)
    return whole


def last_outputs(outputs: DataFrame, models: Sequence[str],
                 all_bills: DataFrame | None = None) -> DataFrame:
    """(file, model, error, payload), exactly one row for each bill and model: the last attempt (by an ``attempt``
    column where there is one; of equal ones the greatest payload), or the error that there is none.

    Attempts are merged before the one shuffle, which is by bill; ``all_bills`` (a ``file`` column) adds bills that no
    model answered.
    """
    attempt = F.coalesce(F.col("attempt").cast("bigint"), F.lit(0)) if "attempt" in outputs.columns else F.lit(0)
    last = F.struct(attempt.cast("bigint").alias("attempt"), "payload", "error")
    rows = outputs.select("file", "model", last.alias("last"))
    if all_bills is not None:
        rows = rows.unionByName(all_bills.select("file"), allowMissingColumns=True)
    bills = rows.groupBy("file").agg(*[
        F.max(F.when(F.col("model") == m, F.col("last"))).alias(str(i)) for i, m in enumerate(models)])
    each = F.array(*[F.struct(F.lit(m).alias("model"), F.col(str(i)).alias("last"))
                     for i, m in enumerate(models)])
    found = bills.select("file", F.explode(each).alias("one")).select("file", "one.model", "one.last.*")
    silent = F.when(F.col("payload").isNull(), NO_OUTPUT)
    return found.select("file", "model", F.coalesce("error", silent).alias("error"), "payload")


def join_ground_truth(attempts: DataFrame, truth: DataFrame) -> DataFrame:
    """Left join on the file name; ``truth`` is a null struct where a bill has none."""
    packed = truth.select("file", F.struct(*[F.col(f) for f in FIELDS]).alias("truth"))
    return attempts.join(packed, "file", "left")


def evaluate(joined: DataFrame, phonetic: bool = True, profile: str = "code",
             sentinels: Sequence[str] = ()) -> DataFrame:
    """Adds ``evaluation`` (null when the model failed or truth is missing).

    ``sentinels`` are words such as ``Unspecified``: two equal ones count as a tax-id match.
    """
    e, t = F.col("extracted"), F.col("truth")
    matched = match_vendors(joined, e["vendor_name"], t["vendor_name"], phonetic, profile)
    gstin = M.match_gstin(F.coalesce(e["gstin"], F.lit("")), t["gstin"])
    if sentinels:
        agreed = e["gstin"].isin(*sentinels) & (e["gstin"] == t["gstin"])
        gstin = F.when(agreed, M.result(F.lit(True), F.lit("Both unspecified"))).otherwise(gstin)
    fields = {
        "vendor_name": F.col("vendor_match"),
        "invoice_number": M.match_invoice_number(
            e["invoice_number"], t["invoice_number"], e["invoice_number_is_text"]),
        "date": M.match_date(F.coalesce(e["date"], F.lit("")), t["date"]),
        "total_amount": M.match_float(e["total_amount"], t["total_amount"]),
        "tax_amount": M.match_float(e["tax_amount"], t["tax_amount"]),
        "gstin": gstin,
    }
    breakdown = F.struct(*[fields[f].alias(f) for f in FIELDS])
    gate = F.col("error").isNull() & t.isNotNull()
    compared = computed_once(matched, _breakdown=F.when(gate, breakdown))
    score = F.when(F.col("_breakdown").isNotNull(), document_score(F.col("_breakdown")))
    return computed_once(compared, evaluation=score).drop("vendor_match", "_breakdown")


def document_score(breakdown: Column) -> Column:
    """Passed count, field count and the percentage as text and as a number."""
    passed = sum((breakdown[f]["is_match"].cast("int") for f in FIELDS), F.lit(0))
    share = passed / F.lit(len(FIELDS)) * 100
    return F.struct(
        F.concat(F.format_string("%.1f", share), F.lit("%")).alias("accuracy_score"),
        share.alias("accuracy_pct"), passed.alias("passed"),
        F.lit(len(FIELDS)).alias("total"), breakdown.alias("field_breakdown"))


def correct_flags(scored: DataFrame, matcher: str = "lenient") -> dict[str, Column]:
    """Per field, whether an attempt counts as correct."""
    if matcher not in ("lenient", "strict"):
        raise ValueError("matcher must be 'lenient' or 'strict'")
    failed = F.col("error").isNotNull() | F.col("extracted").isNull()

    def flag(field: str) -> Column:
        pair = F.struct(F.col(f"extracted.{field}").alias("e"), truth_text(field).alias("t"))
        lenient = let(pair, lambda p: M.match_field_lenient(p["e"], p["t"], field))
        if matcher == "lenient":
            return F.when(failed, False).otherwise(lenient)
        return M.field_correct(F.col(f"evaluation.field_breakdown.{field}"), failed, lenient)

    return {f: flag(f) for f in FIELDS}


def truth_text(field: str) -> Column:
    """A truth value as text; amounts are compared as numbers, so their form does not matter."""
    value = F.col(f"truth.{field}")
    if TRUTH[field].dataType.typeName() == "double":
        return F.when(value.isNotNull(), F.format_string("%.6f", value))
    return value


def result_grid(attempts: DataFrame, models: Sequence[str],
                fields: Sequence[str] = tuple(FIELDS)) -> DataFrame:
    """Every bill with a result x model x field; a missing model output stays as a null row.

    The attempts are computed once, into the shared folder, and never shuffled: only a bill's name and which models
    answered it are, merged before.
    """
    stored, file = written(attempts, "attempts"), F.col("file")
    wanted = F.explode(F.array(*[F.lit(m) for m in models]))
    answered = stored.groupBy("file").agg(*[
        F.coalesce(F.max(F.col("model") == m), F.lit(False)).alias(str(i)) for i, m in enumerate(models)])
    silent = answered.select("file", F.explode(F.array_compact(F.array(*[
        F.when(file.isNull() | ~F.col(str(i)), m) for i, m in enumerate(models)]))).alias("model"))
    given = stored.where(file.isNotNull()).join(
        F.broadcast(stored.sparkSession.range(1).select(wanted.alias("model"))), "model")
    more = [c for c in attempts.columns if c not in ("file", "model")]
    cells = given.select("file", "model", *more).unionByName(silent, allowMissingColumns=True)
    return cells.withColumn("field", F.explode(F.array(*[F.lit(f) for f in fields])))


def field_unpivot(records: DataFrame, ids: Sequence[str],
                  fields: Sequence[str] = tuple(FIELDS)) -> DataFrame:
    """Wide records as (ids, field, value) rows with text values."""
    texts = records.select(*ids, *[F.col(f).cast("string").alias(f) for f in fields])
    return texts.unpivot(list(ids), list(fields), "field", "value")


def cells_of(scored: DataFrame, matcher: str = "lenient") -> DataFrame:
    """(file, model, attempt, a flag for each field); attempt is 0 where the rows have none."""
    attempt = F.col("attempt").cast("bigint") if "attempt" in scored.columns else F.lit(0)
    flags = correct_flags(scored, matcher)
    return scored.select("file", "model", F.coalesce(attempt, F.lit(0)).cast("bigint").alias(
        "attempt"), *[F.coalesce(flag, F.lit(False)).alias(f) for f, flag in flags.items()])


def attempt_rank() -> Column:
    """The attempt and its flags as one number: of repeated attempts the greatest is the last one, and of
    several with the same number always the same one."""
    rank = F.col("attempt")
    for f in FIELDS:
        rank = rank * 2 + F.col(f).cast("int")
    return rank


def field_metrics(scored: DataFrame, models: Sequence[str], matcher: str = "lenient",
                  all_bills: DataFrame | None = None) -> DataFrame:
    """(model, field, correct, total).

    ``total`` is the number of bills with any result - the same for every cell - so the
    bill x model x field grid is never built. The attempts are read once: a row per bill holds the
    flags of each model's last attempt (by an ``attempt`` column, where there is one), so an
    attempt delivered twice counts once and calling a model again can lower its accuracy, too.
    ``all_bills`` (a ``file`` column) makes bills without any result count too.
    """
    ranked = cells_of(scored, matcher).select("file", "model", attempt_rank().alias("rank"))
    bills = ranked.groupBy("file").agg(*[
        F.max(F.when(F.col("model") == m, F.col("rank"))).alias(str(i))
        for i, m in enumerate(models)])
    bits = {f: len(FIELDS) - 1 - k for k, f in enumerate(FIELDS)}
    cells = {f"{i}_{f}": (str(i), m, f) for i, m in enumerate(models) for f in FIELDS}
    sums = bills.agg(F.count(F.lit(1)).alias("total"), *[
        F.coalesce(F.sum(F.getbit(F.col(i), F.lit(bits[f]))), F.lit(0)).cast("bigint").alias(c)
        for c, (i, m, f) in cells.items()])
    if all_bills is not None:
        sums = sums.withColumn("total", all_bills.agg(F.count_distinct("file")).scalar())
    return sums.select("total", F.explode(F.array(*[
        F.struct(F.lit(m).alias("model"), F.lit(f).alias("field"), F.col(c).alias("correct"))
        for c, (i, m, f) in cells.items()])).alias("cell")).select(
        "cell.model", "cell.field", "cell.correct", "total")


def accuracy_pct(correct: Column, total: Column) -> Column:
    """A whole percentage; null where there are no results."""
    return F.when(total > 0, F.round(correct / total * 100)).cast("int")


def field_accuracy(metrics: DataFrame) -> DataFrame:
    return metrics.select("model", "field",
                          accuracy_pct(F.col("correct"), F.col("total")).alias("pct"))


def accuracy_matrix(metrics: DataFrame, models: Sequence[str]) -> DataFrame:
    """Fields down, models across, with each field's difficulty."""
    wide = field_accuracy(metrics).groupBy("field").pivot("model", list(models)).agg(
        F.first("pct"))
    return wide.withColumn("difficulty", M.field_difficulty(F.col("field")))


def progress(attempts: DataFrame, truth: DataFrame) -> DataFrame:
    """Evaluated against expected number of bills."""
    return attempts.agg(F.count_distinct("file").alias("evaluated")).withColumn(
        "expected", truth.agg(F.count(F.lit(1))).scalar())


def observed_progress(attempts: DataFrame, name: str = "progress") -> tuple[DataFrame, Observation]:
    """The same attempts, counted while whatever reads them runs: ``n_attempts``, ``n_failed`` and ``last_bill`` are
    in the observation after an action, and in each progress report of a stream, without a pass of their own."""
    seen = Observation(name)
    counts = [F.count(F.lit(1)).alias("n_attempts"),
              F.count_if(F.col("error").isNotNull()).alias("n_failed"),
              F.max(bill_sequence(F.col("file"))).alias("last_bill")]
    if attempts.isStreaming:
        return attempts.observe(name, *counts), seen
    return attempts.observe(seen, *counts), seen


def rank_models(metrics: DataFrame, cost_per_100: Mapping[str, float]) -> DataFrame:
    """Models by mean field accuracy, cheaper first on a tie (one row per model)."""
    cost = F.create_map(*[F.lit(x) for pair in cost_per_100.items() for x in pair])
    means = metrics.groupBy("model").agg(
        F.avg(F.col("correct") / F.col("total") * 100).alias("mean_accuracy"))
    priced = means.withColumn("cost_per_100", F.try_element_at(cost, F.col("model")))
    return priced.selectExpr(
        "*", "row_number() over (order by mean_accuracy desc, cost_per_100 asc, model asc)"
             " as place")


def top_model(metrics: DataFrame, cost_per_100: Mapping[str, float]) -> DataFrame:
    return rank_models(metrics, cost_per_100).where(F.col("place") == 1)


def model_cost(attempts: DataFrame, cost_per_100: Mapping[str, float]) -> DataFrame:
    """Cost of the run by model, from the list price for 100 bills."""
    cost = F.create_map(*[F.lit(x) for pair in cost_per_100.items() for x in pair])
    counted = attempts.groupBy("model").agg(F.count(F.lit(1)).alias("n_bills"))
    price = F.try_element_at(cost, F.col("model"))
    return counted.select("model", "n_bills", price.alias("cost_per_100"),
                          (F.col("n_bills") * price / 100).alias("run_cost"))


def evaluation_documents(scored: DataFrame, models: Sequence[str]) -> DataFrame:
    """One nested JSON document per bill: each model's extraction and evaluation.

    One conditional aggregate per model instead of a collected list, so repeated deliveries
    of a bill are merged before the shuffle; of different ones the greatest text stays. A model without a row is left
    out: rows from `last_outputs` have one for each.
    """
    extraction = F.coalesce(F.to_json(F.col("extracted").dropFields("invoice_number_is_text")),
                            F.to_json(F.struct("error")))
    part = F.struct(extraction.alias("extracted"), F.to_json("evaluation").alias("evaluation"))
    nested = scored.groupBy("file").agg(*[
        F.max(F.when(F.col("model") == m, part)).alias(m) for m in models])
    document = F.concat(F.lit("{"), F.concat_ws(",", *[
        F.when(F.col(m).isNotNull(), F.concat(
            F.lit(f'"{m}":{{"extracted":'), F.col(m)["extracted"], F.lit(',"evaluation":'),
            F.coalesce(F.col(m)["evaluation"], F.lit("null")), F.lit("}"))) for m in models]),
        F.lit("}"))
    return nested.select("file", document.alias("document"))


def results_in_bill_order(scored: DataFrame) -> DataFrame:
    """Results by the number in the bill's file name."""
    return scored.withColumn("bill_seq", bill_sequence(F.col("file"))).orderBy(
        "bill_seq", "file", "model")
