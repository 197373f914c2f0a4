"""End-to-end batch flows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, functions as F

from billflow.functions import match as M
from billflow.operators.evaluate import evaluate, join_ground_truth, last_outputs, parse_attempts
from billflow.operators.validate import validate
from billflow.plans.store import StagingStore
from billflow.sources.extract import extract_with_retry
from billflow.sources.files import admit_images
from billflow.sources.payloads import unwrap_envelope


def routing_summary(documents: DataFrame, strict: bool = False) -> DataFrame:
    """How many documents load, and why the others do not."""
    checked = validate(documents, strict=strict)
    first = F.get("errors", 0)
    return checked.select(
        F.when(F.col("error_type").isNull(), "load").otherwise("dlq").alias("route"),
        F.coalesce("error_type", F.lit("none")).alias("error_type"),
        F.coalesce(first["type"], F.lit("none")).alias("first_error"),
    ).groupBy("route", "error_type", "first_error").agg(F.count(F.lit(1)).alias("n_documents"))


def load_summary(store: StagingStore, documents: DataFrame) -> DataFrame:
    """Per delivered file whether it is in the dead-letter table, and the tables' sizes.

    Items hang on invoices and invoices on vendors, so equal counts along those links show
    that no document was loaded in part.
    """
    failed = store.dlq().select("file_name").withColumn("_failed", F.lit(True))
    routed = documents.select("file_name").join(failed, "file_name", "left").agg(
        F.count_if(F.col("_failed")).alias("n_failed"),
        F.count_if(F.col("_failed").isNull()).alias("n_loaded"))
    invoices, items, vendors = store.invoices(), store.line_items(), store.vendors()
    linked = invoices.join(vendors.select("vendor_id"), "vendor_id", "left_semi")
    owned = items.join(invoices.select("invoice_id"), "invoice_id", "left_semi")
    count = F.count(F.lit(1))
    return (routed.withColumn("n_vendors", vendors.agg(count).scalar())
            .withColumn("n_invoices", invoices.agg(count).scalar())
            .withColumn("n_invoices_with_vendor", linked.agg(count).scalar())
            .withColumn("n_items", items.agg(count).scalar())
            .withColumn("n_items_with_invoice", owned.agg(count).scalar()))


def run_pipeline(files: DataFrame, extractor: Callable[..., dict], store: StagingStore, batch: int,
                 writer: str = "batch", **options) -> None:
    """Admit, extract, validate, load: every file ends in the tables or, with its cause, in the dead-letter
    table. ``files`` has file_name, mime and seq; ``options`` go to the extractor calls.

    A refused file is not sent to the extractor.
    """
    admitted = admit_images(files)
    refused = admitted.where(F.col("error").isNotNull()).select(
        "file_name", "seq", F.lit(None).cast("string").alias("raw"),
        F.col("error").alias("error_message"))
    called = extract_with_retry(
        admitted.where(F.col("error").isNull()).select("file_name", "seq"), extractor,
        **options).select("file_name", "seq", "raw", "error_message")
    store.load(called.unionByName(refused), batch, writer=writer)


def evaluate_run(answers: DataFrame, truth: DataFrame, models: Sequence[str], all_bills: DataFrame | None = None,
                 **options) -> DataFrame:
    """Unwrap, parse, gate, score: one scored row for each bill and model, whatever the model did.

    ``answers`` has file, model, error and ``raw``, a provider's response or the bare payload (and ``attempt``, where
    calls were repeated); ``options`` go to the scoring.
    """
    payload = F.coalesce(unwrap_envelope(F.col("raw")), F.col("raw"))
    known = truth if all_bills is None else all_bills
    outputs = last_outputs(answers.withColumn("payload", payload).drop("raw"), models, known)
    return evaluate(join_ground_truth(parse_attempts(outputs), truth), **options)


def run_log(scored: DataFrame) -> DataFrame:
    """One line for each bill and model: its band, its label and why it failed."""
    failed, score = F.col("error").isNotNull(), F.col("evaluation")
    return scored.select(
        "file", "model", "error", M.status_band(score["accuracy_pct"]).alias("band"),
        M.run_band(failed, score["passed"]).alias("run"),
        M.run_label(failed, score["passed"], score["accuracy_score"]).alias("label"))
