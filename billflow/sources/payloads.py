"""Extraction payloads and ground truth as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from billflow.functions import variants as V
from billflow.functions.lets import let
from billflow.functions.numbers import prefix_number
from billflow.schemas import FIELDS, TRUTH
from billflow.sources.members import JsonMembers

# Where the two provider response shapes keep the payload text.
ENVELOPES = ("$.candidates[0].content.parts[0].text", "$.choices[0].message.content")


def read_truth(spark: SparkSession, path: str, whole_file: bool = True,
               split_bytes: int | None = None) -> DataFrame:
    """(file, the six fields, error, raw) from JSON objects keyed by file name.

    ``whole_file`` reads one object per file, split at its members so that one large object is
    read by many tasks; without it each line is an object. A record that cannot be read is a row
    with its ``error`` and its text in ``raw``. Amounts given as text count by their number.
    """
    if whole_file:
        spark.dataSource.register(JsonMembers)
        reader = spark.read.format("json_members")
        if split_bytes:
            reader = reader.option("splitBytes", split_bytes)
        members = reader.load(path).select(F.col("name").alias("file"), "error", F.col("value")
                                           .alias("raw"))
    else:
        lines = spark.read.text(path).where(F.trim("value") != "").withColumn(
            "_records", F.from_json("value", "map<string,variant>"))
        broken = F.array(F.struct(
            F.lit(None).cast("string").alias("file"), F.lit("line is no JSON object").alias("error"),
            F.col("value").alias("raw")))
        whole = F.transform(F.map_entries("_records"), lambda e: F.struct(
            e["key"].alias("file"), F.lit(None).cast("string").alias("error"),
            F.to_json(e["value"]).alias("raw")))
        members = lines.select(F.explode(F.when(F.col("_records").isNull(), broken).otherwise(
            whole)).alias("m")).select("m.*")
    opened = members.withColumn("_open", open_fields(V.parse_json(F.col("raw"))))
    failed = F.coalesce("error", F.when(F.col("_open").isNull(), "record is no JSON object"))

    def value(field: str) -> Column:
        text = V.js_text(F.col("_open")[field])
        number = TRUTH[field].dataType.typeName() == "double"
        return (prefix_number(text) if number else text).alias(field)
    return opened.withColumn("error", failed).select(
        "file", *[value(f) for f in TRUTH.names], "error", "raw")


def scan_ground_truth(spark: SparkSession, path: str, whole_file: bool = True) -> DataFrame:
    """One row per bill: the records of :func:`read_truth` that could be read."""
    return read_truth(spark, path, whole_file).where(F.col("error").isNull()).drop("error", "raw")


def parse_payloads(payloads: DataFrame, raw: str = "raw") -> DataFrame:
    """Adds ``doc`` (VARIANT) and, where text is no JSON document, ``error_type`` = json."""
    doc = V.parse_json(F.col(raw))
    return payloads.withColumn("doc", doc).withColumn(
        "error_type", F.when(F.col(raw).isNotNull() & F.col("doc").isNull(), "json"))


def unwrap_envelope(body: Column) -> Column:
    """The payload text inside a provider response; null if neither shape is present."""
    return F.coalesce(*[F.get_json_object(body, path) for path in ENVELOPES])


def resolve_extracted(record: Column) -> Column:
    """A record given either as ``{extracted: ...}`` or directly."""
    nested = V.member(record, "$.extracted")
    return F.when(V.is_truthy(nested), nested).otherwise(record)


def resolve_provider(response: Column, provider: str) -> Column:
    """A provider's part of a response: at the top, below ``data`` or ``results``, or all of it."""
    found = [V.member(response, path) for path in
             (f"$.{provider}", f"$.data.{provider}", f"$.results.{provider}")]
    return F.coalesce(*[F.when(V.is_truthy(f), f) for f in found], response)


def open_fields(doc: Column) -> Column:
    """The six scored members of a record, still untyped; null unless it is an object."""
    return F.try_variant_get(doc, "$", "struct<" + ",".join(f"{f}:variant" for f in FIELDS) + ">")


def extracted_fields(opened: Column) -> Column:
    """The six scored fields as text, plus whether the invoice number was a text."""
    return let(opened, lambda record: F.struct(
        *[V.js_text(record[f]).alias(f) for f in FIELDS],
        (V.kind(record["invoice_number"]) == "STRING").alias("invoice_number_is_text")))
