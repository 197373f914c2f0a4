"""The corpus pipeline: quality rules, one of each group of near copies, passages that repeat across
documents, mixing towards target weights, pieces. Each stage is written and read again by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from billflow.llm import jaccard_join, mixing, quality_rules, sentence_pieces, substring_dedup
from billflow.llm.queries import piece_vocabulary, table
from billflow.workspace import written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the learned rules reject go."""
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each group of linked documents stays."""
    groups = jaccard_join.linked_components(docs)
    gone = groups.filter("doc_id <> component_id").select(F.col("doc_id").alias("_gone"))
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that a document of smaller id has are cut out, and n_chars follows."""
    names = docs.columns
    cut = substring_dedup.without_copies(docs)
    return cut.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long"))
                          .otherwise(F.col("n_chars"))).select(*[f"`{n}`" for n in names])


def target_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the fitted rates drop go; the others stay, once each."""
    return mixing.keep_mixed(docs, mixing.domain_labels(table(spark, sf_dir, "labels")))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_pieces and the text read back."""
    return sentence_pieces.encode_decode(docs, piece_vocabulary())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality),
    ("ngram_jaccard_join", near_copies),
    ("substring_dedup", repeated_passages),
    ("mixing_to_targets", target_mix),
    ("sentencepiece", encoded),
]

ORACLE_SQL = None  # learned rules, chunk hashes and pieces are beyond SQL; see tests/llm


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
