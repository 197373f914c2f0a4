"""One query for each operator, over whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from billflow.llm import (
    byte_pairs, centroids, chat_tree, context_tree, jaccard_join, mixing, periodic_runs, quality_rules,
    sampled_fingerprints, sentence_pieces, substring_dedup, suffix_dedup, token_counts)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.linked_components(table(spark, sf_dir, "documents"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.without_copies(table(spark, sf_dir, "documents")).select(
        "doc_id", "text", "n_removed", "n_spans")


def piece_vocabulary() -> sentence_pieces.Vocabulary:
    return sentence_pieces.read_model(
        Path(public_tokenizers.path("piece_bpe_32k.model")).read_bytes())


def op3_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_pieces.encode_decode(table(spark, sf_dir, "documents"), piece_vocabulary())


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampled_fingerprints.with_fingerprints(table(spark, sf_dir, "documents"))


def op5_chat_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)],
                                    "conv_id long, turn long, role string, text string")
    return chat_tree.read_back(chat_tree.build(rows.unionByName(planted)))


def op6_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_tree.scored(table(spark, sf_dir, "documents"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.without_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = Path(public_tokenizers.path("byte_bpe_50k.json")).read_text(encoding="utf-8")
    return token_counts.with_token_counts(table(spark, sf_dir, "documents"), vocabulary)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents"),
                        mixing.domain_labels(table(spark, sf_dir, "labels")))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rules = quality_rules.learn_rules(
        quality_rules.labelled_stats(docs, table(spark, sf_dir, "labels")))
    return quality_rules.judged(docs, rules, "doc_id").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic_runs.planted(table(spark, sf_dir, "documents"))
    return periodic_runs.digests(periodic_runs.with_runs(docs, "doc_id"))


def op12_byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = Path(public_tokenizers.path("byte_bpe_50k.tiktoken")).read_bytes()
    encoded = byte_pairs.encode(table(spark, sf_dir, "documents"), ranks, "doc_id")
    return byte_pairs.digests(byte_pairs.decode(encoded, ranks))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.with_inertia(*centroids.clustered(table(spark, sf_dir, "embeddings")))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "pipeline": pipeline,
    "op1_jaccard_join": op1_jaccard_join,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_sentence_pieces": op3_sentence_pieces,
    "op4_fingerprints": op4_fingerprints,
    "op5_chat_tree": op5_chat_tree,
    "op6_context_tree": op6_context_tree,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_token_counts": op8_token_counts,
    "op9_mixing": op9_mixing,
    "op10_quality_rules": op10_quality_rules,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_byte_pairs": op12_byte_pairs,
    "op13_centroids": op13_centroids,
}

ORACLES: dict[str, str] = {
    "op13_centroids": centroids.oracle(),
}
