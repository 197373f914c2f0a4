"""Vendor-name comparison for whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from billflow.functions.match import spec_vendor_result, vendor_result
from billflow.functions.phonetic import code_array, double_metaphone, phonetic_match
from billflow.functions.similarity import jaro_winkler
from billflow.functions.text import normalize_vendor
from billflow.operators.once import computed_once

PROFILES = {"code": vendor_result, "spec": spec_vendor_result}


def phonetic_codes(names: DataFrame, name: str) -> DataFrame:
    """(name, codes): each distinct name is coded once."""
    distinct = names.select(name).where(F.col(name).isNotNull()).distinct()
    return (distinct.withColumn("_dm", double_metaphone(F.col(name)))
            .select(name, code_array(F.col("_dm")).alias("codes")))


def match_vendors(rows: DataFrame, extracted: Column, truth: Column, phonetic: bool = True,
                  profile: str = "code", name: str = "vendor_match") -> DataFrame:
    """Adds the vendor comparison as a struct column, without moving any row.

    Rows equal after normalisation are decided inside the JVM and reach the Python functions
    as nulls, which cost next to nothing; of the others, each pair is scored once per batch.
    """
    normal = computed_once(rows, _norm_e=normalize_vendor(extracted, profile),
                           _norm_t=normalize_vendor(truth, profile))
    same = F.col("_norm_e") == F.col("_norm_t")
    e, t = F.when(~same, F.col("_norm_e")), F.when(~same, F.col("_norm_t"))
    scored = normal.withColumn("_similarity", jaro_winkler(e, t)).withColumn(
        "_phonetic", phonetic_match(e, t) if phonetic else F.lit(False))
    compared = PROFILES[profile](same, F.col("_phonetic"), F.col("_similarity"))
    return scored.withColumn(name, compared).drop(
        "_norm_e", "_norm_t", "_similarity", "_phonetic")
