"""Field matchers: each gives STRUCT<score DOUBLE, is_match BOOLEAN, details STRING>."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from billflow.functions.lets import let
from billflow.functions.numbers import js_number_text, prefix_number
from billflow.functions.text import GSTIN, ISO_DATE
from billflow.schemas import AMOUNT_FIELDS

# Thresholds.
FUZZY_ABOVE = 0.88
SPEC_MATCH_FROM = 0.85
SPEC_GREY_FROM = 0.75
LENIENT_AMOUNT_BELOW = 0.5
FIELD_SCORE_FROM = 0.8

# Characters trimmed before a lenient comparison.
BLANKS = " \t\n\x0b\f\r\u00a0\ufeff"

# Result texts.
EXACT_VENDOR = "Exact match (Normalized)"
PHONETIC_VENDOR = "Phonetic match (Double Metaphone)"
BAD_NUMBER = "Invalid number format"
BAD_DATE = "Invalid format. Expected YYYY-MM-DD"
BAD_GSTIN = "Fails standard GSTIN regex format"


def result(is_match: Column, details: Column, score: Column | None = None) -> Column:
    scored = F.when(is_match, 1.0).otherwise(0.0) if score is None else score
    return F.struct(scored.cast("double").alias("score"), is_match.alias("is_match"),
                    details.alias("details"))


def _shaped_equal(extracted: Column, truth: Column, shape: str, words: tuple) -> Column:
    """Shape test on the extracted text, then plain equality with the truth."""
    shaped = F.coalesce(extracted.rlike(shape), F.lit(False))
    same = F.coalesce(shaped & (extracted == truth), F.lit(False))
    bad, equal, different = words
    return result(same, F.when(~shaped, bad).when(same, equal).otherwise(different))


def match_date(extracted: Column, truth: Column) -> Column:
    return _shaped_equal(extracted, truth, ISO_DATE,
                         (BAD_DATE, "Exact date match", "Date mismatch"))


def match_gstin(extracted: Column, truth: Column) -> Column:
    return _shaped_equal(extracted, truth, GSTIN,
                         (BAD_GSTIN, "Exact GSTIN match", "GSTIN mismatch"))


def match_float(extracted: Column, truth: Column) -> Column:
    """Prefix-parsed number, equal to the truth when both print the same with 2 decimals."""
    def compared(number: Column, same: Column) -> Column:
        return result(same, F.when(number.isNull(), BAD_NUMBER)
                      .when(same, "Exact float match")
                      .otherwise(F.concat(F.lit("Mismatch: expected "), let(truth, js_number_text),
                                          F.lit(", got "), let(number, js_number_text))))

    def printed_alike(number: Column) -> Column:
        # Equal numbers print the same, but for zeros of either sign.
        return F.when((number == truth) & (number != 0), True).otherwise(F.coalesce(
            F.format_number(number, 2) == F.format_number(truth, 2), F.lit(False)))
    return let(prefix_number(extracted), lambda number: let(
        printed_alike(number), lambda same: compared(number, same)))


def match_invoice_number(extracted: Column, truth: Column,
                         extracted_is_text: Column | None = None) -> Column:
    """Strict equality, unscored; both absent is equal, a number never equals a text."""
    same = extracted.eqNullSafe(truth)
    if extracted_is_text is not None:
        same = same & F.coalesce(extracted_is_text, F.lit(True))
    return result(same, F.when(same, "Exact match").otherwise("Mismatch"), F.lit(None))


def vendor_result(exact: Column, phonetic: Column, similarity: Column) -> Column:
    """Cascade: normalised equality, shared phonetic code, similarity above the threshold."""
    shown = F.format_number(similarity, 2)
    fuzzy = similarity > FUZZY_ABOVE
    return (
        F.when(exact, result(F.lit(True), F.lit(EXACT_VENDOR), F.lit(1.0)))
        .when(phonetic, result(F.lit(True), F.lit(PHONETIC_VENDOR), F.lit(1.0)))
        .when(fuzzy, result(F.lit(True), F.concat(
            F.lit("Fuzzy match (Jaro-Winkler: "), shown, F.lit(")")), similarity))
        .otherwise(result(F.lit(False), F.concat(
            F.lit("No match (Jaro-Winkler: "), shown, F.lit(")")), similarity)))


def spec_vendor_result(exact: Column, phonetic: Column, similarity: Column) -> Column:
    """The written specification's order: similarity first, phonetics only in the grey zone."""
    shown = F.format_number(similarity, 2)
    grey = (similarity >= SPEC_GREY_FROM) & phonetic
    return (
        F.when(exact, result(F.lit(True), F.lit(EXACT_VENDOR), F.lit(1.0)))
        .when(similarity >= SPEC_MATCH_FROM, result(F.lit(True), F.concat(
            F.lit("Fuzzy match (Jaro-Winkler: "), shown, F.lit(")")), similarity))
        .when(grey, result(F.lit(True), F.lit(PHONETIC_VENDOR), similarity))
        .otherwise(result(F.lit(False), F.concat(
            F.lit("No match (Jaro-Winkler: "), shown, F.lit(")")), similarity)))


def match_field_lenient(extracted: Column, truth: Column, field: str) -> Column:
    """Dashboard matcher: absent truth always counts, amounts within 0.5, texts by containment."""
    e, t = (F.lower(F.btrim(x, F.lit(BLANKS))) for x in (extracted, truth))
    if field in AMOUNT_FIELDS:
        digits = [prefix_number(F.regexp_replace(x, r"[^0-9.]", "")) for x in (e, t)]
        same = F.abs(digits[0] - digits[1]) < LENIENT_AMOUNT_BELOW
    else:
        same = (e == t) | e.contains(t) | t.contains(e)
    return (F.when(truth.isNull(), True).when(extracted.isNull(), False)
            .otherwise(F.coalesce(same, F.lit(False))))


def field_correct(evaluated: Column, failed: Column, lenient: Column) -> Column:
    """An evaluator result decides if there is one; else the lenient match of a non-failed run."""
    return (
        F.when(evaluated.isNotNull(), F.coalesce(evaluated["is_match"], F.lit(False))
               | F.coalesce(evaluated["score"] >= FIELD_SCORE_FROM, F.lit(False)))
        .when(failed, False)
        .otherwise(lenient))


def status_band(accuracy: Column) -> Column:
    return F.when(accuracy.isNull(), "not run").when(accuracy >= 80, "good").otherwise("weak")


def run_label(failed: Column, passed: Column, score_text: Column) -> Column:
    """One model's line in the per-bill log."""
    return F.when(failed, "Error / Failed").otherwise(F.concat(
        F.coalesce(passed, F.lit(0)).cast("string"), F.lit(" / 6 ("),
        F.coalesce(score_text, F.lit("0%")), F.lit(")")))


def run_band(failed: Column, passed: Column) -> Column:
    return (F.when(failed, "failed").when(F.coalesce(passed, F.lit(0)) == 6, "perfect")
            .otherwise("partial"))


def field_difficulty(field: Column) -> Column:
    # Difficulty labels.
    return (F.when(field == "vendor_name", "High (Cursive)")
            .when(field == "gstin", "High (15-digit OCR)").otherwise("Medium"))
