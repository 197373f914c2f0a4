"""Number parsing and number text, as native column expressions.

There are three parsers because the three callers disagree: the validator takes a whole
number text, the evaluator takes the longest numeric prefix, the expense mapper takes a
whole number text or zero. They are kept apart on purpose.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Accepted number texts.
WHOLE_NUMBER = r"\A\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*\z"
WHOLE_NUMBER_OR_WORD = (
    r"\A\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:nan|inf|infinity))\s*\z"
)
INFINITE = r"\A\s*[+-]?Infinity\s*\z"
DIGIT_BASES = {16: r"\A\s*0[xX]([0-9a-fA-F]+)\s*\z", 8: r"\A\s*0[oO]([0-7]+)\s*\z",
               2: r"\A\s*0[bB]([01]+)\s*\z"}
NUMBER_PREFIX = r"\A\s*([+-]?(?:Infinity|(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?))"


def _trimmed(text: Column) -> Column:
    return F.regexp_replace(text, r"\A\s+|\s+\z", "")


def whole_number(text: Column, words: bool = True) -> Column:
    """DOUBLE if the whole text is a number (optionally also nan/inf words), else null."""
    bare = _trimmed(text)
    guard = WHOLE_NUMBER_OR_WORD if words else WHOLE_NUMBER
    return F.when(text.rlike(guard), bare.try_cast("double"))


def prefix_number(text: Column) -> Column:
    """DOUBLE from the longest numeric prefix, null where there is none."""
    return F.regexp_extract(text, NUMBER_PREFIX, 1).try_cast("double")


def number_or_zero(text: Column) -> Column:
    """Whole-text number, also ``Infinity`` and digits after 0x, 0o or 0b; anything else, and NaN, becomes 0."""
    value = F.when(text.rlike(INFINITE), _trimmed(text).try_cast("double")).otherwise(
        whole_number(text, words=False))
    for base, shape in DIGIT_BASES.items():
        digits = F.split(F.regexp_extract(text, shape, 1), "")
        number = F.aggregate(digits, F.lit(0.0), lambda sofar, digit: sofar * base + F.conv(
            digit, 16, 10).cast("double"))
        value = F.when(text.rlike(shape), number).otherwise(value)
    return F.coalesce(F.when(~F.isnan(value), value), F.lit(0.0))


def _plain(value: Column) -> Column:
    """The shortest digits of a double without an exponent or trailing zeros."""
    shown = value.cast("string")
    small = shown.try_cast("decimal(38,30)").cast("string")
    large = shown.try_cast("decimal(38,10)").cast("string")
    return F.regexp_replace(F.when(F.abs(value) < 1, small).otherwise(large), r"\.?0+\z", "")


def _scientific(value: Column) -> Column:
    """``1.0E16`` as ``1e+16``."""
    shown = F.regexp_replace(value.cast("string"), r"(\.0)?E(?=\d)", "e+")
    return F.regexp_replace(shown, r"(\.0)?E-", "e-")


def py_float_text(value: Column) -> Column:
    """Text of a double as Python prints a float: ``525.0``, ``1e+16``, ``1.5e-05``."""
    size = F.abs(value)
    return (
        F.when((value == 0) | ((size >= 1e-3) & (size < 1e7)), value.cast("string"))
        .when(F.isnan(value), "nan")
        .when(size == float("inf"), F.when(value > 0, "inf").otherwise("-inf"))
        .when((size >= 1e16) | (size < 1e-4), F.regexp_replace(
            _scientific(value), r"e([+-])(\d)\z", "e$10$2"))
        .when(size < 1, _plain(value))
        .otherwise(F.regexp_replace(_plain(value), r"\A(-?\d+)\z", "$1.0"))
    )


def js_number_text(value: Column) -> Column:
    """Text of a double as JavaScript prints a number: ``525``, ``1e+21``, ``1e-7``."""
    size = F.abs(value)
    return (
        F.when((size >= 1e-3) & (size < 1e7),
               F.regexp_replace(value.cast("string"), r"\.0\z", ""))
        .when(value == 0, "0")
        .when(F.isnan(value) | (size == float("inf")), value.cast("string"))
        .when((size >= 1e21) | (size < 1e-6), _scientific(value))
        .otherwise(_plain(value))
    )
