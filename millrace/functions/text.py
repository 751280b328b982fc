"""Text column functions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The three accepted spellings of a number, each matched against the whole string.
SIGNED_DECIMAL = r"^[-+]?\d*\.?\d+$"
ONE_DIGIT_FRACTION = r"^[+-]?\d+\.?\d?$"
OPTIONAL_DIGITS = r"^[+-]?\d*\.?\d*$"

# a number as it may stand in a file, with an optional power of ten
DECIMAL = r"^[-+]?(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?$"

# Fixed value: the characters that end a token.
WHITESPACE = " \t\n\x0b\f\r"


def is_number(col: Column, pattern: str = SIGNED_DECIMAL) -> Column:
    return F.rlike(col, F.lit(pattern))


def _split_without_tail(col: Column, separators: str) -> Column:
    only_separators = (F.rtrim(col, F.lit(separators)) == "") & (col != "")
    parts = F.split(F.rtrim(col, F.lit(separators)), rf"[\Q{separators}\E]")
    return F.when(only_separators, F.array().cast("array<string>")).otherwise(parts)


def split_fields(col: Column, sep: str) -> Column:
    """Split on one literal character. Inner empty fields stay, those at the end go."""
    return _split_without_tail(col, sep)


def tokens(col: Column) -> Column:
    """Lower-case and split on each whitespace character. Inner empty tokens stay, those at the end go."""
    return _split_without_tail(F.lower(col), WHITESPACE)


def render_list(*cols: Column) -> Column:
    """``[a, b, c]``"""
    return F.concat(F.lit("["), F.concat_ws(", ", *cols), F.lit("]"))
