"""Turning raw codes and dirty text into numbers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

from millrace.functions.text import DECIMAL, is_number


def number_or(col: Column, default: float | int | Column | None, kind: str = "double") -> Column:
    """The number in ``col``, or ``default`` where the text is not one.

    Numbers are digits with a sign, a point and a power of ten; what only a cast takes for one (``12d``,
    ``NaN``, ``Infinity``) is not.
    """
    text = F.trim(col.cast("string"))
    parsed = F.when(is_number(text, DECIMAL), text.try_cast(kind))
    return parsed if default is None else F.coalesce(parsed, F.lit(default).cast(kind))


def recode(col: Column, values: Mapping[str, object], otherwise: object = None) -> Column:
    """Exact-match recode; anything not listed becomes ``otherwise``."""
    chain = F
    for old, new in values.items():
        chain = chain.when(col == old, F.lit(new))
    return chain.otherwise(otherwise if isinstance(otherwise, Column) else F.lit(otherwise))


def recode_by_substring(col: Column, values: Mapping[str, str]) -> Column:
    """Replace, inside the text, the first listed word that it contains."""
    chain = F
    for word, code in values.items():
        chain = chain.when(F.contains(col, F.lit(word)), F.replace(col, F.lit(word), F.lit(code)))
    return chain.otherwise(col)


def two_level(col: Column, value: str, hit: float, miss: float) -> Column:
    return F.when(col == value, F.lit(hit)).otherwise(F.lit(miss))


def indicator(col: Column, value: str) -> Column:
    """1.0 where ``col`` equals ``value``, else 0.0 (also for null)."""
    return two_level(col, value, 1.0, 0.0)


def indicators(name: str, values: Sequence[str]) -> dict[str, Column]:
    """One indicator column per category, named after it, for ``withColumns``."""
    return {value: indicator(F.col(name), value) for value in values}


def normalise_code(col: Column, letters: Mapping[str, float], otherwise: float | None = None) -> Column:
    """Letters become their number, numbers are kept, anything else becomes ``otherwise``."""
    return recode(col, letters, otherwise=number_or(col, otherwise))
