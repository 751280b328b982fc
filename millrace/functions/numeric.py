"""Numeric column functions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, functions as F


def round_half_up(col: Column) -> Column:
    """Nearest whole number, halves toward plus infinity (SQL ``round`` takes them away from zero).

    Doubling is exact, so no value just below a half is rounded up by accident.
    """
    return F.ceil(F.floor(col * 2) / 2).cast("double")


def bucket_nearest(col: Column, width: float = 10.0) -> Column:
    """The nearest multiple of ``width``."""
    return round_half_up(col / width) * width


def bucket_by_last_digit(col: Column) -> Column:
    """Whole-number form of the width-10 bucket: last digit below 5 goes down, any other up."""
    digit = col % 10
    return F.when(digit < 5, col - digit).otherwise(col - digit + 10)


def mean_across(cols: Sequence[Column]) -> Column:
    """Mean of several columns of one row."""
    return reduce(add, cols) / F.lit(float(len(cols)))


def mean_abs_across(cols: Sequence[Column]) -> Column:
    """Rounded mean of the absolute values of several columns of one row."""
    return round_half_up(mean_across([F.abs(c) for c in cols]))


def truncated_mean_abs_across(cols: Sequence[Column]) -> Column:
    """Mean of the absolute values of several columns of one row, cut to a whole number."""
    return mean_across([F.abs(c) for c in cols]).cast("int")


def bin_percent(part: Column, whole: Column, width: float = 25.0) -> Column:
    """``part`` as a percentage of ``whole + 1``, to the nearest ``width``; null where that is zero."""
    return bucket_nearest(F.try_divide(part, whole + 1) * 100, width)


def whole_percent(part: Column, whole: Column) -> Column:
    """Whole multiples of 100 per cent of ``whole`` in ``part``; 100 where ``whole`` is zero."""
    quotient = (part / F.nullif(whole, F.lit(0))).cast("int")
    return F.when(whole == 0, F.lit(100)).otherwise(quotient * 100)
