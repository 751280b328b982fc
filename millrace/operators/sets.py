"""Set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame


def union_all(left: DataFrame, right: DataFrame) -> DataFrame:
    """All rows of both sides, matched by column name, duplicates kept."""
    return left.unionByName(right)


def intersect_distinct(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows found on both sides, each once.

    Both sides are reduced to distinct rows before they meet, so a value with many copies costs one
    row per task in the shuffle.
    """
    return left.distinct().intersect(right.distinct())
