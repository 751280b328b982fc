"""Keys that hold many rows, found without counting all keys.

A sketch of frequent items is filled in each task and merged: it follows a bounded number of keys, and none with a large
enough share of the rows can be missing from it. Only the keys it names are then counted exactly. So a table with
as many keys as rows is never shuffled to learn that none of them is frequent.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from millrace.workspace import materialize

# what the sketch may follow at most, and into how many sketches tasks are merged before these are merged
MOST_TRACKED = 1_000_000
FIRST_MERGE = 64
# the sketch misses no key with more than this many rows for each row in as many as it follows
SHARE_MISSED = 7


def key_hash(key: Sequence[str]) -> Column:
    """What stands for a key of any size in a list of keys; null is a key."""
    return F.xxhash64(*key)


def tracked_for(rows: int, more_than: int) -> int:
    """How many keys the sketch has to follow so that none with more than ``more_than`` of ``rows`` rows can be missing.

    A sketch that follows m keys is off by at most 3.5 / m of the rows, and names a key that has twice that.
    """
    return max(64, math.ceil(SHARE_MISSED * rows / max(1, more_than)))


def candidate_keys(df: DataFrame, key: Sequence[str], more_than: int, tracked: int) -> DataFrame:
    """The hashes (``_candidate``) of all keys that may have more than ``more_than`` rows, and few others."""
    group = (F.spark_partition_id() % FIRST_MERGE).alias("_group")
    merged = df.select(key_hash(key).alias("_key"), group).groupBy("_group").agg(F.expr(f"approx_top_k_accumulate(_key, {tracked})").alias("_sketch"))
    # one row each; a task without any would merge a sketch without a type
    whole = merged.repartition(1).agg(F.expr(f"approx_top_k_combine(_sketch, {tracked})").alias("_sketch"))
    found = whole.select(F.explode(F.expr(f"approx_top_k_estimate(_sketch, {tracked})")).alias("_found"))
    # the counts of the sketch are never too small
    return found.where(F.col("_found.count") > more_than).select(F.col("_found.item").alias("_candidate"))


def frequent_keys(df: DataFrame, key: str | Sequence[str], more_than: int, rows: int | None = None) -> DataFrame:
    """The key columns and exact number of rows ``n`` of every key that has more than ``more_than`` rows.

    ``rows`` may bring the number of rows of ``df``, if it is known. Null is a key. ``df`` is read two or three times
    and not shuffled, but for the rows of candidates after they have been added up in their tasks. There are fewer
    than rows / ``more_than`` candidates, and their list is broadcast. Where that would be beyond ``MOST_TRACKED``, all
    keys are counted instead, with the same answer.
    """
    key = [key] if isinstance(key, str) else list(key)
    counted = F.count("*").alias("n")
    if rows is None:
        rows = df.count()
    tracked = tracked_for(rows, more_than)
    if rows <= more_than:
        few = df.where(F.lit(False))
    elif tracked > MOST_TRACKED:
        few = df
    else:
        candidates = candidate_keys(df, key, more_than, tracked)
        # eight bytes each, and no more than the sketch follows
        few = df.join(F.broadcast(materialize(candidates, "candidates")), key_hash(key) == F.col("_candidate"), "left_semi")
    return few.groupBy(*key).agg(counted).where(F.col("n") > more_than)
