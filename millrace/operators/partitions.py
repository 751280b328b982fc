"""Partition counts."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

SMALL_INPUT_BYTES = 256 * 1024 * 1024
# rows of a partition for training, and the fewest partitions
MODEL_ROWS = 1_000_000
LEAST_MODEL_PARTS = 8


def planned_bytes(df: DataFrame) -> float:
    """Spark's size estimate of ``df``; for a file scan the size of its files, already listed.

    A remote session does not tell: everything then counts as large.
    """
    plan = getattr(df, "_jdf", None)
    if plan is None:
        return math.inf
    return int(str(plan.queryExecution().optimizedPlan().stats().sizeInBytes()))


def spread_small_input(df: DataFrame) -> DataFrame:
    """Give heavy per-row work on a small input one partition per core; the rows stay the same.

    A small file is one row group and hence one task. Larger inputs have partitions enough and are
    returned as they are, so no large table is ever shuffled for this. Not for input of models, whose
    result may depend on the layout, see ``stated_layout``.
    """
    if planned_bytes(df) > SMALL_INPUT_BYTES:
        return df
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def stated_layout(
    df: DataFrame, parts: int | None = None, *, key: Sequence[str] | None = None, rows: int = MODEL_ROWS
) -> DataFrame:
    """``df`` in sorted partitions that depend on its rows only, not on files, cores or the run.

    Training that samples or adds up by partition then repeats exactly. Rows are dealt and sorted by ``key`` (by
    default all columns), and those with one key by a hash of the rest, so wide columns are never compared. There is
    a partition for each ``rows`` rows, at least ``LEAST_MODEL_PARTS``; wide rows want fewer in each. A count of
    the rows decides, unless the caller gives ``parts``. Vectors have no order; leave them to a later step.
    """
    key = list(key or df.columns)
    rest = [c for c in df.columns if c not in key]
    parts = parts or max(LEAST_MODEL_PARTS, math.ceil(df.count() / rows))
    return df.repartition(parts, *key).sortWithinPartitions(*key, *([F.xxhash64(*rest)] if rest else []))


def partition_sizes(df: DataFrame) -> DataFrame:
    """``part`` and ``n``: the rows of each partition that holds any."""
    return df.groupBy(F.spark_partition_id().alias("part")).agg(F.count("*").alias("n"))


def partition_count(df: DataFrame) -> DataFrame:
    """One row: the number of partitions that hold rows."""
    return df.select(F.spark_partition_id().alias("p")).distinct().agg(F.count("*").alias("n"))
