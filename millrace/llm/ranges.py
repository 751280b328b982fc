"""Rows in one global order, dealt over tasks, each with the row that follows it.

A window over all rows would put them into a single task. Here the rows are cut into key ranges; the
first row of each range is copied to the end of the range before it, so that every task can walk its
rows in order and look one row ahead.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import DataFrame, functions as F


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def range_starts(df: DataFrame, keys: list[str], parts: int) -> list[tuple]:
    """The smallest key of each of at most ``parts`` ranges of about equally many rows, ascending.

    Only the keys are shuffled, and only one key for each range reaches the driver. Keys must not be null.
    """
    heads = (
        df.select(*keys)
        .repartitionByRange(parts, *keys)
        .groupBy(F.spark_partition_id().alias("_part"))
        .agg(F.min(F.struct(*keys)).alias("_head"))
    )
    return sorted(tuple(row["_head"]) for row in heads.collect())


def range_of(starts: list[tuple], key: tuple) -> int:
    return max(0, bisect_right(starts, key) - 1)
