"""Sort, limit and row numbering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.workspace import materialize

# monotonically_increasing_id keeps the partition in the upper bits and the row in the lower 33
_ROW_BITS = 33


def top_k(df: DataFrame, k: int, *order: Column | str) -> DataFrame:
    """The first ``k`` rows in ``order``; each task keeps at most ``k``."""
    return df.orderBy(*order).limit(k)


def in_slots(df: DataFrame, order: list[Column]) -> DataFrame:
    """``df`` sorted over ranges and written down, with ``_slot``, ascending in ``order``, and its range ``_part``."""
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    slots = materialize(ranged.withColumn("_slot", F.monotonically_increasing_id()), "ordinal")
    return slots.withColumn("_part", F.shiftright("_slot", _ROW_BITS))


def with_ordinal(df: DataFrame, order: list[Column], name: str = "ordinal") -> DataFrame:
    """Number all rows 0, 1, 2, ... in ``order``, with no task seeing more than its range of rows.

    Rows are range-partitioned and sorted, the sorted slots are written down once, and each row adds
    its place within its partition to the rows in the partitions before it. ``order`` should tell any
    two rows apart, both for a repeatable numbering and so that ranges can split anywhere.
    """
    slots = in_slots(df, order)
    sizes = slots.groupBy("_part").agg(F.count("*").alias("_size"))
    # one row per range partition, whatever the size of the data
    offsets = sizes.select(
        "_part", (F.sum("_size").over(Window.orderBy("_part")) - F.col("_size")).alias("_offset")
    )
    return (
        slots.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + F.col("_slot").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)))
        .drop("_slot", "_part", "_offset")
    )
