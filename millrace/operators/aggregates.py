"""Aggregates. All of them reduce on the map side first, so a key with very many rows is no burden."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F
from pyspark.sql.types import IntegralType

from millrace.operators.ordering import in_slots

BYTES_PER_PIECE = 1 << 20


def partial_rate(df: DataFrame, keys: Sequence[str], flag: Column) -> DataFrame:
    """Rows ``n`` and flagged rows ``hits`` per key, ready for a join and a later ``rate_report``."""
    return df.groupBy(*keys).agg(F.count("*").alias("n"), F.sum(flag.cast("bigint")).alias("hits"))


def rate_report(df: DataFrame, keys: Sequence[str], hits: Column | str, n: Column | str | None = None) -> DataFrame:
    """Rows, flagged rows and their rounded percentage per group.

    ``hits`` is a 0/1 flag, or a partial count together with the partial row count ``n``.
    """
    total = F.count("*") if n is None else F.sum(n)
    return (
        df.groupBy(*keys)
        .agg(total.cast("bigint").alias("total"), F.sum(hits).cast("bigint").alias("hits"))
        .withColumn("percent", F.round(F.col("hits") * 100 / F.col("total")))
    )


def sum_count_mean(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Sum, number, mean and whole-number mean of ``value`` per key (no keys: of all rows).

    Nulls are no values: a caller to whom they mean zero coalesces them first. The whole-number mean of
    integers is exact; of other numbers the mean is cut.
    """
    integral = isinstance(df.schema[value].dataType, IntegralType)
    whole = F.expr("total div n") if integral else (F.col("total") / F.col("n")).cast("bigint")
    return (
        df.groupBy(*keys)
        .agg(F.sum(value).alias("total"), F.count(value).alias("n"), F.avg(value).alias("mean"))
        .withColumn("whole_mean", F.when(F.col("n") > 0, whole))
    )


def shortest_and_longest(df: DataFrame, value: str) -> DataFrame:
    """One row: the shortest and the longest text, the smaller or larger text winning a tie."""
    rank = F.when(F.col(value).isNotNull(), F.struct(F.length(value), F.col(value)))
    return df.agg(F.min_by(value, rank).alias("shortest"), F.max_by(value, rank).alias("longest"))


def concat_ordered(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, bytes_per_piece: int = BYTES_PER_PIECE
) -> DataFrame:
    """Concatenate ``value`` per key in ``order``, as numbered pieces of about ``bytes_per_piece``.

    A row goes to the piece that the bytes of its key before it give, so a piece is longer than the limit by
    one row at most, and a short text is the single piece 0. Null keys are a key. A key of any size is
    spread over many tasks; its pieces in order make up the whole text, which one cell could not hold.

    Rows are range-sorted and written down. Each task adds up bytes within its range; only the first key of
    a range can go on from ranges before, so one offset for each range completes them.
    """
    place = [F.col(c) for c in (*keys, *order)]
    slots = in_slots(df.select(*keys, *order, value), [*place, F.xxhash64(value)]).withColumn("_size", F.coalesce(F.octet_length(value), F.lit(0)).cast("bigint"))
    group = Window.partitionBy("_part", *keys)
    parts = slots.groupBy("_part", *keys).agg(F.sum("_size").alias("_size"), F.min("_slot").alias("_first"))
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.withColumn("_offset", F.sum("_size").over(earlier)).where("_offset is not null")
    # at most one row for each range
    offsets = offsets.select(F.col("_part").alias("_of"), "_offset", F.col("_first").alias("_from"))
    running = F.sum("_size").over(group.orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1))
    head = F.first("_slot").over(group.orderBy("_slot"))
    counted = slots.withColumns({"_before": F.coalesce(running, F.lit(0)), "_head": head})
    same = (F.col("_part") == F.col("_of")) & (F.col("_head") == F.col("_from"))
    placed = counted.join(F.broadcast(offsets), same, "left")
    before = F.col("_before") + F.coalesce("_offset", F.lit(0))
    text = F.expr(f"listagg(`{value}`, '') WITHIN GROUP (ORDER BY _slot)")
    pieces = placed.withColumn("piece", F.floor(before / bytes_per_piece).cast("bigint"))
    return pieces.groupBy(*keys, "piece").agg(text.alias(value))


def count_where(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """One row with the number of rows that meet each condition, in a single pass."""
    return df.agg(*[F.count_if(condition).alias(name) for name, condition in conditions.items()])


def observe_counts(df: DataFrame, name: str, conditions: Mapping[str, Column]) -> tuple[DataFrame, Observation]:
    """Counters that ride along with whatever is done with ``df``; read them after its action."""
    seen = Observation(name)
    return df.observe(seen, *[F.count_if(c).alias(k) for k, c in conditions.items()]), seen


def mean_and_deviation(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row per column: its mean and sample standard deviation, from one pass."""
    row = df.agg(*[F.struct(F.avg(c).alias("mean"), F.stddev_samp(c).alias("deviation")).alias(c) for c in cols])
    named = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("s")) for c in cols])
    return row.select(F.explode(named).alias("e")).select("e.name", "e.s.mean", "e.s.deviation")


def _one_pass(df: DataFrame, labels: Sequence[tuple], values: Sequence[Column], names: Sequence[str]) -> DataFrame:
    """One aggregate per label in a single pass, then one row per label."""
    row = df.agg(*[value.alias(f"_{i}") for i, value in enumerate(values)])
    entries = [
        F.struct(*[F.lit(part).alias(name) for part, name in zip(label, names)], F.col(f"_{i}").alias("value"))
        for i, label in enumerate(labels)
    ]
    return row.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def correlation(left: str, right: str) -> Column:
    """Pearson correlation over the rows that have both values; null where either never varies.

    (The built-in ``corr`` ends the query with a division by zero there.)
    """
    x = F.when(F.col(right).isNotNull(), F.col(left))
    y = F.when(F.col(left).isNotNull(), F.col(right))
    return F.covar_pop(x, y) / F.nullif(F.stddev_pop(x) * F.stddev_pop(y), F.lit(0.0))


def correlation_report(df: DataFrame, target: str, cols: Sequence[str]) -> DataFrame:
    """Correlation of ``target`` with each column: one job for all columns."""
    result = _one_pass(df, [(c,) for c in cols], [correlation(target, c) for c in cols], ["name"])
    return result.withColumnRenamed("value", "correlation")


def covariance_report(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Sample covariance of each pair of columns, the upper triangle with the diagonal."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    result = _one_pass(df, pairs, [F.covar_samp(a, b) for a, b in pairs], ["left", "right"])
    return result.withColumnRenamed("value", "covariance")


def above_mean(df: DataFrame, col: str) -> DataFrame:
    """Rows whose ``col`` lies above its mean over all rows, which the plan computes as a subquery."""
    return df.where(F.col(col) > df.agg(F.avg(col)).scalar())


def confusion_matrix(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.groupBy(label, prediction).agg(F.count("*").alias("n"))


def accuracy(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: the share of rows whose prediction equals the label."""
    return df.agg(F.avg((F.col(label) == F.col(prediction)).cast("double")).alias("accuracy"))


def r_squared(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: 1 - squared error / squared deviation from the mean; null for a constant label."""
    gap = F.col(label) - F.col(prediction)
    return df.agg((1 - F.avg(gap * gap) / F.nullif(F.var_pop(label), F.lit(0.0))).alias("r2"))
