"""Splitting rows into training and test parts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.operators.joins import skew_safe_join
from millrace.operators.ordering import with_ordinal
from millrace.workspace import materialize

_HEX_DIGITS = 8
# the ranges of hashes that rows are counted in
_RANGE_DIGITS = 4


def key_in_fraction(key: Column, fraction: float) -> Column:
    """True for about ``fraction`` of all key values, always for the same ones.

    The first hex digits of the key's MD5 are compared with the same number of digits of ``fraction``.
    """
    limit = round(fraction * 16**_HEX_DIGITS)
    if limit >= 16**_HEX_DIGITS:
        return F.lit(True)
    digits = F.substring(F.md5(key.cast("string")), 1, _HEX_DIGITS)
    return digits < F.lit(f"{limit:0{_HEX_DIGITS}x}")


def split_by_key(df: DataFrame, key: str, fraction: float) -> tuple[DataFrame, DataFrame]:
    """Two parts that depend only on ``key``: the same on each run, engine and partitioning."""
    inside = key_in_fraction(F.col(key), fraction)
    return df.where(inside), df.where(~inside)


def split_at_random(df: DataFrame, weights: list[float], seed: int) -> list[DataFrame]:
    """Row-wise random parts; repeatable only while rows keep their partition and order."""
    return df.randomSplit(weights, seed)


def split_exactly(df: DataFrame, key: str, weights: Sequence[float], strata: Sequence[str] = (), name: str = "part") -> DataFrame:
    """``df`` with ``name``: 0, 1, ... for parts of exactly the sizes that ``weights`` ask for, in each stratum.

    Rows of a stratum are in the order of the MD5 of ``key``, then of ``key``. With n rows, part i ends after
    floor(n * (its weight and those before) / (all weights) + 0.5) of them, so parts depend on the rows only. A null key
    comes last, a null stratum is a stratum, and of equal keys any may come first: give a key that tells rows apart.

    The rows of a stratum are never sorted. They are counted by the first digits of their hash, which tells for each end of
    a part the one range of hashes it lies in; only rows in such a range, one of 65,536, are put in order and numbered.
    """
    if not weights or any(w < 0 for w in weights) or not sum(weights) > 0:
        raise ValueError("weights must not be negative, and one must be positive")
    # one constant stratum if there is none; strata are compared as one value in which a null equals a null
    stratum = F.struct(F.lit(0).alias("_all"), *[F.col(c) for c in strata])
    hashed = F.md5(F.col(key).cast("string"))
    # no hash begins with g: null keys are after all others
    marked = df.withColumns({"_stratum": F.to_json(stratum, {"ignoreNullFields": "false"}), "_hash": F.coalesce(hashed, F.lit("g"))})
    marked = marked.withColumn("_range", F.substring("_hash", 1, _RANGE_DIGITS))
    ranges = marked.groupBy("_stratum", "_range").agg(F.count("*").alias("_n"))
    # at most 65,537 rows for each stratum
    whole = Window.partitionBy("_stratum")
    before = F.coalesce(F.sum("_n").over(whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = ranges.withColumns({"_before": before, "_all_rows": F.sum("_n").over(whole)})
    shares = [sum(weights[: i + 1]) / sum(weights) for i in range(len(weights) - 1)]
    ends = F.array(*[F.floor(F.col("_all_rows") * share + 0.5) for share in shares]) if shares else F.array().cast("array<bigint>")
    # the parts that end at or before the range, and the ends within it as rows of the range
    passed = F.size(F.filter("_ends", lambda end: end <= F.col("_before")))
    inside = F.filter("_ends", lambda end: (end > F.col("_before")) & (end < F.col("_before") + F.col("_n")))
    limits = F.transform(inside, lambda end: end - F.col("_before"))
    ranged = placed.withColumn("_ends", ends).select("_stratum", "_range", passed.alias(name), limits.alias("_limits"))
    ranged = materialize(ranged, "split-ranges")
    # runs of ranges with one part are one row: few rows for each stratum
    crossed = ranged.where(F.size("_limits") > 0).select("_stratum", "_range", F.col(name).alias("_first"), "_limits")
    steps = ranged.where(F.size("_limits") == 0).groupBy("_stratum", name).agg(F.min("_range").alias("_from"))
    step = F.sort_array(F.collect_list(F.struct("_from", F.col(name).alias("_part"))))
    steps = steps.groupBy("_stratum").agg(step.alias("_steps"))
    cuts = crossed.groupBy("_stratum").agg(F.collect_list(F.struct("_range", "_first", "_limits")).alias("_crossed"))
    table = materialize(steps.join(cuts, "_stratum", "full"), "split-cuts")
    joined = skew_safe_join(marked, table, "_stratum", salt_by=["_hash"], how="left")
    own = F.filter("_crossed", lambda c: c["_range"] == F.col("_range"))
    found = joined.withColumn("_own", F.get(own, F.lit(0)))
    # the last step that begins at or before the range
    reached = F.filter("_steps", lambda s: s["_from"] <= F.col("_range"))
    simple = found.where("_own is null").withColumn(name, F.element_at(reached, -1)["_part"])
    # rows of the few ranges in which a part ends
    tight = found.where("_own is not null").drop("_steps", "_crossed")
    numbered = with_ordinal(tight, [F.col("_stratum"), F.col("_hash"), F.col(key), F.xxhash64(*df.columns)], "_at")
    numbered = materialize(numbered, "split-borders")
    starts = numbered.groupBy("_stratum", "_range").agg(F.min("_at").alias("_start"))
    # a row for each end of a part in each stratum
    inner = skew_safe_join(numbered, starts, ["_stratum", "_range"], salt_by=["_hash"])
    later = F.size(F.filter(F.col("_own")["_limits"], lambda end: end <= F.col("_at") - F.col("_start")))
    exact = inner.withColumn(name, F.col("_own")["_first"] + later)
    columns = [*[c for c in df.columns if c != name], name]
    return simple.select(*columns).unionByName(exact.select(*columns))

