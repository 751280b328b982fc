"""Mixing sources to target weights.

Every document gets a hash-random key. Documents are range-sorted by source and key, the prefix sums
of their word counts are added up over the ranges, and each source is cut at its exact budget of words:
so many whole passes over the source, and then documents in key order until the budget is used up, the
last of them in part. All of it is DataFrame operations.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.workspace import materialize

WORD = r"[^\x20\x09-\x0D]+"
# monotonically_increasing_id keeps the partition above the lower 33 bits
_ROW_BITS = 33


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("bigint"), F.lit(0).cast("bigint"))


def source_targets(
    sizes: DataFrame, weights: Sequence[int], share_percent: int, most_times: int
) -> DataFrame:
    """The words to take from each source: ``source``, ``source_size``, ``target``, ``budget``.

    Sources in code point order, null last, weigh ``weights``, repeating, and share ``share_percent`` of all
    words. No target exceeds ``most_times`` its source; what is above is shared again by weight. That
    sharing ends where every source not at its limit has the same target for each unit of weight,
    which needs one pass over the sources in the order in which they meet their limits.
    ``sizes`` has one row for each source; only that list, not the documents, goes through one window.
    """
    if share_percent > 100 * most_times:
        raise ValueError("the share cannot be met within the limit")
    named = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    cycle = F.array(*[F.lit(w).cast("bigint") for w in weights])
    by_limit = Window.orderBy(F.col("limit") / F.col("weight"), F.col("rank"))
    everything = Window.partitionBy(F.lit(0))
    ranked = sizes.select(
        "source",
        "source_size",
        named.alias("rank"),
        (F.col("source_size") * most_times).alias("limit"),
    ).withColumn("weight", F.get(cycle, (F.col("rank") - 1) % len(weights)))
    before = Window.orderBy(F.col("limit") / F.col("weight"), F.col("rank")).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    walked = ranked.select(
        "*",
        F.coalesce(F.sum("limit").over(before), zero).alias("limits_before"),
        F.coalesce(F.sum("weight").over(before), zero).alias("weight_before"),
        F.sum("weight").over(everything).alias("weight_all"),
        (F.sum("source_size").over(everything) * share_percent).alias("share"),
        F.row_number().over(by_limit).alias("place"),
    )
    # hundredths of words, shared by the sources from this one on
    left = F.col("share") - 100 * F.col("limits_before")
    weight_left = F.col("weight_all") - F.col("weight_before")
    stops = 100 * F.col("limit") * weight_left <= F.col("weight") * left
    met = walked.select("*", left.alias("left"), weight_left.alias("weight_left"), stops.alias("stops"))
    first_open = F.min(F.when(~F.col("stops"), F.struct("place", "left", "weight_left"))).over(everything)
    opened = met.withColumn("open", first_open)
    shared = F.col("weight") * F.col("open.left")
    stopped = F.col("open").isNull() | (F.col("place") < F.col("open.place"))
    hundreds = 100 * F.col("open.weight_left")
    return opened.select(
        "source",
        "source_size",
        F.when(stopped, F.col("limit").cast("double"))
        .otherwise(shared.cast("double") / hundreds.cast("double"))
        .alias("target"),
        F.when(stopped, F.col("limit")).otherwise(F.expr("weight * open.left div (100 * open.weight_left)")).alias("budget"),
    )


def mix(
    docs: DataFrame,
    id_col: str,
    text_col: str,
    source_col: str,
    *,
    weights: Sequence[int] = (5, 2, 1),
    share_percent: int = 150,
    most_times: int = 2,
    columns: Sequence[str] = (),
) -> DataFrame:
    """How many words the mix takes from every document.

    Returns ``doc_id``, the named ``columns``, ``source``, ``size``, ``source_size``, ``target``, ``taken``. The
    result is the same at every run. A source's documents are used in the order of the MD5 of their
    id; no document is used more than once above another of its source, so none exceeds ``most_times`` its size.

    Defined results: null text has no words; null is a source like any other, the last; a document with
    a null id counts as one with an empty id; rows that repeat an id are separate documents, ordered by a
    hash of their text. Documents without words take nothing. An empty table gives an empty result.
    """
    extra = [F.col(c) for c in columns]
    sized = docs.select(
        F.col(id_col).alias("doc_id"),
        *extra,
        F.col(source_col).alias("source"),
        word_count(F.col(text_col)).alias("size"),
        F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit(""))).alias("_key"),
        F.xxhash64(text_col).alias("_tie"),
    )
    order = [F.col("source").asc_nulls_last(), F.col("_key"), F.col("doc_id"), F.col("_tie")]
    slots = materialize(
        sized.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_slot", F.monotonically_increasing_id()),
        "mixing",
    )
    slots = slots.withColumn("_part", F.shiftright("_slot", _ROW_BITS))
    in_part = slots.groupBy("source", "_part").agg(F.sum("size").alias("_part_size"))
    earlier = Window.partitionBy("source").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = in_part.select(
        F.col("source").alias("_source"),
        F.col("_part").alias("_of"),
        F.coalesce(F.sum("_part_size").over(earlier), F.lit(0)).alias("_offset"),
    )
    sizes = in_part.groupBy("source").agg(F.sum("_part_size").alias("source_size"))
    targets = source_targets(sizes, weights, share_percent, most_times)
    # one row for each source and range, so at most ranges + sources rows
    plan = offsets.join(targets, F.col("_source").eqNullSafe(F.col("source"))).drop("source")
    here = Window.partitionBy("source", "_part").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    summed = slots.withColumn("_here", F.coalesce(F.sum("size").over(here), F.lit(0)))
    joined = summed.join(plan, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_part") == F.col("_of")))
    passes = F.expr("case when source_size > 0 then budget div source_size else 0 end")
    rest = F.col("budget") - passes * F.col("source_size") - F.col("_offset") - F.col("_here")
    zero = F.lit(0).cast("bigint")
    taken = passes * F.col("size") + F.least(F.greatest(rest, zero), F.col("size"))
    return joined.select("doc_id", *extra, "source", "size", "source_size", "target", taken.alias("taken"))


def mix_sql(table: str = "documents") -> str:
    """The same for DuckDB, with the defaults of ``mix``."""
    return rf"""
    WITH sized AS (
        SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS key,
            coalesce(len(regexp_extract_all(text, '{WORD}')), 0) AS size
        FROM {table}
    ),
    sizes AS (SELECT source, sum(size) AS source_size FROM sized GROUP BY source),
    ranked AS (
        SELECT source, source_size, 2 * source_size AS cap,
            [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
        FROM sizes
    ),
    walked AS (
        SELECT *, row_number() OVER o AS place,
            sum(source_size) OVER () * 150 - 100 * coalesce(sum(cap) OVER b, 0) AS rest,
            sum(weight) OVER () - coalesce(sum(weight) OVER b, 0) AS weights
        FROM ranked
        WINDOW o AS (ORDER BY cap / weight, source NULLS LAST),
            b AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    ),
    opened AS (SELECT min(place) AS open FROM walked WHERE NOT 100 * cap * weights <= weight * rest),
    level AS (SELECT open, rest, weights FROM opened LEFT JOIN walked ON place = open),
    targets AS (
        SELECT source, source_size,
            CASE WHEN open IS NULL OR place < open THEN CAST(cap AS DOUBLE)
                ELSE CAST(weight * l.rest AS DOUBLE) / CAST(100 * l.weights AS DOUBLE) END AS target,
            CASE WHEN open IS NULL OR place < open THEN cap ELSE (weight * l.rest) // (100 * l.weights) END AS budget
        FROM walked CROSS JOIN level l
    ),
    summed AS (
        SELECT *, coalesce(sum(size) OVER (
            PARTITION BY source ORDER BY key, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING
        ), 0) AS earlier
        FROM sized
    )
    SELECT doc_id, size, CAST(source_size AS BIGINT) AS source_size, target, s.source,
        CAST(CASE WHEN source_size > 0 THEN (budget // source_size) * size
            + least(greatest(budget - (budget // source_size) * source_size - earlier, 0), size) ELSE 0 END AS BIGINT) AS taken
    FROM summed s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
    """
