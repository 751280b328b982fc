"""Counts over streams: per micro-batch, and per tumbling or sliding event-time window."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from millrace.functions import split_fields


def words_of(lines: DataFrame, col: str = "value", sep: str = " ") -> DataFrame:
    """One row per word, in the column ``word``."""
    return lines.select(F.explode(split_fields(F.col(col), sep)).alias("word"))


def count_per_batch(key: str, path: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: count ``key`` within each micro-batch, with no state between them.

    Each batch owns the folder ``batch=<id>`` and replaces it when it is run again, so a batch that is
    retried after a failure is not counted twice.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        counts = batch.groupBy(key).agg(F.count("*").alias("n"))
        counts.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def tumbling_counts(events: DataFrame, time: str, key: str, size: str, delay: str) -> DataFrame:
    """``key`` counts per window of ``size``; a window is final once the watermark has passed its end.

    An event is late, and dropped, once a batch has seen one that is younger by more than ``delay``.
    """
    windows = events.withWatermark(time, delay).groupBy(F.window(time, size), key)
    return windows.agg(F.count("*").alias("n")).select("window", key, "n")


def sliding_counts(
    events: DataFrame, time: str, key: str, size: str, slide: str, delay: str, *, by_slide: bool = False
) -> DataFrame:
    """``key`` counts per window of ``size`` that starts every ``slide``; for ``delay`` see ``tumbling_counts``.

    With ``by_slide`` events are first counted per ``slide``, and those counts are added up into the
    windows: a second stateful step, but only counts and not events are repeated for each window.
    ``size`` must then be a multiple of ``slide``.
    """
    if not by_slide:
        windows = events.withWatermark(time, delay).groupBy(F.window(time, size, slide), key)
        return windows.agg(F.count("*").alias("n")).select("window", key, "n")
    steps = tumbling_counts(events, time, key, slide, delay)
    windows = steps.groupBy(F.window(F.window_time("window"), size, slide), key)
    return windows.agg(F.sum("n").alias("n")).select("window", key, "n")


def print_first(n: int = 10) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that shows the first ``n`` rows of each micro-batch on the driver."""
    return lambda batch, batch_id: batch.show(n, truncate=False)
