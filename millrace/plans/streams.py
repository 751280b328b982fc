"""Streams: the tables are read as a stream that ends, and the answer must equal that of a batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.plans.registry import Tables, query
from millrace.plans.rows import FIELDS_SQL
from millrace.sources import write_text
from millrace.streaming import (
    append_available,
    as_table,
    count_per_batch,
    disorder_of,
    drain_windows,
    run_available,
    running_counts,
    sliding_counts,
    stream_growing_lines,
    stream_parquet,
    tumbling_counts,
    utc_instant,
    words_of,
)
from millrace.workspace import new_folder

# a micro-batch takes about so much of a table
BYTES_PER_TRIGGER = 8 << 30


@query(
    "stream_wordcount",
    f"""SELECT word, count(*) AS n
        FROM (SELECT unnest({FIELDS_SQL.format(col='text', sep=' ')}) AS word FROM documents) GROUP BY word""",
)
def stream_wordcount(t: Tables) -> DataFrame:
    counts, checkpoint = new_folder(t.spark, "word-counts"), new_folder(t.spark, "checkpoint")
    documents = stream_parquet(t.spark, t.path("documents"), bytes_per_trigger=BYTES_PER_TRIGGER)
    words = words_of(documents.select("text"), "text")
    run_available(words, count_per_batch("word", counts), checkpoint)
    return t.spark.read.parquet(counts).groupBy("word").agg(F.sum("n").alias("n"))


def _events(t: Tables) -> DataFrame:
    events = stream_parquet(t.spark, t.path("events"), bytes_per_trigger=BYTES_PER_TRIGGER)
    return events.select(utc_instant("ts").alias("ts"), "event_type")


def _delay(t: Tables) -> str:
    return disorder_of(t.events.withColumn("ts", utc_instant("ts")), "ts")


def _by_start(windows: DataFrame) -> DataFrame:
    return windows.select(F.unix_seconds("window.start").alias("start"), "event_type", "n")


@query(
    "stream_tumbling",
    """SELECT CAST(floor(epoch(ts) / 3) AS BIGINT) * 3 AS start, event_type, count(*) AS n
       FROM events GROUP BY 1, 2""",
)
def stream_tumbling(t: Tables) -> DataFrame:
    delay = _delay(t)
    counts = lambda e: tumbling_counts(e, "ts", "event_type", "3 seconds", delay)
    return _by_start(drain_windows(_events(t), "ts", counts))


_SLIDING_SQL = """SELECT CAST(floor(epoch(ts) / 3) AS BIGINT) * 3 - 3 * k AS start, event_type, count(*) AS n
                  FROM events, range(5) AS steps(k) GROUP BY 1, 2"""


@query("stream_sliding", _SLIDING_SQL)
def stream_sliding(t: Tables) -> DataFrame:
    delay = _delay(t)
    counts = lambda e: sliding_counts(e, "ts", "event_type", "15 seconds", "3 seconds", delay)
    return _by_start(drain_windows(_events(t), "ts", counts))


@query("stream_sliding_by_slide", _SLIDING_SQL)
def stream_sliding_by_slide(t: Tables) -> DataFrame:
    delay = _delay(t)
    counts = lambda e: sliding_counts(e, "ts", "event_type", "15 seconds", "3 seconds", delay, by_slide=True)
    return _by_start(drain_windows(_events(t), "ts", counts))


# bytes of each file that the first runs read of it, before the last one reads the rest
LINE_STOPS = (100_000, 350_000)


@query(
    "stream_growing_lines",
    r"""SELECT doc_id, CAST(1 AS BIGINT) AS times,
               CAST(length(replace(replace(coalesce(text, ''), chr(10), ' '), chr(13), ' ')) AS BIGINT) AS n_chars
        FROM documents""",
)
def stream_growing_lines_resumed(t: Tables) -> DataFrame:
    """The documents as lines, streamed with two stops in the middle of the files: how often each line has come."""
    folder, out, checkpoint = (new_folder(t.spark, label) for label in ("line-files", "lines", "checkpoint"))
    text = F.translate(F.coalesce("text", F.lit("")), "\n\r", "  ")
    write_text(t.documents.select(F.concat_ws("\t", F.col("doc_id").cast("string"), text).alias("value")), folder)
    for stop in (*LINE_STOPS, None):
        append_available(stream_growing_lines(t.spark, folder, upto_bytes=stop), out, checkpoint)
    lines = t.spark.read.parquet(out)
    parts = F.split("value", "\t", 2)
    by_line = lines.groupBy("file", "position", "value").agg(F.count("*").alias("times"))
    return by_line.select(F.get(parts, F.lit(0)).cast("bigint").alias("doc_id"), "times", F.length(F.get(parts, F.lit(1))).cast("bigint").alias("n_chars"))


BATCHES = 5


@query(
    "stream_batches",
    f"""SELECT doc_id % {BATCHES} AS batch_id, count(*) AS rows_read, CAST(0 AS BIGINT) AS rows_late
        FROM documents WHERE doc_id >= 0 GROUP BY 1""",
)
def stream_batches(t: Tables) -> DataFrame:
    """The documents arrive in five lots, and the stream is resumed for each: the rows of every micro-batch."""
    folder, out, checkpoint = (new_folder(t.spark, label) for label in ("lots", "words", "checkpoint"))
    ids = t.documents.where("doc_id >= 0").select("doc_id")
    ids.where(F.lit(False)).write.parquet(folder)
    found = []
    for lot in range(BATCHES):
        ids.where(F.col("doc_id") % BATCHES == lot).write.mode("append").parquet(folder)
        found += append_available(stream_parquet(t.spark, folder), out, checkpoint)
    return as_table(t.spark, found).select("batch_id", "rows_read", "rows_late")


@query("stream_sliding_running", _SLIDING_SQL)
def stream_sliding_running(t: Tables) -> DataFrame:
    delay = _delay(t)
    return drain_windows(_events(t), "ts", lambda e: running_counts(e, "ts", "event_type", 15, 3, delay))
