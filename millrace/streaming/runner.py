"""Running streaming queries with a checkpoint in the shared folder."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from millrace.streaming.ledger import Batch, listening
from millrace.workspace import new_folder

# State beyond the memory of an executor spills to its disk; changes are saved in the checkpoint folder.
_STATE_STORE = (
    "spark.sql.streaming.stateStore.providerClass",
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
)

_END_OF_TIME = "9999-01-01T00:00:00Z"


@contextmanager
def _spilling_state(spark: SparkSession) -> Iterator[None]:
    """Choose the state store for queries started inside; the session is left as it was."""
    key, value = _STATE_STORE
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def _start(spark: SparkSession, writer: DataStreamWriter) -> StreamingQuery:
    with _spilling_state(spark):
        return writer.start()


def run_continuously(
    df: DataFrame, path: str, checkpoint: str, every: str = "3 seconds", output_mode: str = "append"
) -> StreamingQuery:
    """Start a query that appends its results to the Parquet folder ``path``; the caller stops it."""
    writer = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return _start(df.sparkSession, writer.outputMode(output_mode).trigger(processingTime=every))


def run_available(df: DataFrame, each_batch: Callable[[DataFrame, int], None], checkpoint: str) -> list[Batch]:
    """Hand all data that is there now to ``each_batch``, one micro-batch after the other; what each has read."""
    writer = df.writeStream.foreachBatch(each_batch).option("checkpointLocation", checkpoint)
    with listening(df.sparkSession) as ledger:
        query = _start(df.sparkSession, writer.trigger(availableNow=True))
        query.awaitTermination()
        return ledger.batches(query)


def append_available(df: DataFrame, path: str, checkpoint: str) -> list[Batch]:
    """Append the results of all data that is there now to the Parquet folder ``path``; what each micro-batch has read.

    Called again with the same ``checkpoint`` it goes on where it ended. A micro-batch that is repeated is not
    written twice.
    """
    writer = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    with listening(df.sparkSession) as ledger:
        query = _start(df.sparkSession, writer.trigger(availableNow=True))
        query.awaitTermination()
        return ledger.batches(query)


def span_of(table: DataFrame, time: str) -> str:
    """A delay as long as the whole time that a bounded table spans: no order of its rows makes one late."""
    first, last = table.agg(F.min(F.unix_seconds(time)), F.max(F.unix_seconds(time))).first()
    return f"{(last or 0) - (first or 0) + 1} seconds"


def disorder_of(table: DataFrame, time: str) -> str:
    """A delay as long as the events of a table of files are out of order when its files are streamed.

    Files come by the time of their last change, and a micro-batch is made of whole files, so a row is late if an
    earlier file has rows after it by more than the delay. Files of the same time may come in any order. Each file is
    one row (its first and last time) before they are put in order in one task.
    """
    files = table.groupBy(
        F.col("_metadata.file_modification_time").alias("changed"), F.col("_metadata.file_path").alias("path")
    ).agg(F.min(F.unix_seconds(time)).alias("first"), F.max(F.unix_seconds(time)).alias("last"))
    alike = files.groupBy("changed").agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.count("*").alias("n")
    )
    before = F.max("last").over(Window.orderBy("changed").rowsBetween(Window.unboundedPreceding, -1))
    latest = F.greatest(before, F.when(F.col("n") > 1, F.col("last")))
    late = alike.select((latest - F.col("first")).alias("late")).agg(F.max("late")).first()[0]
    return f"{max(late or 0, 0) + 1} seconds"


def drain_windows(events: DataFrame, time: str, counts: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Run windowed ``counts`` over all events there are now and return every window.

    The counts are written in append mode, which holds back the windows that the watermark has not
    passed. So once the events are through, the same query is resumed from its checkpoint with one
    marker event at the end of time: it closes all windows but its own, which is never written.
    The counts need a delay that covers the disorder of the events (``disorder_of`` measures it, ``span_of`` covers any); if an event was
    late all the same, the call fails instead of returning a part.
    """
    spark = events.sparkSession
    markers, path, checkpoint = (new_folder(spark, label) for label in ("markers", "windows", "checkpoint"))
    nobody = [F.lit(None).cast(field.dataType).alias(field.name) for field in events.schema if field.name != time]
    marker = spark.range(1, numPartitions=1).select(F.to_timestamp(F.lit(_END_OF_TIME)).alias(time), *nobody)
    marker = marker.select(*events.columns)
    marker.where(F.lit(False)).write.parquet(markers)

    windows = counts(events.unionByName(spark.readStream.schema(marker.schema).parquet(markers)))

    def run() -> None:
        writer = windows.writeStream.format("parquet").option("path", path)
        writer = writer.option("checkpointLocation", checkpoint).outputMode("append")
        query = _start(spark, writer.trigger(availableNow=True))
        query.awaitTermination()
        late = sum(batch.rows_late for batch in ledger.batches(query))
        if late:
            raise RuntimeError(f"{late} rows were later than the watermark allows: choose a longer delay")

    with listening(spark) as ledger:
        run()
        marker.write.mode("append").parquet(markers)
        run()
    return spark.read.schema(windows.schema).parquet(path)
