"""What every micro-batch of a streaming query has read and dropped.

A query itself remembers its last 100 reports only. The ledger listens from before the query starts until it has ended, so
none goes unseen, however many micro-batches there are.
"""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from millrace.sources import inline_table

# the bus hands reports on after the query has ended
PATIENCE_SECONDS = 300


@dataclass(frozen=True)
class Batch:
    batch_id: int
    rows_read: int
    rows_late: int
    rows_in_state: int


class BatchLedger(StreamingQueryListener):
    """The micro-batches of all queries that run while it listens; see ``listening``."""

    def __init__(self) -> None:
        self._batches: dict[str, dict[int, Batch]] = {}
        self._ended: dict[str, threading.Event] = {}
        self._lock = threading.Lock()

    def _end_of(self, run: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:  # noqa: N802
        self._end_of(str(event.runId))

    def onQueryProgress(self, event) -> None:  # noqa: N802
        progress = event.progress
        states = progress.stateOperators
        told = Batch(
            progress.batchId,
            progress.numInputRows,
            sum(s.numRowsDroppedByWatermark for s in states),
            sum(s.numRowsTotal for s in states),
        )
        with self._lock:
            known = self._batches.setdefault(str(progress.runId), {})
            # a trigger that finds nothing to do reports the number of the next batch, with no rows
            before = known.get(told.batch_id)
            if before is None or before.rows_read <= told.rows_read:
                known[told.batch_id] = told

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self._end_of(str(event.runId)).set()

    def batches(self, query: StreamingQuery) -> list[Batch]:
        """All micro-batches of a run that has ended, in order; an error if any report is missing."""
        run = str(query.runId)
        if not self._end_of(run).wait(PATIENCE_SECONDS):
            raise RuntimeError("the end of the query was not reported: was the ledger listening when it started?")
        with self._lock:
            found = sorted(self._batches.get(run, {}).values(), key=lambda b: b.batch_id)
        if found and [b.batch_id for b in found] != list(range(found[0].batch_id, found[0].batch_id + len(found))):
            raise RuntimeError("reports of micro-batches are missing")
        return found


@contextmanager
def listening(spark: SparkSession) -> Iterator[BatchLedger]:
    """A ledger of the queries that start and end inside."""
    ledger = BatchLedger()
    spark.streams.addListener(ledger)
    try:
        yield ledger
    finally:
        spark.streams.removeListener(ledger)


def as_table(spark: SparkSession, batches: list[Batch]) -> DataFrame:
    """One row for each micro-batch."""
    rows = [(b.batch_id, b.rows_read, b.rows_late, b.rows_in_state) for b in batches]
    return inline_table(spark, rows, "batch_id bigint, rows_read bigint, rows_late bigint, rows_in_state bigint")
