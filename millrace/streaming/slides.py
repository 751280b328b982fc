"""Sliding counts that are kept up to date slide by slide.

A window's count is the one before it plus the slide that comes in, minus the slide that leaves. The state of a key is
therefore the counts of its slides in the current window and their sum, however many windows a slide belongs to. An
event-time timer stands at the end of the next window, so windows are written when the watermark has passed their
ends, whether or not the key has new events.

Time is cut into stretches of many slides, and a key has a state for each stretch, so windows of one key are counted by many
tasks. Slides shortly before a stretch ends belong to windows of both sides and go to both.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructField, StructType

from millrace.streaming.counts import tumbling_counts

_SLIDES = "start bigint, n bigint"
_WINDOW = Row("key", "start_ms", "n")

# slides of a stretch, and the fewest sizes of a window in it
SLIDES_PER_STRETCH = 10_000
SIZES_PER_STRETCH = 10


class RunningWindow(StatefulProcessor):
    """Slides of one key (``start`` in milliseconds, ``n``) in, windows (``key``, ``start_ms``, ``n``) out.

    With ``stretch_ms`` the second part of a key is the number of a stretch, and only windows that start in it are put out.
    """

    def __init__(self, size_ms: int, slide_ms: int, stretch_ms: int | None = None) -> None:
        self.size, self.slide, self.stretch = size_ms, slide_ms, stretch_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # those that have been added: the slides of the last window written; and those still to come
        self.inside = handle.getListState("inside", _SLIDES)
        self.waiting = handle.getListState("waiting", _SLIDES)
        # the end of the last window written, and its count
        self.last = handle.getValueState("last", "window_end bigint, total bigint")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        new = [(r["start"], r["n"]) for r in rows]
        if new:
            self.waiting.appendList(new)
            self.handle.registerTimer(min(start for start, _ in new) + self.slide)
        yield from ()

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        inside = deque(sorted(tuple(x) for x in self.inside.get()) if self.inside.exists() else [])
        waiting = deque(sorted(tuple(x) for x in self.waiting.get()) if self.waiting.exists() else [])
        end, total = tuple(self.last.get()) if self.last.exists() else (None, 0)
        closed = timerValues.getCurrentWatermarkInMs()
        while inside or waiting:
            # the next window that holds anything
            following = end + self.slide if inside else waiting[0][0] + self.slide
            if following > closed:
                self.handle.registerTimer(following)
                break
            end = following
            while waiting and waiting[0][0] < end:
                inside.append(waiting.popleft())
                total += inside[-1][1]
            while inside and inside[0][0] < end - self.size:
                total -= inside.popleft()[1]
            start = end - self.size
            if inside and (self.stretch is None or start // self.stretch == key[1]):
                yield _WINDOW(key[0], start, total)
        self._keep(inside, waiting, end, total)

    def _keep(self, inside: deque[tuple], waiting: deque[tuple], end: int | None, total: int) -> None:
        for state, rows in ((self.inside, inside), (self.waiting, waiting)):
            if rows:
                state.put(list(rows))
            else:
                state.clear()
        if inside:
            self.last.update((end, total))
        else:
            self.last.clear()

    def close(self) -> None:
        pass


def running_counts(
    events: DataFrame, time: str, key: str, size_seconds: int, slide_seconds: int, delay: str
) -> DataFrame:
    """``key`` counts per window of ``size_seconds`` that starts every ``slide_seconds``, like ``sliding_counts``.

    Events are counted per slide first, which happens in the JVM; the windows are then kept per key by adding and
    removing slides. Returns ``start`` (seconds), ``key`` and ``n``. The size must be a multiple of the slide. Events with
    a null time belong to no window; a null key is a key.
    """
    if size_seconds % slide_seconds:
        raise ValueError("the size must be a multiple of the slide")
    slides = tumbling_counts(events, time, key, f"{slide_seconds} seconds", delay)
    timed = slides.select(
        F.window_time("window").alias("_time"), key, (F.unix_seconds("window.start") * 1000).alias("start"), "n"
    )
    kind = StructField("key", events.schema[key].dataType)
    out = StructType([kind, *StructType.fromDDL("start_ms bigint, n bigint").fields])
    size, slide = size_seconds * 1000, slide_seconds * 1000
    stretch = max(SLIDES_PER_STRETCH * slide, SIZES_PER_STRETCH * size)
    # the stretches in which the first and the last window of a slide start
    first, last = (F.floor(at / stretch) for at in (F.col("start") - (size - slide), F.col("start")))
    timed = timed.withColumn("_stretch", F.explode(F.array_distinct(F.array(first, last))))
    processor = RunningWindow(size, slide, stretch)
    windows = timed.groupBy(key, "_stretch").transformWithState(processor, out, "Append", "EventTime")
    return windows.select((F.col("start_ms") / 1000).cast("bigint").alias("start"), F.col("key").alias(key), "n")
