"""Sliding counts that add and remove slides."""

import datetime as dt
import random
from collections import Counter

import pytest
from millrace import streaming as S

EPOCH = dt.datetime(2024, 1, 1)
BASE = 1704067200


def windows(data, size, slide):
    out = Counter()
    for second, kind in data:
        first = second - second % slide
        for k in range(size // slide):
            out[BASE + first - k * slide, kind] += 1
    return out


def streamed(spark, rows, folder, lots, size, slide, delay="1 hour", files=None):
    schema = "ts timestamp_ntz, kind string"
    rows([], schema).write.parquet(folder)
    for lot in lots:
        rows([(EPOCH + dt.timedelta(seconds=s), k) for s, k in lot], schema).coalesce(1).write.mode("append").parquet(folder)
    stream = S.stream_parquet(spark, folder, files_per_trigger=files).select(S.utc_instant("ts").alias("ts"), "kind")
    out = S.drain_windows(stream, "ts", lambda e: S.running_counts(e, "ts", "kind", size, slide, delay))
    assert out.columns == ["start", "kind", "n"]
    found = out.collect()
    got = {(r.start, r.kind): r.n for r in found}
    assert len(got) == len(found)
    return got


@pytest.mark.parametrize(("size", "slide"), [(15, 3), (6, 6), (60, 1)])
def test_all_windows(spark, rows, tmp_path, size, slide):
    r = random.Random(size)
    data = [(r.choice([r.randrange(40), r.randrange(300)]), r.choice(["a", "b", None])) for _ in range(120)]
    data += [(0, "once"), (295, "last")]
    assert streamed(spark, rows, str(tmp_path / "e"), [data[:50], data[50:]], size, slide) == windows(data, size, slide)


def test_windows_end_while_events_still_arrive(spark, rows, tmp_path):
    # in time order with a short delay: timers fire in many micro-batches, also for keys that have gone silent
    r = random.Random(3)
    data = sorted((r.randrange(200), r.choice("ab")) for _ in range(80))
    data += [(203, "c"), (204, "a")]
    lots = [data[i : i + 14] for i in range(0, len(data), 14)]
    assert streamed(spark, rows, str(tmp_path / "e"), lots, 15, 3, "30 seconds", files=1) == windows(data, 15, 3)


def test_windows_of_one_key_are_counted_in_many_states(spark, rows, tmp_path, monkeypatch):
    from millrace.streaming import slides

    # a timer of one state closes the windows of one stretch
    monkeypatch.setattr(slides, "SLIDES_PER_STRETCH", 20)
    monkeypatch.setattr(slides, "SIZES_PER_STRETCH", 2)
    made = []

    class Seen(slides.RunningWindow):
        def __init__(self, *args):
            made.append(args)
            super().__init__(*args)

    monkeypatch.setattr(slides, "RunningWindow", Seen)
    r = random.Random(8)
    data = [(s, "only") for s in [0, 59, 60, 61, 119, 120, 1000] for _ in range(2)] + [(r.randrange(2000), "only") for _ in range(100)]
    assert streamed(spark, rows, str(tmp_path / "e"), [data], 15, 3) == windows(data, 15, 3)
    assert made == [(15_000, 3_000, 60_000)]


def test_a_state_puts_out_the_windows_of_its_stretch():
    from millrace.streaming import slides

    class Nothing:
        exists = lambda self: False
        clear = lambda self: None

    class Two(Nothing):
        exists = lambda self: True
        get = lambda self: iter([(54_000, 1), (60_000, 2)])

    window = slides.RunningWindow(15_000, 3_000, 60_000)
    window.inside, window.waiting, window.last = Nothing(), Two(), Nothing()
    now = type("Now", (), {"getCurrentWatermarkInMs": lambda self: 10**15})()
    found = [[(r.start_ms, r.n) for r in window.handleExpiredTimer(("k", stretch), now, None)] for stretch in (0, 1)]
    assert found == [[(42_000, 1), (45_000, 1), (48_000, 3), (51_000, 3), (54_000, 3), (57_000, 2)], [(60_000, 2)]]


def test_no_events_and_wrong_sizes(spark, rows, tmp_path):
    assert streamed(spark, rows, str(tmp_path / "e"), [], 15, 3) == {}
    with pytest.raises(ValueError, match="multiple"):
        S.running_counts(rows([], "ts timestamp, kind string"), "ts", "kind", 10, 3, "1 second")


def test_the_state_holds_slides_and_not_windows(spark, rows, tmp_path):
    from millrace.streaming import slides

    class Handle:
        def __init__(self):
            self.lists, self.timers = {}, []

        def getListState(self, name, schema):  # noqa: N802
            return self.lists.setdefault(name, ListState())

        def getValueState(self, name, schema):  # noqa: N802
            return self.lists.setdefault(name, ValueState())

        def registerTimer(self, at):  # noqa: N802
            self.timers.append(at)

    class ListState:
        def __init__(self):
            self.rows = []

        exists = lambda self: bool(self.rows)
        get = lambda self: iter(self.rows)

        def put(self, rows):
            self.rows = list(rows)

        def appendList(self, rows):  # noqa: N802
            self.rows = self.rows + list(rows)

        def clear(self):
            self.rows = []

    class ValueState(ListState):
        get = lambda self: self.rows[0]

        def update(self, row):
            self.rows = [row]

    class Now:
        def __init__(self, at):
            self.at = at

        getCurrentWatermarkInMs = lambda self: self.at

    # windows of an hour that start every second, a slide with events every tenth second
    handle, window, out = Handle(), slides.RunningWindow(3_600_000, 1000), {}
    window.init(handle)
    most = 0
    for step in range(0, 600, 10):
        list(window.handleInputRows(("k",), [{"start": step * 1000, "n": step + 1}], Now(step * 1000)))
        for row in window.handleExpiredTimer(("k",), Now((step + 5) * 1000), None):
            out[row.start_ms] = row.n
        most = max(most, sum(len(s.rows) for s in handle.lists.values()))
    assert most <= 62 and len(out) > 580
    assert out[(595 - 3600) * 1000] == sum(s + 1 for s in range(0, 600, 10))
    # the end of time: everything leaves
    for row in window.handleExpiredTimer(("k",), Now(10**15), None):
        out[row.start_ms] = row.n
    assert out[590_000] == 591 and max(out) == 590_000
    assert not any(s.rows for s in handle.lists.values())
