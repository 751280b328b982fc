import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from millrace import streaming as S
from millrace.workspace import new_folder

EPOCH = dt.datetime(2024, 1, 1)


def moment(second):
    return EPOCH + dt.timedelta(seconds=second)


@pytest.fixture
def events(spark, rows, tmp_path):
    """A stream over three files whose events are not in time order."""
    folder = str(tmp_path / "events")
    data = [(moment(s), "ab"[s % 3 == 0]) for s in (0, 1, 2, 3, 4, 14, 15, 31, 30, 7, 7, 7)]
    for part in (data[6:], data[:3], data[3:6]):
        rows(part, "ts timestamp_ntz, kind string").coalesce(1).write.mode("append").parquet(folder)
    stream = S.stream_parquet(spark, folder).select(S.utc_instant("ts").alias("ts"), "kind")
    return stream, spark.read.parquet(folder).select(S.utc_instant("ts").alias("ts"), "kind")


def starts(df):
    return df.select(F.unix_seconds("window.start").alias("s"), "kind", "n")


def test_tumbling_windows_equal_batch(events, values):
    stream, batch = events
    expected = batch.groupBy(F.window("ts", "3 seconds"), "kind").agg(F.count("*").alias("n"))
    result = S.drain_windows(stream, "ts", lambda e: S.tumbling_counts(e, "ts", "kind", "3 seconds", "1 minute"))
    assert values(starts(result)) == values(starts(expected))
    assert result.agg(F.sum("n")).first()[0] == 12


@pytest.mark.parametrize("by_slide", [False, True])
def test_sliding_windows_equal_batch(events, values, by_slide):
    stream, batch = events
    expected = batch.groupBy(F.window("ts", "15 seconds", "3 seconds"), "kind").agg(F.count("*").alias("n"))
    result = S.drain_windows(
        stream, "ts", lambda e: S.sliding_counts(e, "ts", "kind", "15 seconds", "3 seconds", "1 minute", by_slide=by_slide)
    )
    assert values(starts(result)) == values(starts(expected))
    assert result.agg(F.sum("n")).first()[0] == 12 * 5


def test_windows_of_no_events(spark, rows, tmp_path):
    folder = str(tmp_path / "events")
    rows([], "ts timestamp_ntz, kind string").write.parquet(folder)
    stream = S.stream_parquet(spark, folder).select(S.utc_instant("ts").alias("ts"), "kind")
    result = S.drain_windows(stream, "ts", lambda e: S.tumbling_counts(e, "ts", "kind", "3 seconds", "1 minute"))
    assert result.count() == 0 and result.columns == ["window", "kind", "n"]


def test_instants_do_not_depend_on_the_session_zone(spark, rows):
    df = rows([(EPOCH,)], "ts timestamp_ntz")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for name in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", name)
            assert df.select(F.unix_seconds(S.utc_instant("ts"))).first()[0] == 1704067200
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_words_are_counted_per_batch_and_once_after_a_restart(spark, rows, values, tmp_path):
    folder, counts, checkpoint = str(tmp_path / "lines"), new_folder(spark, "counts"), new_folder(spark, "checkpoint")

    def arrive(*lines):
        rows([(line,) for line in lines], "value string").coalesce(1).write.mode("append").text(folder)
        S.run_available(S.words_of(S.stream_text(spark, folder)), S.count_per_batch("word", counts), checkpoint)

    arrive("the Da Vinci Code", "the  end ")
    arrive("the code")
    S.run_available(S.words_of(S.stream_text(spark, folder)), S.count_per_batch("word", counts), checkpoint)
    batches = spark.read.parquet(counts)
    assert values(batches.where("batch = 1"), "word", "n") == [("code", 1), ("the", 1)]
    totals = batches.groupBy("word").agg(F.sum("n").alias("n"))
    assert values(totals) == [("", 1), ("Code", 1), ("Da", 1), ("Vinci", 1), ("code", 1), ("end", 1), ("the", 3)]


def test_a_repeated_batch_replaces_its_counts(spark, rows, values):
    path = new_folder(spark, "counts")
    write = S.count_per_batch("word", path)
    batch = rows([("a",), ("a",), ("b",)], "word string")
    write(batch, 0)
    write(batch, 0)
    assert values(spark.read.parquet(path), "word", "n") == [("a", 2), ("b", 1)]


def test_continuous_query_starts_and_stops(spark, events, values):
    stream, batch = events
    path, checkpoint = new_folder(spark, "out"), new_folder(spark, "checkpoint")
    query = S.run_continuously(stream, path, checkpoint, every="1 second")
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert not query.isActive
    assert values(spark.read.parquet(path)) == values(batch)


def test_the_state_store_choice_does_not_leak(spark, events):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    S.drain_windows(events[0], "ts", lambda e: S.tumbling_counts(e, "ts", "kind", "3 seconds", "1 minute"))
    assert spark.conf.get(key) == before


def test_socket_source_is_a_stream_of_lines(spark):
    lines = S.socket_lines(spark, "localhost", 9)
    assert lines.isStreaming and lines.columns == ["value"]


def test_single_file_streams(spark, rows, values, tmp_path):
    folder = str(tmp_path / "t.parquet")
    rows([(i,) for i in range(5)], "v long").coalesce(1).write.parquet(folder)
    (file,) = spark.read.parquet(folder).inputFiles()
    seen = new_folder(spark, "seen")
    for path in (folder, file):
        out = f"{seen}-{len(path)}"
        S.run_available(S.stream_parquet(spark, path), lambda b, i, o=out: b.write.mode("append").parquet(o), f"{out}-c")
        assert values(spark.read.parquet(out)) == [(i,) for i in range(5)]


def test_print_first_shows_a_bounded_part_of_each_batch(spark, events, capsys):
    S.run_available(events[0].select("kind"), S.print_first(3), new_folder(spark, "checkpoint"))
    shown = capsys.readouterr().out
    assert "only showing top 3 rows" in shown


@pytest.mark.parametrize("delay, complete", [(None, True), ("0 seconds", False)])
def test_files_out_of_order_lose_no_event_or_fail(spark, rows, tmp_path, delay, complete):
    folder = str(tmp_path / "events")
    for second in (30, 3, 21, 0, 12, 40):
        part = [(moment(second), "a"), (moment(second + 1), "b")]
        rows(part, "ts timestamp_ntz, kind string").coalesce(1).write.mode("append").parquet(folder)
    batch = spark.read.parquet(folder).select(S.utc_instant("ts").alias("ts"))
    delay = delay or S.span_of(batch, "ts")
    stream = S.stream_parquet(spark, folder, files_per_trigger=1).select(S.utc_instant("ts").alias("ts"), "kind")
    run = lambda: S.drain_windows(stream, "ts", lambda e: S.tumbling_counts(e, "ts", "kind", "3 seconds", delay))
    if complete:
        assert run().agg(F.sum("n")).first()[0] == 12
    else:
        with pytest.raises(RuntimeError, match="later than the watermark"):
            run()


def test_the_disorder_of_files_is_that_of_their_times(spark, rows, tmp_path):
    """Files of one time may come in any order; a file may reach back behind the files before it."""
    folder = tmp_path / "events"

    def arrive(changed, *lots):
        known = {*folder.rglob("*.parquet")}
        for lot in lots:
            rows([(moment(s),) for s in lot], "ts timestamp_ntz").coalesce(1).write.mode("append").parquet(str(folder))
        for file in {*folder.rglob("*.parquet")} - known:
            os.utime(file, (changed, changed))

    def delay():
        return S.disorder_of(spark.read.parquet(str(folder)).withColumn("ts", S.utc_instant("ts")), "ts")

    arrive(1_000, [0, 9, 4])
    assert delay() == "1 seconds"
    arrive(2_000, [10, 50])
    assert delay() == "1 seconds"
    arrive(3_000, [43])
    assert delay() == "8 seconds"
    arrive(4_000, [60, 70], [61, 90])
    assert delay() == "31 seconds"


def test_windows_with_the_measured_delay_lose_nothing(spark, events, values, tmp_path):
    stream, batch = events
    delay = S.disorder_of(batch, "ts")
    expected = batch.groupBy(F.window("ts", "3 seconds"), "kind").agg(F.count("*").alias("n"))
    result = S.drain_windows(stream, "ts", lambda e: S.tumbling_counts(e, "ts", "kind", "3 seconds", delay))
    assert values(starts(result)) == values(starts(expected))
