"""The replayable source of lines, and the ledger of micro-batches."""

import random

import pytest
from millrace import streaming as S
from millrace.streaming import lines as L
from millrace.workspace import new_folder


def appended(path, data):
    path.parent.mkdir(parents=True, exist_ok=True)
    with open(path, "ab") as file:
        file.write(data)


@pytest.fixture
def run(spark, tmp_path, values):
    """Reads what there is now, and returns all lines so far as (file, position, value)."""
    out, checkpoint = new_folder(spark, "lines"), new_folder(spark, "checkpoint")

    def go(**options):
        batches = S.append_available(S.stream_growing_lines(spark, str(tmp_path / "in"), **options), out, checkpoint)
        rows = values(spark.read.schema(L.SCHEMA).parquet(out), "file", "position", "value")
        return sorted((f.rpartition("/")[2], p, v) for f, p, v in rows), batches

    return go


def test_a_file_that_grows_is_read_on_from_the_middle(tmp_path, run):
    log = tmp_path / "in/a.log"
    appended(log, b"one\ntwo\nthr")
    assert run()[0] == [("a.log", 0, "one"), ("a.log", 4, "two")]
    # nothing new, and a line that still has no end
    assert len(run()[0]) == 2
    appended(log, b"ee\n\nfour\n")
    appended(tmp_path / "in/sub/b.log", "é\n퟿\n".encode() + b"\xff\n")
    appended(tmp_path / "in/_hidden", b"no\n")
    got, _ = run()
    assert got == [("a.log", 0, "one"), ("a.log", 4, "two"), ("a.log", 8, "three"), ("a.log", 14, ""), ("a.log", 15, "four"), ("b.log", 0, "é"), ("b.log", 3, "퟿"), ("b.log", 7, "�")]


@pytest.mark.parametrize("range_bytes", [1, 7, 64, 1 << 20])
def test_ranges_of_any_length_lose_and_repeat_no_line(tmp_path, run, range_bytes, monkeypatch):
    r = random.Random(range_bytes)
    want, data = [], b""
    for _ in range(40):
        line = "".join(r.choices("abé日", k=r.choice([0, 1, 5, 30])))
        want.append(("a.log", len(data), line))
        data += line.encode() + b"\n"
    cut = r.randrange(len(data))
    appended(tmp_path / "in/a.log", data[:cut])
    run(range_bytes=range_bytes)
    appended(tmp_path / "in/a.log", data[cut:])
    got, batches = run(range_bytes=range_bytes)
    assert got == want
    assert 0 < sum(b.rows_read for b in batches) <= len(want)


def test_lines_longer_than_a_block(tmp_path):
    path = tmp_path / "x"
    data = b"a" * 50 + b"\n" + b"b" * 7 + b"\nc\n" + b"d" * 33
    path.write_bytes(data)
    reader = L.LineReader({"path": str(tmp_path), "rangeBytes": "10"})
    before, L.BLOCK_BYTES = L.BLOCK_BYTES, 4
    try:
        assert reader.latestOffset() == {str(path): 61}
        got = [x for p in reader.partitions({}, reader.latestOffset()) for b in reader.read(p) for x in zip(*b.to_pydict().values())]
    finally:
        L.BLOCK_BYTES = before
    assert [(v, p) for v, _, p in got] == [("a" * 50, 0), ("b" * 7, 51), ("c", 59)]


def test_a_file_that_has_lost_bytes_is_an_error(tmp_path):
    (tmp_path / "x").write_bytes(b"one\n")
    reader = L.LineReader({"path": str(tmp_path)})
    with pytest.raises(ValueError, match="shorter"):
        reader.partitions({str(tmp_path / "x"): 8}, reader.latestOffset())


def test_stopped_in_the_middle_of_files_and_resumed(tmp_path, run):
    data = [f"line {i}\n".encode() for i in range(500)]
    for name in "ab":
        appended(tmp_path / f"in/{name}", b"".join(data))
    first, batches = run(upto_bytes=1000)
    assert 0 < len(first) < 400 and sum(b.rows_read for b in batches) == len(first)
    got, batches = run()
    assert sorted(v for _, _, v in got) == sorted([x.decode().strip() for x in data] * 2)
    assert [b.batch_id for b in batches] == [1] and batches[0].rows_read == 1000 - len(first)


def test_no_files(tmp_path, run):
    (tmp_path / "in").mkdir()
    assert run()[0] == []


def test_the_ledger_has_every_micro_batch(spark, rows, tmp_path):
    folder = str(tmp_path / "many")
    spark.range(105).repartitionByRange(105, "id").write.parquet(folder)
    stream = S.stream_parquet(spark, folder, files_per_trigger=1)
    batches = S.append_available(stream, new_folder(spark, "out"), new_folder(spark, "checkpoint"))
    files = len(spark.read.parquet(folder).inputFiles())
    assert files > 100 and len(batches) >= files and sum(b.rows_read for b in batches) == 105
    assert S.as_table(spark, batches).agg({"rows_read": "sum"}).first()[0] == 105


def test_late_rows_of_forgotten_reports_are_seen(spark, rows, tmp_path):
    import datetime as dt

    folder, key = str(tmp_path / "events"), "spark.sql.streaming.numRecentProgressUpdates"
    for second in (500, 501, 0, 1000, 1001, 1002, 1003):
        moment = dt.datetime(2024, 1, 1) + dt.timedelta(seconds=second)
        rows([(moment, "a")], "ts timestamp_ntz, kind string").coalesce(1).write.mode("append").parquet(folder)
    stream = S.stream_parquet(spark, folder, files_per_trigger=1).select(S.utc_instant("ts").alias("ts"), "kind")
    spark.conf.set(key, "2")
    try:
        with pytest.raises(RuntimeError, match="later than the watermark"):
            S.drain_windows(stream, "ts", lambda e: S.tumbling_counts(e, "ts", "kind", "3 seconds", "0 seconds"))
    finally:
        spark.conf.unset(key)


def test_a_ledger_that_did_not_listen_says_so(spark, rows, tmp_path, monkeypatch):
    from millrace.streaming import ledger

    monkeypatch.setattr(ledger, "PATIENCE_SECONDS", 0.1)
    folder = str(tmp_path / "t")
    spark.range(3).write.parquet(folder)
    writer = S.stream_parquet(spark, folder).writeStream.format("noop").option("checkpointLocation", new_folder(spark, "c"))
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    with pytest.raises(RuntimeError, match="not reported"):
        ledger.BatchLedger().batches(query)
