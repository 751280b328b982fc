"""A stream of lines from files that grow, which can be read again from any point.

The position of the stream is one byte offset for each file, always at the end of a line. A micro-batch is therefore a
byte range of each file: a batch that is repeated after a failure reads the same bytes, and a query that is resumed
from its checkpoint goes on in the middle of a file. Ranges are cut into partitions whatever the lines are; a
partition has the lines that begin in it.
"""

from __future__ import annotations

import posixpath
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

SCHEMA = "value string, file string, position bigint"
RANGE_BYTES = 64 << 20
BLOCK_BYTES = 1 << 20


@dataclass
class Stretch(InputPartition):
    """The lines of ``name`` that begin from ``start`` to ``end``. At ``first`` a line begins, at ``last`` one has ended."""

    name: str
    start: int
    end: int
    first: int
    last: int


def end_of_lines(file: pa.NativeFile, low: int, high: int, block: int = BLOCK_BYTES) -> int:
    """The end of the last whole line between two offsets, or ``low`` if none ends there."""
    while high > low:
        begin = max(low, high - block)
        found = file.read_at(high - begin, begin).rfind(b"\n")
        if found >= 0:
            return begin + found + 1
        high = begin
    return low


class LineReader(DataSourceStreamReader):
    def __init__(self, options: Mapping[str, str]) -> None:
        self.path = options["path"]
        self.range_bytes = int(options.get("rangeBytes", RANGE_BYTES))
        self.upto = int(options["uptoBytes"]) if "uptoBytes" in options else None

    def _files(self) -> tuple[pafs.FileSystem, list[pafs.FileInfo]]:
        fs, folder = pafs.FileSystem.from_uri(self.path)
        found = fs.get_file_info(pafs.FileSelector(folder, recursive=True, allow_not_found=True))
        shown = lambda p: not any(x[:1] in "_." for x in posixpath.relpath(p, folder).split("/"))
        return fs, sorted((x for x in found if x.is_file and shown(x.path)), key=lambda x: x.path)

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        """Of each file the end of its last whole line; a line without its end waits until it has one."""
        fs, files = self._files()
        out = {}
        for x in files:
            size = x.size if self.upto is None else min(x.size, self.upto)
            with fs.open_input_file(x.path) as file:
                out[x.path] = end_of_lines(file, 0, size)
        return out

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        plan = []
        for name, last in sorted(end.items()):
            first = start.get(name, 0)
            if last < first and self.upto is None:
                raise ValueError(f"{name} has become shorter: it ends at byte {last} and was read to byte {first}")
            plan += [Stretch(name, at, min(at + self.range_bytes, last), first, last) for at in range(first, last, self.range_bytes)]
        return plan

    def read(self, partition: Stretch) -> Iterator[pa.RecordBatch]:
        fs, _ = pafs.FileSystem.from_uri(self.path)
        with fs.open_input_file(partition.name) as file:
            at = partition.start
            if at > partition.first:
                # the line that runs into this range belongs to the range before it
                at = _after_line(file, at - 1, partition.last)
            while at < partition.end:
                # whole lines of about a block, none of which begins beyond the range
                begin, data = at, file.read_at(min(BLOCK_BYTES, partition.end - at), at)
                if not data.endswith(b"\n"):
                    stop = _after_line(file, at + len(data), partition.last)
                    data += file.read_at(stop - at - len(data), at + len(data))
                if not data:
                    raise ValueError(f"{partition.name} has become shorter than byte {partition.last}")
                at += len(data)
                yield _batch(partition.name, begin, data)

    def commit(self, end: dict) -> None:
        """Nothing to release: Spark's checkpoint holds the position, and the files stay as they are."""


def _after_line(file: pa.NativeFile, at: int, last: int) -> int:
    """The end of the line that the byte at ``at`` belongs to."""
    while at < last:
        data = file.read_at(min(BLOCK_BYTES, last - at), at)
        found = data.find(b"\n")
        if found >= 0:
            return at + found + 1
        if not data:
            break
        at += len(data)
    return at


def _batch(name: str, begin: int, data: bytes) -> pa.RecordBatch:
    lines = data.split(b"\n")[:-1]
    positions, at = [], begin
    for line in lines:
        positions.append(at)
        at += len(line) + 1
    texts = [line.decode("utf-8", "replace") for line in lines]
    columns = [pa.array(texts, pa.string()), pa.array([name] * len(lines), pa.string()), pa.array(positions, pa.int64())]
    return pa.RecordBatch.from_arrays(columns, names=["value", "file", "position"])


class LineDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "growing_lines"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema: StructType) -> LineReader:
        return LineReader(self.options)


def stream_growing_lines(
    spark: SparkSession, folder: str, *, range_bytes: int = RANGE_BYTES, upto_bytes: int | None = None
) -> DataFrame:
    """The lines of all files in ``folder``, as ``value``, with their ``file`` and byte ``position`` in it.

    Files may be added and may grow at their ends while the stream runs or is stopped; what has been read must not
    change. A file may go once it is read. A micro-batch takes all whole lines there are, in partitions of
    ``range_bytes``, or those in the first ``upto_bytes`` of each file. The offsets name every file, so this is for
    logs that grow; folders of very many finished files are better read by ``stream_text``. Lines end at ``\\n``, bytes that
    are not UTF-8 become U+FFFD, hidden files are left out. ``folder`` must be on a file system that ``pyarrow.fs`` opens.
    """
    spark.dataSource.register(LineDataSource)
    reader = spark.readStream.format("growing_lines").option("rangeBytes", range_bytes)
    if upto_bytes is not None:
        reader = reader.option("uptoBytes", upto_bytes)
    return reader.load(folder)
