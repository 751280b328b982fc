"""Delimited files of other origin whose quoted cells hold line breaks, read in byte ranges.

Whether a line break ends a record depends on the number of quotes before it, back to the start of the file. So a first
pass counts the quotes of every range, which is one bit for each, and their prefix tells for every range whether it begins
inside a cell. A range then has the records that begin in it, wherever they end. Large files stay splittable, and
only the bits go through the driver.
"""

from __future__ import annotations

import io
import json
import posixpath
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from itertools import accumulate
from operator import xor

import numpy as np
import pyarrow as pa
import pyarrow.csv as pcsv
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StringType, StructField, StructType

RANGE_BYTES = 32 << 20
BLOCK_BYTES = 1 << 20
QUOTE, BREAK = ord('"'), ord("\n")


@dataclass
class Range(InputPartition):
    name: str
    place: int
    start: int
    end: int
    size: int
    inside: bool = False


def ranges_of(path: str, range_bytes: int) -> list[Range]:
    """The byte ranges of the file or of all files in the folder, hidden ones left out."""
    fs, folder = pafs.FileSystem.from_uri(path)
    info = fs.get_file_info(folder)
    if info.type == pafs.FileType.NotFound:
        raise FileNotFoundError(path)
    found = [info] if info.is_file else fs.get_file_info(pafs.FileSelector(folder, recursive=True))
    shown = lambda p: not any(x[:1] in "_." for x in posixpath.relpath(p, folder).split("/") if x != ".")
    files = sorted((x for x in found if x.is_file and shown(x.path)), key=lambda x: x.path)
    return [
        Range(x.path, i, start, min(start + range_bytes, x.size), x.size)
        for x in files
        for i, start in enumerate(range(0, x.size, range_bytes))
    ]


def blocks(file: pa.NativeFile, start: int, end: int) -> Iterator[bytes]:
    for at in range(start, end, BLOCK_BYTES):
        yield file.read_at(min(BLOCK_BYTES, end - at), at)


def end_of_record(file: pa.NativeFile, start: int, size: int, inside: bool) -> int:
    """The end of the record that the byte at ``start`` belongs to; ``inside`` tells whether that byte is quoted."""
    at = start
    for block in blocks(file, start, size):
        data = np.frombuffer(block, np.uint8)
        quoted = (np.cumsum(data == QUOTE) + inside) % 2 == 1
        breaks = np.flatnonzero((data == BREAK) & ~quoted)
        if len(breaks):
            return at + int(breaks[0]) + 1
        inside = bool(quoted[-1])
        at += len(block)
    return size


class _OverRanges(DataSourceReader):
    def __init__(self, options: Mapping[str, str]) -> None:
        self.path, self.range_bytes = options["path"], int(options["rangeBytes"])

    def partitions(self) -> Sequence[InputPartition]:
        # a source without partitions would have one without a range
        return ranges_of(self.path, self.range_bytes) or [Range("", 0, 0, 0, 0)]


class QuoteReader(_OverRanges):
    def read(self, partition: Range) -> Iterator[tuple]:
        if partition.size:
            fs, _ = pafs.FileSystem.from_uri(self.path)
            with fs.open_input_file(partition.name) as file:
                quotes = sum(block.count(b'"') for block in blocks(file, partition.start, partition.end))
            yield partition.name, partition.place, quotes % 2 == 1


class QuoteSource(DataSource):
    """One row for each byte range: whether the number of its quotes is odd."""

    @classmethod
    def name(cls) -> str:
        return "quote_parity"

    def schema(self) -> str:
        return "file string, place int, odd boolean"

    def reader(self, schema: StructType) -> QuoteReader:
        return QuoteReader(self.options)


class RecordReader(_OverRanges):
    def __init__(self, schema: StructType, options: Mapping[str, str]) -> None:
        super().__init__(options)
        self.names, self.sep, self.header = schema.names, options["sep"], options["header"] == "true"
        self.inside: dict[str, str] = json.loads(options["inside"])

    def partitions(self) -> Sequence[InputPartition]:
        plan = super().partitions()
        for x in plan:
            x.inside = x.size > 0 and self.inside[x.name][x.place] == "1"
        return plan

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        if not partition.size:
            return
        fs, _ = pafs.FileSystem.from_uri(self.path)
        with fs.open_input_file(partition.name) as file:
            start, size = partition.start, partition.size
            if start:
                # the record that runs into this range belongs to the range before it
                quote = file.read_at(1, start - 1) == b'"'
                start = end_of_record(file, start if quote else start - 1, size, partition.inside)
            elif self.header:
                start = self._after_header(file, size)
            if start >= partition.end:
                return
            # where the record ends that the last byte of the range belongs to
            end = self._end(file, start, partition.end, size)
            data = file.read_at(end - start, start)
        yield from self._parsed(data, partition)

    @staticmethod
    def _end(file: pa.NativeFile, start: int, end: int, size: int) -> int:
        """``start`` is the start of a record: the end of the last record that begins before ``end``."""
        inside = sum(block.count(b'"') for block in blocks(file, start, end - 1)) % 2 == 1
        return end_of_record(file, end - 1, size, inside)

    def _after_header(self, file: pa.NativeFile, size: int) -> int:
        end = end_of_record(file, 0, size, False)
        found = self._table(file.read_at(end, 0)).to_pylist()
        given = [x for row in found for x in row.values()]
        if given != self.names:
            raise ValueError(f"the header names {given}, the schema {self.names}")
        return end

    def _table(self, data: bytes) -> pa.Table:
        return pcsv.read_csv(
            io.BytesIO(data),
            read_options=pcsv.ReadOptions(use_threads=False, block_size=max(len(data) + 1, 1024), column_names=self.names),
            parse_options=pcsv.ParseOptions(delimiter=self.sep, newlines_in_values=True, ignore_empty_lines=len(self.names) > 1),
            convert_options=pcsv.ConvertOptions(
                column_types={n: pa.string() for n in self.names}, null_values=[""], strings_can_be_null=True, quoted_strings_can_be_null=False
            ),
        )

    def _parsed(self, data: bytes, partition: Range) -> Iterator[pa.RecordBatch]:
        try:
            yield from self._table(data).to_batches()
        except pa.ArrowInvalid as error:
            raise ValueError(f"{partition.name}, records from byte {partition.start}: {error}") from error


class RecordSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "quoted_records"

    def reader(self, schema: StructType) -> RecordReader:
        return RecordReader(schema, self.options)


def read_quoted(
    spark: SparkSession, path: str, schema: StructType | str, *, header: bool = True, sep: str = ",", range_bytes: int = RANGE_BYTES
) -> DataFrame:
    """Delimited files by the common rules: a cell in quotes may hold line breaks, separators and doubled quotes.

    Cells that do not fit their declared type become null, as do empty cells; an empty cell in quotes is an empty text. A
    quote elsewhere than around a cell is an error or moves the ends of records, as the rules say. Lines end at ``\\n`` or
    ``\\r\\n``. The header must name the columns of the schema in their order. Files are read twice and nothing is
    shuffled; a range is held in memory by its task. ``path`` must be on a file system that ``pyarrow.fs`` opens.
    """
    fields = (schema if isinstance(schema, StructType) else StructType.fromDDL(schema)).fields
    for source in (QuoteSource, RecordSource):
        spark.dataSource.register(source)
    counts = spark.read.format("quote_parity").option("rangeBytes", range_bytes).load(path).collect()
    odd: dict[str, list[int]] = {}
    for r in sorted(counts, key=lambda r: (r["file"], r["place"])):
        odd.setdefault(r["file"], []).append(int(r["odd"]))
    inside = {name: "".join(map(str, [0, *accumulate(bits, xor)][:-1])) for name, bits in odd.items()}
    texts = StructType([StructField(f.name, StringType()) for f in fields])
    reader = spark.read.format("quoted_records").schema(texts).option("rangeBytes", range_bytes).option("inside", json.dumps(inside))
    cells = reader.option("sep", sep).option("header", str(header).lower()).load(path)
    return cells.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in fields])
