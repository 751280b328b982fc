"""WARC archives as a PySpark data source, and an archive that stores equal payloads once.

Reading: files are planned into partitions, predicates on record type and on headers are pushed down,
and of each record the headers are parsed first. A record that the predicates refuse, or whose payload
the schema does not ask for, is skipped by its length without being decompressed or decoded.

Writing: one gzip member for each record, with the skip lengths of the WARC format's annex in the gzip
header, so that a reader can pass over a member unread. Tasks write to a staging folder; only the files
of committed tasks are moved to their place, so a repeated or lost task leaves no records behind.

Paths may name any file system that ``pyarrow.fs`` opens. Both ``.warc.gz`` (with or without skip lengths)
and plain ``.warc`` files are read.
"""

from __future__ import annotations

import base64
import hashlib
import posixpath
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualNullSafe,
    EqualTo,
    Filter,
    In,
    InputPartition,
    IsNotNull,
    StringStartsWith,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

from millrace.workspace import materialize, new_folder

PARTITION_BYTES = 64 * 1024 * 1024
FILE_BYTES = 256 * 1024 * 1024
ROWS_PER_BATCH = 256
BATCH_BYTES = 4 * 1024 * 1024

SCHEMA = (
    "record_id string, record_type string, target_uri string, date string, payload_digest string, "
    "refers_to string, payload_bytes bigint, headers map<string,string>, payload binary"
)
# fixed values of the format
HEADER_OF = {
    "record_id": "WARC-Record-ID",
    "record_type": "WARC-Type",
    "target_uri": "WARC-Target-URI",
    "date": "WARC-Date",
    "payload_digest": "WARC-Payload-Digest",
    "refers_to": "WARC-Refers-To",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# what a header line cannot hold; an address with it, or with white space at an end, is percent-encoded, which a line tells
_UNHELD = re.compile(r"[\x00-\x1f\x7f\x85\u2028\u2029]")
ENCODED = "X-Target-URI-Encoding: percent"
# characters of such an address that stay as they are
_ADDRESS = "!#$&'()*+,/:;=?@[]~-._|{}^`\"\\<>"


def base32_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path)


# ---------------------------------------------------------------- writing


def member(record: bytes, level: int) -> bytes:
    """One gzip member whose header tells its own length and that of its content."""
    packer = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = packer.compress(record) + packer.flush()
    total = 12 + 12 + len(body) + 8
    if max(total, len(record)) >= 1 << 32:
        # lengths beyond four bytes cannot be told; readers then unpack the member
        head = struct.pack("<BBBBIBB", 0x1F, 0x8B, 8, 0, 0, 0, 255)
    else:
        skip = struct.pack("<HBBHII", 12, ord("s"), ord("l"), 8, total, len(record))
        head = struct.pack("<BBBBIBB", 0x1F, 0x8B, 8, 4, 0, 0, 255) + skip
    return head + body + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)


def record_bytes(row: dict) -> bytes:
    """A response with its payload, or a revisit that names the record that holds it."""
    revisit = row["record_type"] == "revisit"
    payload = row["payload"] or b""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % row["payload_bytes"]
    block = http if revisit else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {row['record_type']}",
        f"WARC-Record-ID: <{row['record_id']}>",
        f"WARC-Date: {row['date']}",
        f"WARC-Payload-Digest: sha1:{row['payload_digest']}",
    ]
    if row["target_uri"] is not None:
        uri = row["target_uri"]
        if _UNHELD.search(uri) or uri != uri.strip():
            lines.append(ENCODED)
            uri = quote(uri, safe=_ADDRESS)
        lines.append(f"WARC-Target-URI: {uri}")
    if revisit:
        lines += [f"WARC-Refers-To: <{row['refers_to']}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


@dataclass
class Written(WriterCommitMessage):
    names: list[str] = field(default_factory=list)


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool) -> None:
        self.path = options["path"].rstrip("/")
        self.level = int(options.get("level", "1"))
        self.file_bytes = int(options.get("fileBytes", str(FILE_BYTES)))
        self.staging = f"{self.path}/_staging-{uuid.uuid4().hex}"
        if overwrite:
            raise ValueError("archives are only added to: choose the mode append")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, folder = file_system(self.staging)
        fs.create_dir(folder, recursive=True)
        done, out, size = Written(), None, 0
        try:
            for batch in iterator:
                for row in batch.to_pylist():
                    if out is None or size >= self.file_bytes:
                        if out is not None:
                            out.close()
                        done.names.append(f"part-{uuid.uuid4().hex}.warc.gz")
                        out, size = fs.open_output_stream(f"{folder}/{done.names[-1]}", compression=None), 0
                    data = member(record_bytes(row), self.level)
                    out.write(data)
                    size += len(data)
        finally:
            if out is not None:
                out.close()
        return done

    def commit(self, messages: list[Written | None]) -> None:
        fs, folder = file_system(self.path)
        staging = file_system(self.staging)[1]
        fs.create_dir(folder, recursive=True)
        for message in messages:
            for name in message.names if message else []:
                fs.move(f"{staging}/{name}", f"{folder}/{name}")
        self._clear(fs, staging)

    def abort(self, messages: list[Written | None]) -> None:
        self._clear(*file_system(self.staging))

    @staticmethod
    def _clear(fs: pafs.FileSystem, staging: str) -> None:
        if fs.get_file_info(staging).type == pafs.FileType.Directory:
            fs.delete_dir(staging)


# ---------------------------------------------------------------- reading


@dataclass
class Files(InputPartition):
    names: list[str]


class Bytes:
    """A file read forwards: a small look ahead, and skips that read nothing."""

    CHUNK = 1 << 16

    def __init__(self, file: pa.NativeFile, plain: bool) -> None:
        self.file, self.plain, self.size = file, plain, file.size()
        self.start, self.data = 0, b""

    def at_end(self) -> bool:
        return self.start >= self.size

    def ahead(self, n: int) -> bytes:
        """The next ``n`` bytes, or what is left; they stay unread."""
        if len(self.data) < n and self.start + len(self.data) < self.size:
            self.file.seek(self.start)
            self.data = self.file.read(max(n, self.CHUNK))
        return self.data[:n]

    def skip(self, n: int) -> None:
        self.start += n
        self.data = self.data[n:]


def parse_headers(data: bytes) -> tuple[dict[str, str], int]:
    """The headers of the record that ``data`` begins with, and their length; length 0 if they go on."""
    end = data.find(b"\r\n\r\n")
    if end < 0:
        return {}, 0
    first, *lines = data[:end].decode("utf-8", "replace").split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError(f"not a WARC record: {first[:40]!r}")
    headers, name = {}, ""
    for line in lines:
        if line[:1] in " \t" and name:
            headers[name] += " " + line.strip()
        else:
            name, _, value = line.partition(":")
            headers[name] = value.strip()
    return headers, end + 4


class Record:
    """The headers of one record; its block is decoded only on demand. ``finish`` moves on to the next record."""

    def __init__(self, source: Bytes) -> None:
        self.source, self.skip = source, 0
        if source.plain:
            self._plain()
        else:
            self._packed()

    def _plain(self) -> None:
        want = 4096
        while True:
            data = self.source.ahead(want)
            self.headers, self.begin = parse_headers(data)
            if self.begin:
                break
            if len(data) < want:
                raise ValueError("a WARC record is cut off in its headers")
            want *= 4
        self.length = int(self.headers["Content-Length"])
        self.skip = self.begin + self.length + 4

    def _packed(self) -> None:
        head = self.source.ahead(24)
        if head[:3] != b"\x1f\x8b\x08":
            raise ValueError("not a gzip member")
        if head[3] == 4 and head[12:16] == b"sl\x08\x00":
            self.skip = struct.unpack("<I", head[16:20])[0]
        self.unpacker = zlib.decompressobj(31)
        self.text, self.used = b"", 0
        while True:
            self._more(2048)
            self.headers, self.begin = parse_headers(self.text)
            if self.begin:
                break
            if self.unpacker.eof:
                raise ValueError("a WARC record is cut off in its headers")
        self.length = int(self.headers["Content-Length"])

    def _more(self, n: int) -> None:
        """Unpack ``n`` more packed bytes of the member, or what it has left."""
        data = self.source.ahead(self.used + n)[self.used :]
        if not data:
            raise ValueError("a gzip member is cut off")
        self.text += self.unpacker.decompress(data)
        self.used += len(data) - len(self.unpacker.unused_data)

    def head(self) -> bytes:
        """The protocol headers at the start of the block, with the empty line; empty if there are none."""
        n = 1024
        while True:
            block = self.block(n)
            end = block.find(b"\r\n\r\n")
            if end >= 0 or n >= self.length:
                return block[: end + 4] if end >= 0 and block[:5] == b"HTTP/" else b""
            n *= 4

    def block(self, n: int | None = None) -> bytes:
        n = self.length if n is None else min(n, self.length)
        if self.source.plain:
            return self.source.ahead(self.begin + n)[self.begin :]
        parts = self.begin + n
        while len(self.text) < parts and not self.unpacker.eof:
            left = self.skip - self.used if self.skip else 1 << 16
            self._more(max(2048, min(left, 1 << 20)) if n > 4096 else 2048)
        if len(self.text) < parts:
            raise ValueError("a WARC record is cut off in its block")
        return self.text[self.begin : parts]

    def finish(self) -> None:
        if not self.skip:
            while not self.unpacker.eof:
                self.text = b""
                self._more(1 << 16)
            self.skip = self.used
        self.source.skip(self.skip)


class WarcReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict) -> None:
        self.path = options["path"].rstrip("/")
        self.columns = schema.names
        self.schema = schema
        self.verify = options.get("verify", "false") == "true"
        self.partition_bytes = int(options.get("partitionBytes", str(PARTITION_BYTES)))
        # header name -> the values allowed, or a prefix
        self.allowed: dict[str, list[set]] = {}
        self.prefixes: list[tuple[str, str]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if column not in HEADER_OF:
                yield f
            elif isinstance(f, EqualTo | EqualNullSafe) and f.value is not None:
                self.allowed.setdefault(column, []).append({f.value})
            elif isinstance(f, In):
                self.allowed.setdefault(column, []).append({v for v in f.value if v is not None})
            elif isinstance(f, StringStartsWith):
                self.prefixes.append((column, f.value))
            else:
                # a check for null is left to Spark, which has it cheap
                assert isinstance(f, Filter | IsNotNull)
                yield f

    def partitions(self) -> list[Files]:
        fs, folder = file_system(self.path)
        info = fs.get_file_info(folder)
        found = [info] if info.type == pafs.FileType.File else fs.get_file_info(pafs.FileSelector(folder, recursive=True))
        shown = lambda p: not any(x[:1] in "_." for x in posixpath.relpath(p, folder).split("/") if x != ".")
        files = [x for x in found if x.is_file and x.path.endswith((".warc", ".warc.gz")) and shown(x.path)]
        plan, room = [], 0
        # small files share a partition; a file is never split, the writer bounds its size
        for x in sorted(files, key=lambda x: x.path):
            if not plan or room + x.size > self.partition_bytes:
                plan.append(Files([]))
                room = 0
            plan[-1].names.append(x.path)
            room += x.size
        return plan

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        schema, rows, size = to_arrow_schema(self.schema), [], 0
        fs, _ = file_system(self.path)
        for name in partition.names if partition else []:
            with fs.open_input_file(name) as file:
                source = Bytes(file, not name.endswith(".gz"))
                while not source.at_end():
                    record = Record(source)
                    values = self._headers(record)
                    if self._wanted(values):
                        rows.append(self._row(record, values))
                        size += len(rows[-1].get("payload") or b"")
                    record.finish()
                    if len(rows) >= ROWS_PER_BATCH or size >= BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)

    @staticmethod
    def _headers(record: Record) -> dict:
        headers = record.headers
        values = {column: headers.get(name) for column, name in HEADER_OF.items()}
        for column in ("record_id", "refers_to"):
            if values[column] is not None:
                values[column] = values[column].removeprefix("<").removesuffix(">")
        name, _, told = ENCODED.partition(": ")
        # only what the writer has encoded: per cent signs of other addresses are their own
        if values["target_uri"] is not None and headers.get(name) == told:
            values["target_uri"] = unquote(values["target_uri"])
        if values["payload_digest"] is not None:
            values["payload_digest"] = values["payload_digest"].partition(":")[2] or values["payload_digest"]
        return values

    def _wanted(self, values: dict) -> bool:
        return all(values[c] in allowed for c, sets in self.allowed.items() for allowed in sets) and all(
            (values[c] or "").startswith(prefix) for c, prefix in self.prefixes
        )

    def _row(self, record: Record, values: dict) -> dict:
        row = {c: values[c] for c in self.columns if c in values}
        if "headers" in self.columns:
            row["headers"] = list(record.headers.items())
        revisit = values["record_type"] == "revisit"
        if "payload_bytes" in self.columns or "payload" in self.columns or self.verify:
            head = record.head()
            lines = [x.partition(b":") for x in head.lower().split(b"\r\n")]
            told = [int(value) for name, _, value in lines if name == b"content-length"]
            row |= {"payload_bytes": told[0] if revisit and told else record.length - len(head)}
            if ("payload" in self.columns or self.verify) and not revisit:
                row["payload"] = record.block()[len(head) :]
                if self.verify and values["payload_digest"] not in (None, base32_digest(row["payload"])):
                    raise ValueError(f"record {values['record_id']}: the payload does not have its digest")
        return {c: row.get(c) for c in self.columns}


class WarcDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(schema, dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(dict(self.options), overwrite)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)


def read_warc(spark: SparkSession, path: str, columns: str = SCHEMA, *, verify: bool = False) -> DataFrame:
    """The records under ``path``. ``columns``, a part of ``SCHEMA``, decides what is decoded."""
    register(spark)
    return spark.read.format("warc").schema(columns).option("verify", str(verify).lower()).load(path)


# ---------------------------------------------------------------- archives that store equal payloads once

ID_PREFIX = "urn:millrace:page:"


def archive_records(
    pages: DataFrame, id_col: str, url_col: str, payload_col: str, *, date: str = "2000-01-01T00:00:00Z", least_bytes: int = 0
) -> DataFrame:
    """A record for each row: of equal payloads of ``least_bytes`` or more, the smallest id is the response.

    Defined results: a null payload is empty; null ids come after all others; rows that repeat the smallest
    id are responses each. The first ids of repeated payloads are summed up before they are joined,
    and a payload that very many rows share is split by Spark's skew join.
    """
    body = F.encode(F.coalesce(pages[payload_col], F.lit("")), "UTF-8")
    rows = pages.select(
        pages[id_col].cast("bigint").alias("id"),
        pages[url_col].alias("target_uri"),
        body.alias("payload"),
        F.octet_length(body).cast("bigint").alias("payload_bytes"),
        F.sha1(body).alias("sha1"),
    )
    known = rows.where(F.col("payload_bytes") >= least_bytes).select("id", F.col("sha1").alias("same"))
    first = materialize(
        known.groupBy("same").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null"),
        "warc-first",
    )
    later = (
        known.join(first.select("same", "first"), "same")
        .where("id > first or id is null")
        .groupBy(F.col("id").alias("later_id"), "same")
        .agg(F.min("first").alias("first"))
    )
    joined = rows.join(later, F.col("id").eqNullSafe(F.col("later_id")) & (F.col("sha1") == F.col("same")), "left")
    revisit = F.col("first").isNotNull()
    name = lambda c: F.concat(F.lit(ID_PREFIX), F.coalesce(c.cast("string"), F.lit("")))
    base32 = base32_of_hex(F.col("sha1"))
    return joined.select(
        name(F.col("id")).alias("record_id"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        "target_uri",
        F.lit(date).alias("date"),
        base32.alias("payload_digest"),
        F.when(revisit, name(F.col("first"))).alias("refers_to"),
        "payload_bytes",
        F.when(~revisit, F.col("payload")).alias("payload"),
    )


def base32_of_hex(digest):
    """The 32 base-32 characters of a SHA-1 given as 40 hexadecimal digits, eight at a time."""
    alphabet = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    letters = []
    for group in range(4):
        # ten hexadecimal digits are forty bits, eight letters
        value = F.conv(F.substring(digest, 10 * group + 1, 10), 16, 10).cast("bigint")
        for letter in range(8):
            code = F.shiftright(value, 35 - 5 * letter).bitwiseAND(F.lit(31))
            letters.append(F.substring(alphabet, (code + 1).cast("int"), F.lit(1)))
    return F.concat(*letters)


def id_of(record_id):
    digits = F.substring(record_id, len(ID_PREFIX) + 1, 20)
    return F.when(digits != "", digits).cast("bigint")


def archived(pages: DataFrame, id_col: str, url_col: str, payload_col: str) -> DataFrame:
    """Write all rows to an archive in the shared folder, read it back and verify every stored payload."""
    spark = pages.sparkSession
    register(spark)
    path = new_folder(spark, "warc")
    records = archive_records(pages, id_col, url_col, payload_col)
    records.write.format("warc").mode("append").save(path)
    return read_warc(spark, path, SCHEMA.replace(", headers map<string,string>", "").replace(", payload binary", ""), verify=True)


def archived_sql(table: str = "pages") -> str:
    """The result of the query over ``archived`` for DuckDB."""
    letters = " || ".join(
        f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((v{group} >> {35 - 5 * i}) & 31 AS INT), 1)"
        for group in range(4)
        for i in range(8)
    )
    groups = ", ".join(f"CAST('0x' || substr(digest, {10 * g + 1}, 10) AS BIGINT) AS v{g}" for g in range(4))
    return f"""
    WITH hashed AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS digest FROM {table}),
    firsts AS (SELECT *, min(page_id) OVER (PARTITION BY digest) AS first, {groups} FROM hashed)
    SELECT page_id, payload_bytes, {letters} AS payload_digest,
        CASE WHEN page_id > first OR (page_id IS NULL AND first IS NOT NULL) THEN 'revisit' ELSE 'response' END AS record_type,
        CASE WHEN page_id > first OR (page_id IS NULL AND first IS NOT NULL) THEN first END AS refers_to
    FROM firsts
    """
