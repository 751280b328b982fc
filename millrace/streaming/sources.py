"""Streaming sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamReader


def socket_lines(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Text lines from a socket, in the column ``value``. The socket cannot replay lost lines."""
    return spark.readStream.format("socket").option("host", host).option("port", port).load()


def _admitting(spark: SparkSession, files_per_trigger: int | None, bytes_per_trigger: int | None) -> DataStreamReader:
    """A reader that lets so many new files, or about so many bytes of them, into one micro-batch."""
    reader = spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", bytes_per_trigger)
    return reader


def stream_text(
    spark: SparkSession, folder: str, *, files_per_trigger: int | None = None, bytes_per_trigger: int | None = None
) -> DataFrame:
    """Lines of the text files that arrive in ``folder``."""
    return _admitting(spark, files_per_trigger, bytes_per_trigger).text(folder)


def stream_parquet(
    spark: SparkSession, path: str, *, files_per_trigger: int | None = None, bytes_per_trigger: int | None = None
) -> DataFrame:
    """Rows of the Parquet table at ``path``, which may be a directory or a single file."""
    reader = _admitting(spark, files_per_trigger, bytes_per_trigger)
    # a stream takes a single file only through a pattern; this one matches nothing but the path
    pattern = f"{path[:-1]}[{path[-1]}]"
    return reader.schema(spark.read.parquet(path).schema).parquet(pattern)


def utc_instant(col: str) -> Column:
    """A zone-less timestamp as the instant it names in UTC, whatever the session's time zone."""
    return F.expr(f"timestamp_micros(timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{col}`))")
