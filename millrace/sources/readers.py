"""Typed readers: the schema is declared at the read, so nothing downstream parses strings."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructType

from millrace.sources.writers import ESCAPES, NULL_CELL

Schema = StructType | str


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The Parquet table ``name`` in ``folder``: one file or a directory of files."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """One row per line in the column ``value``."""
    return spark.read.option("lineSep", "\n").text(path)


def read_delimited(
    spark: SparkSession, path: str, schema: Schema | None = None, *, header: bool = True, sep: str = ",", escaped: bool = True
) -> DataFrame:
    """Delimited text. Cells that do not fit their declared type become null.

    Records end at a line end, so that large files stay splittable. The header must name the columns of the
    schema in their order. Without a schema all columns are text, named by the header or ``_c0``, ``_c1`` and
    so on, which takes a look at the first line only. ``escaped`` undoes what ``write_delimited`` does to nulls,
    line ends and backslashes; files of other origin are read with ``escaped=False``.
    """
    reader = spark.read.option("header", header).option("sep", sep).option("escape", '"').option("lineSep", "\n")
    reader = reader.option("nullValue", NULL_CELL if escaped else "").option("emptyValue", "")
    reader = reader.options(ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    df = (reader.schema(schema).option("enforceSchema", False) if schema is not None else reader).csv(path)
    if not escaped:
        return df
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    return df.withColumns({name: _unescaped(F.col(f"`{name}`")) for name in texts})


def _unescaped(cell: Column) -> Column:
    for plain, written in reversed(ESCAPES):
        cell = F.replace(cell, F.lit(written), F.lit(plain))
    return cell


def read_json_lines(spark: SparkSession, path: str, schema: Schema | None = None) -> DataFrame:
    """One JSON object per line; a declared schema saves the inference pass over the data."""
    return (spark.read.schema(schema) if schema is not None else spark.read).json(path)


def read_jdbc(
    spark: SparkSession,
    url: str,
    source: str,
    *,
    column: str,
    lower: int,
    upper: int,
    partitions: int,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """A database table read over ``partitions`` connections, split on ranges of ``column``.

    ``lower`` and ``upper`` only place the split points; rows outside them are read as well.
    Driver class, user and password come from the caller in ``properties``.
    """
    return spark.read.jdbc(
        url,
        source,
        column=column,
        lowerBound=lower,
        upperBound=upper,
        numPartitions=partitions,
        properties=properties or {},
    )


def inline_table(
    spark: SparkSession, rows: Sequence[tuple], schema: Schema, partitions: int | None = None
) -> DataFrame:
    """A table of literal rows. Its exact size is part of the plan, so Spark itself picks the join for it."""
    fields = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    columns = list(zip(*rows)) or [()] * len(fields)
    arrow = pa.table([pa.array(c) for c in columns], names=fields.names)
    df = spark.createDataFrame(arrow, fields)
    return df.repartition(partitions) if partitions else df


def sql_over(spark: SparkSession, text: str, **frames: DataFrame) -> DataFrame:
    """Run SQL in which ``{name}`` stands for a DataFrame, without leaving a global view behind."""
    return spark.sql(text, **frames)
