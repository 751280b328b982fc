"""Writers. Each writes a directory and refuses to replace one that exists, unless told otherwise."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType

# How a cell tells what the format cannot: the null marker, and line ends as two characters each, so that a
# record is one line and files stay splittable. A backslash begins each of them, so it is written as two
# characters itself: first of all here, last when read.
NULL_CELL = r"\N"
ESCAPES = [("\\", r"\b"), ("\n", r"\n"), ("\r", r"\r")]


def write_text(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One line per row of a single string column; a null is an empty line."""
    df.write.mode(mode).option("lineSep", "\n").text(path)


def write_delimited(
    df: DataFrame, path: str, *, header: bool = True, sep: str = ",", mode: str = "errorifexists", escaped: bool = True
) -> None:
    """Delimited text that ``read_delimited`` reads back as it was: nulls, empty texts, quotes and line ends.

    With ``escaped=False`` line ends and backslashes are written as they are, for other readers.
    """
    cells = {}
    for field in df.schema.fields:
        if escaped and isinstance(field.dataType, StringType):
            cell = F.col(f"`{field.name}`")
            for plain, written in ESCAPES:
                cell = F.replace(cell, F.lit(plain), F.lit(written))
            cells[field.name] = cell
    writer = df.withColumns(cells).write.mode(mode).option("header", header).option("sep", sep)
    writer = writer.option("escape", '"').option("emptyValue", '""').option("lineSep", "\n")
    keep = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    writer.options(**keep).option("nullValue", NULL_CELL if escaped else "").csv(path)


def write_json_lines(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).json(path)


def write_parquet(
    df: DataFrame, path: str, *, partition_by: tuple[str, ...] = (), mode: str = "errorifexists"
) -> None:
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)
