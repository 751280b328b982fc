from millrace.sources.readers import (
    inline_table,
    read_delimited,
    read_jdbc,
    read_json_lines,
    read_text,
    sql_over,
    table,
)
from millrace.sources.writers import write_delimited, write_json_lines, write_parquet, write_text

__all__ = [
    "inline_table",
    "read_delimited",
    "read_jdbc",
    "read_json_lines",
    "read_text",
    "sql_over",
    "table",
    "write_delimited",
    "write_json_lines",
    "write_parquet",
    "write_text",
]
