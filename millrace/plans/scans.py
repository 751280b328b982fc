"""Reading and writing: each format takes a whole table through a write and a typed read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions import number_or
from millrace.plans.registry import Tables, query
from millrace.sources import (
    inline_table,
    read_delimited,
    read_json_lines,
    read_text,
    sql_over,
    write_delimited,
    write_json_lines,
    write_parquet,
    write_text,
)
from millrace.sources.quoted import read_quoted
from millrace.sources.varying import read_varying_json
from millrace.workspace import new_folder

# The market segments and the short codes given to them here.
SEGMENT_CODES = [("AUTOMOBILE", 1), ("BUILDING", 2), ("FURNITURE", 3), ("HOUSEHOLD", 4), ("MACHINERY", 5)]

READING_SQL = r"CASE WHEN event_type = 'error' THEN '?' ELSE regexp_extract(props, '(\d+)', 1) END"


def reading() -> Column:
    """The reading inside an event's properties, as text; error events carry none."""
    return F.when(F.col("event_type") == "error", F.lit("?")).otherwise(F.regexp_extract("props", r"(\d+)", 1))


@query(
    "scan_text",
    r"""SELECT value, count(*) AS n FROM (SELECT unnest(string_split(text, E'\n')) AS value FROM documents)
        GROUP BY value""",
)
def scan_text(t: Tables) -> DataFrame:
    path = new_folder(t.spark, "text")
    write_text(t.documents.select("text").na.drop(), path)
    return read_text(t.spark, path).groupBy("value").agg(F.count("*").alias("n"))


@query("scan_csv", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def scan_csv(t: Tables) -> DataFrame:
    path = new_folder(t.spark, "csv")
    write_delimited(t.customer, path)
    return read_delimited(t.spark, path, t.customer.schema)


@query("scan_csv_noheader", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def scan_csv_noheader(t: Tables) -> DataFrame:
    path = new_folder(t.spark, "csv-noheader")
    write_delimited(t.supplier, path, header=False)
    return read_delimited(t.spark, path, t.supplier.schema, header=False)


@query("scan_csv_sep", "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def scan_csv_sep(t: Tables) -> DataFrame:
    path = new_folder(t.spark, "csv-semicolon")
    write_delimited(t.part, path, sep=";")
    return read_delimited(t.spark, path, t.part.schema, sep=";")


@query("scan_csv_untyped", "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_mktsegment FROM customer")
def scan_csv_untyped(t: Tables) -> DataFrame:
    path = new_folder(t.spark, "csv-untyped")
    write_delimited(t.customer.select("c_custkey", "c_name", "c_mktsegment"), path)
    return read_delimited(t.spark, path)


@query("scan_csv_text", "SELECT doc_id, text, lang FROM documents")
def scan_csv_text(t: Tables) -> DataFrame:
    path = new_folder(t.spark, "csv-text")
    documents = t.documents.select("doc_id", "text", "lang")
    write_delimited(documents, path)
    return read_delimited(t.spark, path, documents.schema)


@query("scan_json_inferred", "SELECT conv_id, CAST(turn AS BIGINT) AS turn, role, text FROM conversations")
def scan_json_inferred(t: Tables) -> DataFrame:
    path = new_folder(t.spark, "json-inferred")
    write_json_lines(t.conversations, path)
    return read_json_lines(t.spark, path).select("conv_id", "turn", "role", "text")


@query("scan_json", "SELECT conv_id, turn, role, text FROM conversations")
def scan_json(t: Tables) -> DataFrame:
    path = new_folder(t.spark, "json")
    write_json_lines(t.conversations, path)
    return read_json_lines(t.spark, path, t.conversations.schema)


@query(
    "sink_roundtrip",
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, "
    "o_orderpriority FROM orders",
)
def sink_roundtrip(t: Tables) -> DataFrame:
    path = new_folder(t.spark, "parquet")
    write_parquet(t.orders.withColumn("o_orderdate", F.to_date("o_orderdate")), path)
    return t.spark.read.parquet(path)


@query(
    "inline_table",
    """SELECT code, count(*) AS n, round(sum(c_acctbal), 2) AS balance
       FROM customer
       JOIN (VALUES ('AUTOMOBILE', 1), ('BUILDING', 2), ('FURNITURE', 3), ('HOUSEHOLD', 4), ('MACHINERY', 5))
            AS s(segment, code) ON c_mktsegment = segment
       GROUP BY code""",
)
def inline(t: Tables) -> DataFrame:
    segments = inline_table(t.spark, SEGMENT_CODES, "segment string, code int")
    joined = t.customer.join(segments, F.col("c_mktsegment") == F.col("segment"))
    return joined.groupBy("code").agg(F.count("*").alias("n"), F.round(F.sum("c_acctbal"), 2).alias("balance"))


@query(
    "typed_cast",
    f"SELECT event_id, coalesce(try_cast({READING_SQL} AS INTEGER), 0) AS reading FROM events",
)
def typed_cast(t: Tables) -> DataFrame:
    return t.events.select("event_id", number_or(reading(), 0, "int").alias("reading"))


@query(
    "sql_view",
    "SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance FROM customer WHERE c_acctbal > 5000",
)
def sql_view(t: Tables) -> DataFrame:
    return sql_over(
        t.spark,
        "SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance FROM {customers} WHERE c_acctbal > 5000",
        customers=t.customer,
    )


@query(
    "sql_group_order",
    "SELECT c_mktsegment, max(c_acctbal) AS max_balance, round(avg(c_acctbal), 4) AS avg_balance "
    "FROM customer GROUP BY c_mktsegment ORDER BY 1",
)
def sql_group_order(t: Tables) -> DataFrame:
    return sql_over(
        t.spark,
        "SELECT c_mktsegment, max(c_acctbal) AS max_balance, round(avg(c_acctbal), 4) AS avg_balance "
        "FROM {customers} GROUP BY c_mktsegment ORDER BY 1",
        customers=t.customer,
    )


@query(
    "scan_csv_quoted",
    """SELECT doc_id, text, lang, n_chars, length(text) - length(replace(text, chr(10), '')) AS n_breaks
       FROM documents WHERE doc_id IS NOT NULL""",
)
def scan_csv_quoted(t: Tables) -> DataFrame:
    """The documents as a delimited file with line breaks in quoted cells, read back in byte ranges."""
    path = new_folder(t.spark, "quoted")
    cells = ("text", "lang")
    missing = [F.col(c).isNull().alias(f"no_{c}") for c in cells]
    given = t.documents.where("doc_id is not null").select("doc_id", *cells, "n_chars", *missing)
    # with all cells in quotes a null looks like an empty text
    options = {"quoteAll": True, "escape": '"', "emptyValue": "", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    given.write.options(**options).option("header", True).csv(path)
    read = read_quoted(t.spark, path, given.schema, range_bytes=4 << 20)
    found = read.select("doc_id", *[F.when(~F.col(f"no_{c}"), F.col(c)).alias(c) for c in cells], "n_chars")
    return found.withColumn("n_breaks", F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))))


# the value of a line is a number, a text, a truth value, nothing or a list, by turns
_VARYING_SQL = """'{"doc_id":' || doc_id || ',"v":' || CASE doc_id % 5
                     WHEN 0 THEN CAST(n_chars AS VARCHAR) WHEN 1 THEN '"' || lang || '"' WHEN 2 THEN 'true' WHEN 3 THEN 'null'
                     ELSE '[' || n_chars || ']' END || '}'"""


@query(
    "scan_json_varying",
    f"""WITH lines AS (SELECT {_VARYING_SQL} AS line FROM documents WHERE doc_id >= 0 AND lang IS NOT NULL AND n_chars IS NOT NULL),
             typed AS (SELECT line, json_type(line, '$.v') IN ('BIGINT', 'UBIGINT') AS fits FROM lines)
        SELECT CAST(json_extract(line, '$.doc_id') AS BIGINT) AS doc_id,
               CASE WHEN fits THEN CAST(json_extract(line, '$.v') AS BIGINT) END AS v,
               CASE WHEN NOT fits AND json_type(line, '$.v') <> 'NULL' THEN CAST(json_extract(line, '$.v') AS VARCHAR) END AS v_else
        FROM typed""",
)
def scan_json_varying(t: Tables) -> DataFrame:
    """JSON lines whose field ``v`` has another type in every row: the numbers typed, the others kept as they are."""
    path = new_folder(t.spark, "varying")
    rows = t.documents.where("doc_id >= 0 and lang is not null and n_chars is not null")
    write_text(rows.select(F.expr(_VARYING_SQL.replace("VARCHAR", "STRING")).alias("value")), path)
    found = read_varying_json(t.spark, path, "doc_id bigint, v bigint")
    return found.select("doc_id", "v", F.try_element_at("rest", F.lit("v")).alias("v_else"))
