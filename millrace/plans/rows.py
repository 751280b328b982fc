"""Projections, cleansing and filters."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.functions import (
    ONE_DIGIT_FRACTION,
    OPTIONAL_DIGITS,
    SIGNED_DECIMAL,
    bin_percent,
    bucket_by_last_digit,
    bucket_nearest,
    indicator,
    indicators,
    is_number,
    mean_abs_across,
    mean_across,
    normalise_code,
    recode,
    recode_by_substring,
    render_list,
    split_fields,
    tokens,
    truncated_mean_abs_across,
    two_level,
    whole_percent,
)
from millrace.operators.aggregates import above_mean
from millrace.operators.features import impute_constant, impute_mean
from millrace.operators.ordering import top_k
from millrace.operators.partitions import partition_count, partition_sizes, spread_small_input
from millrace.plans.registry import Tables, query
from millrace.plans.scans import READING_SQL, reading

# The same rules as millrace.functions.text, for the SQL of this catalogue.
TOKENS_SQL = r"""CASE WHEN regexp_full_match({col}, '[ \t\n\x0B\f\r]+') THEN []
  ELSE string_split_regex(regexp_replace(lower({col}), '[ \t\n\x0B\f\r]+$', ''), '[ \t\n\x0B\f\r]') END"""
FIELDS_SQL = """CASE WHEN {col} <> '' AND rtrim({col}, '{sep}') = '' THEN []
  ELSE string_split(rtrim({col}, '{sep}'), '{sep}') END"""
DOCUMENT_TOKENS_SQL = TOKENS_SQL.format(col="text")


def round_sql(x: str) -> str:
    return f"ceil(floor(2 * ({x})) / 2)"


@query("global_count", "SELECT count(*) AS n FROM lineitem")
def global_count(t: Tables) -> DataFrame:
    return t.lineitem.agg(F.count("*").alias("n"))


@query("take_n", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 10")
def take_n(t: Tables) -> DataFrame:
    return top_k(t.orders.select("o_orderkey", "o_custkey", "o_totalprice"), 10, "o_orderkey")


@query("first_row", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 1")
def first_row(t: Tables) -> DataFrame:
    return top_k(t.orders.select("o_orderkey", "o_custkey", "o_totalprice"), 1, "o_orderkey")


@query("top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def top_orders(t: Tables) -> DataFrame:
    return top_k(t.orders.select("o_orderkey", "o_totalprice"), 10, F.desc("o_totalprice"), "o_orderkey")


@query("select_filter", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 250000")
def select_filter(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_totalprice").where(F.col("o_totalprice") > 250000)


@query("filter_eq", "SELECT p_partkey, p_size FROM part WHERE p_size = 40")
def filter_eq(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", "p_size").where(F.col("p_size") == 40)


@query("filter_contains", "SELECT doc_id FROM documents WHERE contains(text, 'tion')")
def filter_contains(t: Tables) -> DataFrame:
    return t.documents.where(F.contains("text", F.lit("tion"))).select("doc_id")


@query("filter_not_prefix", "SELECT c_custkey, c_mktsegment FROM customer WHERE NOT starts_with(c_mktsegment, 'A')")
def filter_not_prefix(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", "c_mktsegment").where(~F.col("c_mktsegment").startswith("A"))


@query(
    "filter_not_null",
    f"""SELECT event_id, k FROM (SELECT event_id, try_cast({READING_SQL} AS INTEGER) AS k FROM events)
        WHERE k IS NOT NULL""",
)
def filter_not_null(t: Tables) -> DataFrame:
    return t.events.select("event_id", reading().try_cast("int").alias("k")).where(F.col("k").isNotNull())


@query(
    "filter_above_mean",
    "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal > (SELECT avg(c_acctbal) FROM customer)",
)
def filter_above_mean(t: Tables) -> DataFrame:
    return above_mean(t.customer.select("c_custkey", "c_acctbal"), "c_acctbal")


@query(
    "regex_numeric",
    rf"""SELECT count(*) AS n_tokens,
         count(*) FILTER (regexp_full_match(token, '[-+]?\d*\.?\d+')) AS signed_decimal,
         count(*) FILTER (regexp_full_match(token, '[+-]?\d+\.?\d?')) AS one_digit_fraction,
         count(*) FILTER (regexp_full_match(token, '[+-]?\d*\.?\d*')) AS optional_digits
         FROM (SELECT unnest({DOCUMENT_TOKENS_SQL}) AS token FROM documents)""",
)
def regex_numeric(t: Tables) -> DataFrame:
    token = F.col("token")
    documents = spread_small_input(t.documents.select("text"))
    # each distinct token is tested once, with its number of occurrences
    counted = documents.select(F.explode(tokens(F.col("text"))).alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    zero = F.lit(0).cast("bigint")
    occurrences = lambda test: F.coalesce(F.sum(F.when(test, F.col("n"))), zero)
    return counted.agg(
        F.coalesce(F.sum("n"), zero).alias("n_tokens"),
        occurrences(is_number(token, SIGNED_DECIMAL)).alias("signed_decimal"),
        occurrences(is_number(token, ONE_DIGIT_FRACTION)).alias("one_digit_fraction"),
        occurrences(is_number(token, OPTIONAL_DIGITS)).alias("optional_digits"),
    )


@query(
    "str_replace",
    "SELECT p_partkey, replace(concat_ws(',', p_name, p_brand, p_type, p_size), ',', chr(9)) AS line FROM part",
)
def str_replace(t: Tables) -> DataFrame:
    line = F.concat_ws(",", "p_name", "p_brand", "p_type", "p_size")
    return t.part.select("p_partkey", F.replace(line, F.lit(","), F.lit("\t")).alias("line"))


@query("str_upper", "SELECT p_partkey, upper(concat_ws(',', p_name, p_brand, p_type)) AS line FROM part")
def str_upper(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", F.upper(F.concat_ws(",", "p_name", "p_brand", "p_type")).alias("line"))


@query(
    "recode_substring",
    """SELECT p_partkey, CASE WHEN contains(line, 'PROMO') THEN replace(line, 'PROMO', '1')
              WHEN contains(line, 'ECONOMY') THEN replace(line, 'ECONOMY', '2')
              WHEN contains(line, 'STANDARD') THEN replace(line, 'STANDARD', '3') ELSE line END AS line
       FROM (SELECT p_partkey, concat_ws(',', p_name, p_type) AS line FROM part)""",
)
def recode_substring(t: Tables) -> DataFrame:
    line = F.concat_ws(",", "p_name", "p_type")
    codes = {"PROMO": "1", "ECONOMY": "2", "STANDARD": "3"}
    return t.part.select("p_partkey", recode_by_substring(line, codes).alias("line"))


@query(
    "recode_case",
    """SELECT o_orderkey, '[' || concat_ws(', ', o_orderstatus,
              CASE o_orderpriority WHEN '2-HIGH' THEN 'two' WHEN '3-MEDIUM' THEN 'three' ELSE 'one' END) || ']' AS line
       FROM orders""",
)
def recode_case(t: Tables) -> DataFrame:
    priority = recode(F.col("o_orderpriority"), {"2-HIGH": "two", "3-MEDIUM": "three"}, otherwise="one")
    return t.orders.select("o_orderkey", render_list(F.col("o_orderstatus"), priority).alias("line"))


@query(
    "cleanse_row",
    f"""SELECT p_partkey, CASE WHEN p_type = 'SMALL' THEN 2 ELSE 4 END AS doors, upper(p_name) AS name,
        concat_ws(',', CAST({round_sql('p_retailprice')} AS INTEGER), p_size, upper(p_brand)) AS line FROM part""",
)
def cleanse_row(t: Tables) -> DataFrame:
    price = bucket_nearest(F.col("p_retailprice"), 1.0).cast("int")
    return t.part.select(
        "p_partkey",
        two_level(F.col("p_type"), "SMALL", 2, 4).alias("doors"),
        F.upper("p_name").alias("name"),
        F.concat_ws(",", price, F.col("p_size"), F.upper("p_brand")).alias("line"),
    )


@query(
    "explode_words",
    f"""SELECT word, count(*) AS n
        FROM (SELECT unnest({FIELDS_SQL.format(col='text', sep=' ')}) AS word FROM documents) GROUP BY word""",
)
def explode_words(t: Tables) -> DataFrame:
    words = spread_small_input(t.documents.select("text")).select(F.explode(split_fields(F.col("text"), " ")).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("n"))


@query(
    "impute_missing",
    f"""SELECT event_id, coalesce(reading, 80.0) AS by_constant,
               round(coalesce(reading, (SELECT avg(try_cast({READING_SQL} AS DOUBLE)) FROM events)), 6) AS by_mean
        FROM (SELECT event_id, try_cast({READING_SQL} AS DOUBLE) AS reading FROM events)""",
)
def impute_missing(t: Tables) -> DataFrame:
    readings = t.events.select("event_id", reading().alias("by_constant"), reading().alias("by_mean"))
    filled = impute_mean(impute_constant(readings, "by_constant", 80.0), "by_mean")
    return filled.withColumn("by_mean", F.round("by_mean", 6))


@query(
    "binary_encode",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'A' THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS flag,
              CASE WHEN l_linestatus = 'F' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS finished FROM lineitem""",
)
def binary_encode(t: Tables) -> DataFrame:
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        two_level(F.col("l_returnflag"), "A", 1.0, 2.0).alias("flag"),
        two_level(F.col("l_linestatus"), "F", 1.0, 0.0).alias("finished"),
    )


@query(
    "indicator_columns",
    """SELECT c_custkey, CAST(c_mktsegment = 'AUTOMOBILE' AS DOUBLE) AS "AUTOMOBILE",
              CAST(c_mktsegment = 'BUILDING' AS DOUBLE) AS "BUILDING",
              CAST(c_mktsegment = 'MACHINERY' AS DOUBLE) AS "MACHINERY",
              CAST(coalesce(c_acctbal < 0, false) AS DOUBLE) AS overdrawn FROM customer""",
)
def indicator_columns(t: Tables) -> DataFrame:
    overdrawn = F.when(F.col("c_acctbal") < 0, F.lit("yes")).otherwise(F.lit("no"))
    wide = t.customer.withColumns(indicators("c_mktsegment", ["AUTOMOBILE", "BUILDING", "MACHINERY"]))
    return wide.select(
        "c_custkey", "AUTOMOBILE", "BUILDING", "MACHINERY", indicator(overdrawn, "yes").alias("overdrawn")
    )


@query(
    "normalise_code",
    """SELECT o_orderkey,
              CAST(CASE code WHEN 'M' THEN 1 WHEN 'F' THEN 2 ELSE try_cast(code AS DOUBLE) END AS DOUBLE) AS code
       FROM (SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'M' WHEN 'F' THEN 'F'
                                ELSE substr(o_orderpriority, 1, 1) END AS code FROM orders)""",
)
def normalise(t: Tables) -> DataFrame:
    # open orders are written M, finished ones F, the others by the digit of their priority
    code = recode(F.col("o_orderstatus"), {"O": "M", "F": "F"}, otherwise=F.substring("o_orderpriority", 1, 1))
    return t.orders.select("o_orderkey", normalise_code(code, {"M": 1.0, "F": 2.0}).alias("code"))


@query(
    "bucket_round",
    f"""SELECT l_orderkey, l_linenumber, CAST({round_sql('l_quantity / 10')} * 10 AS DOUBLE) AS nearest,
               CASE WHEN q % 10 < 5 THEN q - q % 10 ELSE q - q % 10 + 10 END AS by_digit
        FROM (SELECT *, CAST(l_quantity AS INTEGER) AS q FROM lineitem)""",
)
def bucket_round(t: Tables) -> DataFrame:
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        bucket_nearest(F.col("l_quantity")).alias("nearest"),
        bucket_by_last_digit(F.col("l_quantity").cast("int")).alias("by_digit"),
    )


_FOUR = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_ABS_MEAN_SQL = "(abs(l_quantity) + abs(-l_extendedprice) + abs(l_discount) + abs(l_tax)) / 4"


@query(
    "horizontal_mean",
    f"""SELECT l_orderkey, l_linenumber,
               round(abs((l_quantity + (-l_extendedprice) + l_discount + l_tax) / 4), 6) AS abs_of_mean,
               CAST({round_sql(_ABS_MEAN_SQL)} AS DOUBLE) AS mean_of_abs,
               CAST(trunc({_ABS_MEAN_SQL}) AS INTEGER) AS truncated FROM lineitem""",
)
def horizontal_mean(t: Tables) -> DataFrame:
    # the price enters as a debit, so that the absolute values matter
    cols = [-F.col(c) if c == "l_extendedprice" else F.col(c) for c in _FOUR]
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        F.round(F.abs(mean_across(cols)), 6).alias("abs_of_mean"),
        mean_abs_across(cols).alias("mean_of_abs"),
        truncated_mean_abs_across(cols).alias("truncated"),
    )


_PAID_SQL = "l_quantity * 2000 / (l_extendedprice + 1) * 100 / 25"


@query(
    "ratio_bin",
    f"""SELECT l_orderkey, l_linenumber, CAST({round_sql(_PAID_SQL)} * 25 AS DOUBLE) AS binned,
               CASE WHEN tax = 0 THEN 100 ELSE CAST(trunc(qty / tax) AS INTEGER) * 100 END AS whole
        FROM (SELECT *, CAST(round(l_tax * 100) AS INTEGER) AS tax, CAST(l_quantity AS INTEGER) AS qty FROM lineitem)""",
)
def ratio_bin(t: Tables) -> DataFrame:
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        bin_percent(F.col("l_quantity") * 2000, F.col("l_extendedprice")).alias("binned"),
        whole_percent(F.col("l_quantity").cast("int"), F.round(F.col("l_tax") * 100).cast("int")).alias("whole"),
    )


PARTS = 7


@query(
    "partition_sizes",
    f"""SELECT CAST(((doc_id % {PARTS}) + {PARTS}) % {PARTS} AS INTEGER) AS part, count(*) AS n,
               CAST((SELECT count(DISTINCT ((doc_id % {PARTS}) + {PARTS}) % {PARTS}) FROM documents) AS BIGINT) AS parts
        FROM documents WHERE doc_id IS NOT NULL GROUP BY 1""",
)
def partition_sizes_by_id(t: Tables) -> DataFrame:
    """Documents dealt by their id to partitions of stated numbers: the rows of each, and how many hold rows."""
    ids = t.documents.select("doc_id").where("doc_id is not null")
    dealt = ids.repartitionById(PARTS, F.pmod("doc_id", F.lit(PARTS)).cast("int"))
    return partition_sizes(dealt).withColumn("parts", partition_count(dealt).scalar())
