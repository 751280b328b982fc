"""Joins, set operations and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.functions import bucket_nearest, split_fields
from millrace.operators.aggregates import (
    accuracy,
    concat_ordered,
    confusion_matrix,
    correlation_report,
    count_where,
    covariance_report,
    mean_and_deviation,
    observe_counts,
    partial_rate,
    r_squared,
    rate_report,
    shortest_and_longest,
    sum_count_mean,
)
from millrace.operators.exact import exact_correlations, exact_covariances, exact_mean_and_deviation, exact_sums
from millrace.operators.frequent import frequent_keys
from millrace.operators.joins import lookup_join, skew_safe_join
from millrace.operators.sampling import key_in_fraction, split_at_random, split_exactly
from millrace.operators.sets import intersect_distinct, union_all
from millrace.plans.registry import Tables, query
from millrace.plans.rows import FIELDS_SQL, round_sql
from millrace.workspace import materialize

NUMBERS = ["l_extendedprice", "l_quantity", "l_discount", "l_tax"]


# --- joins ---------------------------------------------------------------------------------------


@query(
    "inner_join",
    "SELECT o_orderkey, o_custkey, c_name, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey",
)
def inner_join(t: Tables) -> DataFrame:
    orders = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    customers = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return skew_safe_join(orders, customers, "o_custkey", salt_by=["o_orderkey"])


def with_region(t: Tables, customers: DataFrame) -> DataFrame:
    # one lookup after the other: joined to each other first, they look as large as the product of their sizes
    nations = lookup_join(customers, t.nation.select("n_nationkey", "n_name", "n_regionkey"), "c_nationkey", "n_nationkey")
    return lookup_join(nations, t.region.select("r_regionkey", "r_name"), "n_regionkey", "r_regionkey")


@query(
    "lookup_join",
    """SELECT c_custkey, n_name, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey""",
)
def lookups(t: Tables) -> DataFrame:
    return with_region(t, t.customer.select("c_custkey", "c_nationkey")).select("c_custkey", "n_name", "r_name")


@query(
    "cascade",
    """SELECT c_mktsegment, round(avg(o_totalprice), 4) AS avg_price, max(o_totalprice) AS max_price
       FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_totalprice > 100000 GROUP BY c_mktsegment""",
)
def cascade(t: Tables) -> DataFrame:
    # one row per customer before the join: a customer with very many orders stays one row
    spent = (
        t.orders.where(F.col("o_totalprice") > 100000)
        .groupBy("o_custkey")
        .agg(F.sum("o_totalprice").alias("s"), F.count("*").alias("n"), F.max("o_totalprice").alias("m"))
    )
    joined = spent.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return joined.groupBy("c_mktsegment").agg(
        F.round(F.sum("s") / F.sum("n"), 4).alias("avg_price"), F.max("m").alias("max_price")
    )


# --- set operations ------------------------------------------------------------------------------


@query(
    "union_all",
    "SELECT c_nationkey AS nationkey FROM customer UNION ALL SELECT s_nationkey FROM supplier",
)
def union_of_nations(t: Tables) -> DataFrame:
    return union_all(t.customer.select(F.col("c_nationkey").alias("nationkey")), _supplier_nations(t))


@query(
    "intersect_distinct",
    "SELECT c_nationkey AS nationkey FROM customer INTERSECT SELECT s_nationkey FROM supplier",
)
def common_nations(t: Tables) -> DataFrame:
    return intersect_distinct(t.customer.select(F.col("c_nationkey").alias("nationkey")), _supplier_nations(t))


def _supplier_nations(t: Tables) -> DataFrame:
    return t.supplier.select(F.col("s_nationkey").alias("nationkey"))


@query("distinct_values", "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem")
def distinct_values(t: Tables) -> DataFrame:
    return t.lineitem.select("l_returnflag", "l_linestatus").distinct()


# --- aggregates ----------------------------------------------------------------------------------


@query("reduce_sum", "SELECT CAST(sum(p_size) AS BIGINT) AS total FROM part")
def reduce_sum(t: Tables) -> DataFrame:
    return t.part.agg(F.sum("p_size").alias("total"))


@query(
    "shortest_longest",
    """SELECT (SELECT text FROM documents ORDER BY length(text), text LIMIT 1) AS shortest,
              (SELECT text FROM documents ORDER BY length(text) DESC, text DESC LIMIT 1) AS longest""",
)
def shortest_longest(t: Tables) -> DataFrame:
    return shortest_and_longest(t.documents, "text")


@query(
    "concat_ordered",
    """SELECT conv_id, CAST(coalesce(before, 0) // 2000 AS BIGINT) AS piece, string_agg(text, '' ORDER BY turn) AS text
       FROM (SELECT conv_id, turn, text, sum(strlen(text)) OVER (
                 PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
             FROM conversations) GROUP BY conv_id, piece""",
)
def whole_conversations(t: Tables) -> DataFrame:
    return concat_ordered(t.conversations, ["conv_id"], ["turn"], "text", bytes_per_piece=2000)


@query(
    "global_mean",
    """SELECT round(avg(l_quantity), 6) AS mean, CAST(trunc(sum(l_quantity) / count(*)) AS BIGINT) AS whole_mean
       FROM lineitem""",
)
def global_mean(t: Tables) -> DataFrame:
    return sum_count_mean(t.lineitem, [], "l_quantity").select(F.round("mean", 6).alias("mean"), "whole_mean")


@query(
    "avg_by_key",
    """SELECT p_brand, CAST(sum(p_size) AS BIGINT) AS total, count(*) AS n, round(avg(p_size), 6) AS mean,
              CAST(sum(p_size) // count(*) AS BIGINT) AS whole_mean FROM part GROUP BY p_brand""",
)
def avg_by_key(t: Tables) -> DataFrame:
    return sum_count_mean(t.part, ["p_brand"], "p_size").withColumn("mean", F.round("mean", 6))


@query("min_by_key", "SELECT o_orderpriority, min(o_totalprice) AS cheapest FROM orders GROUP BY o_orderpriority")
def min_by_key(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_orderpriority").agg(F.min("o_totalprice").alias("cheapest"))


@query("group_count", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def group_count(t: Tables) -> DataFrame:
    return t.events.groupBy("event_type").agg(F.count("*").alias("n"))


@query(
    "group_avg_max",
    "SELECT event_type, round(avg(value), 6) AS avg_value, max(value) AS max_value FROM events GROUP BY event_type",
)
def group_avg_max(t: Tables) -> DataFrame:
    return t.events.groupBy("event_type").agg(
        F.round(F.avg("value"), 6).alias("avg_value"), F.max("value").alias("max_value")
    )


@query(
    "count_if",
    "SELECT count(*) FILTER (event_type = 'click') AS clicks, count(*) FILTER (value > 50) AS large FROM events",
)
def two_counters(t: Tables) -> DataFrame:
    return count_where(t.events, {"clicks": F.col("event_type") == "click", "large": F.col("value") > 50})


@query(
    "observed_counts",
    """SELECT count(*) AS n, count(*) FILTER (event_type = 'click') AS clicks, count(*) FILTER (value > 50) AS large
       FROM events""",
)
def counters_beside_a_write(t: Tables) -> DataFrame:
    watched = {"clicks": F.col("event_type") == "click", "large": F.col("value") > 50}
    events, seen = observe_counts(t.events, "events", watched)
    written = materialize(events, "observed")
    counts = [F.lit(seen.get[name]).cast("bigint").alias(name) for name in watched]
    return written.agg(F.count("*").alias("n")).select("n", *counts)


@query("random_parts", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def random_parts_together(t: Tables) -> DataFrame:
    # the parts change with the layout of the rows; together they are the table
    first, second = split_at_random(t.events.select("event_id", "event_type"), [0.7, 0.3], seed=1)
    return union_all(first, second).groupBy("event_type").agg(F.count("*").alias("n"))


_REGION_ORDERS_SQL = """FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey"""
_RATE_SQL = "count(*) AS total, CAST(sum({flag}) AS BIGINT) AS hits, round(sum({flag}) * 100 / count(*)) AS percent"
_FINISHED_SQL = _RATE_SQL.format(flag="CAST(o_orderstatus = 'F' AS INTEGER)")


def _region_rates(t: Tables, keys: list[str]) -> DataFrame:
    # orders are counted per customer first; only those counts take part in the joins
    per_customer = partial_rate(
        t.orders, ["o_custkey", *[k for k in keys if k.startswith("o_")]], F.col("o_orderstatus") == "F"
    )
    joined = per_customer.join(t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    # summed per nation before any lookup: the 25 keys of the lookup meet a few rows each
    own = ["c_nationkey", *[k for k in keys if k.startswith("o_")]]
    per_nation = joined.groupBy(*own).agg(F.sum("n").alias("n"), F.sum("hits").alias("hits"))
    return rate_report(with_region(t, per_nation), keys, "hits", "n").orderBy(*keys)


@query("rate_report", f"SELECT r_name, {_FINISHED_SQL} {_REGION_ORDERS_SQL} GROUP BY r_name ORDER BY 1")
def finished_by_region(t: Tables) -> DataFrame:
    return _region_rates(t, ["r_name"])


@query(
    "rate_report_2key",
    f"SELECT r_name, o_orderpriority, {_FINISHED_SQL} {_REGION_ORDERS_SQL} GROUP BY 1, 2 ORDER BY 1, 2",
)
def finished_by_region_and_priority(t: Tables) -> DataFrame:
    return _region_rates(t, ["r_name", "o_orderpriority"])


@query(
    "rate_report_bucket",
    f"""SELECT CAST({round_sql('n_chars / 1000')} * 1000 AS DOUBLE) AS length, {_RATE_SQL.format(flag='toxic')}
        FROM labels JOIN documents USING (doc_id) GROUP BY 1""",
)
def toxic_by_length(t: Tables) -> DataFrame:
    labelled = t.labels.join(t.documents.select("doc_id", "n_chars"), "doc_id")
    bucketed = labelled.withColumn("length", bucket_nearest(F.col("n_chars"), 1000.0))
    return rate_report(bucketed, ["length"], "toxic")


@query(
    "mean_std",
    " UNION ALL ".join(
        f"SELECT '{c}' AS name, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS deviation FROM lineitem"
        for c in NUMBERS
    ),
)
def mean_std(t: Tables) -> DataFrame:
    stats = mean_and_deviation(t.lineitem, NUMBERS)
    return stats.select("name", F.round("mean", 6).alias("mean"), F.round("deviation", 6).alias("deviation"))


@query(
    "corr_report",
    " UNION ALL ".join(
        f"SELECT '{c}' AS name, round(corr(l_extendedprice, {c}), 6) AS correlation FROM lineitem"
        for c in NUMBERS[1:]
    ),
)
def corr_report(t: Tables) -> DataFrame:
    report = correlation_report(t.lineitem, "l_extendedprice", NUMBERS[1:])
    return report.withColumn("correlation", F.round("correlation", 6))


@query(
    "covariance",
    " UNION ALL ".join(
        f"""SELECT '{a}' AS "left", '{b}' AS "right", round(covar_samp({a}, {b}), 4) + 0.0 AS covariance
            FROM lineitem"""
        for i, a in enumerate(NUMBERS)
        for b in NUMBERS[i:]
    ),
)
def covariance(t: Tables) -> DataFrame:
    return covariance_report(t.lineitem, NUMBERS).withColumn("covariance", F.round("covariance", 4) + 0.0)


# whole numbers of 2^-52: a sum of doubles above 1 without rounding, turned into one double by its text
_EXACT_SUM_SQL = """CAST(CAST(sum(CAST({x} * 4503599627370496::DOUBLE AS HUGEINT)) AS VARCHAR) AS DOUBLE)
                    / 4503599627370496::DOUBLE"""


@query(
    "exact_sum_by_key",
    f"""SELECT l_returnflag, count(l_extendedprice) AS n, {_EXACT_SUM_SQL.format(x='l_extendedprice')} AS total
        FROM lineitem GROUP BY l_returnflag""",
)
def exact_sum_by_key(t: Tables) -> DataFrame:
    return exact_sums(t.lineitem, ["l_returnflag"], "l_extendedprice").select("l_returnflag", "n", "total")


@query(
    "mean_std_exact",
    " UNION ALL ".join(
        f"SELECT '{c}' AS name, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS deviation FROM lineitem"
        for c in NUMBERS
    ),
)
def mean_std_exact(t: Tables) -> DataFrame:
    stats = exact_mean_and_deviation(t.lineitem, NUMBERS)
    return stats.select("name", F.round("mean", 6).alias("mean"), F.round("deviation", 6).alias("deviation"))


@query(
    "corr_report_exact",
    " UNION ALL ".join(
        f"SELECT '{c}' AS name, round(corr(l_extendedprice, {c}), 6) AS correlation FROM lineitem"
        for c in NUMBERS[1:]
    ),
)
def corr_report_exact(t: Tables) -> DataFrame:
    report = exact_correlations(t.lineitem, "l_extendedprice", NUMBERS[1:])
    return report.withColumn("correlation", F.round("correlation", 6))


@query(
    "covariance_exact",
    " UNION ALL ".join(
        f"""SELECT '{a}' AS "left", '{b}' AS "right", round(covar_samp({a}, {b}), 4) + 0.0 AS covariance
            FROM lineitem"""
        for i, a in enumerate(NUMBERS)
        for b in NUMBERS[i:]
    ),
)
def covariance_exact(t: Tables) -> DataFrame:
    return exact_covariances(t.lineitem, NUMBERS).withColumn("covariance", F.round("covariance", 4) + 0.0)


# --- checks of predictions -----------------------------------------------------------------------


def _length_rule(t: Tables) -> DataFrame:
    """A one-line classifier: long documents are taken to be good ones."""
    labelled = t.labels.join(t.documents.select("doc_id", "n_chars"), "doc_id")
    return labelled.select(F.col("quality").alias("label"), (F.col("n_chars") > 400).cast("int").alias("prediction"))


_RULE_SQL = """SELECT quality AS label, CAST(n_chars > 400 AS INTEGER) AS prediction
               FROM labels JOIN documents USING (doc_id)"""


@query("confusion_matrix", f"SELECT label, prediction, count(*) AS n FROM ({_RULE_SQL}) GROUP BY label, prediction")
def rule_confusion(t: Tables) -> DataFrame:
    return confusion_matrix(_length_rule(t))


@query("accuracy", f"SELECT round(avg(CAST(label = prediction AS DOUBLE)), 6) AS accuracy FROM ({_RULE_SQL})")
def rule_accuracy(t: Tables) -> DataFrame:
    return accuracy(_length_rule(t)).select(F.round("accuracy", 6).alias("accuracy"))


@query(
    "r2_score",
    """SELECT round(1 - avg((y - p) * (y - p)) / var_pop(y), 6) AS r2
       FROM (SELECT l_extendedprice AS y, l_quantity * 2000 AS p FROM lineitem)""",
)
def r2_score(t: Tables) -> DataFrame:
    scored = t.lineitem.select(
        F.col("l_extendedprice").alias("label"), (F.col("l_quantity") * 2000).alias("prediction")
    )
    return r_squared(scored).select(F.round("r2", 6).alias("r2"))


@query(
    "split_by_key",
    """SELECT o_orderkey, CASE WHEN substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8) < 'b3333333'
                               THEN 'train' ELSE 'test' END AS part FROM orders""",
)
def split_labels(t: Tables) -> DataFrame:
    part = F.when(key_in_fraction(F.col("o_orderkey"), 0.7), F.lit("train")).otherwise(F.lit("test"))
    return t.orders.select("o_orderkey", part.alias("part"))


@query(
    "split_exactly",
    """WITH placed AS (SELECT o_orderkey, o_orderstatus, count(*) OVER (PARTITION BY o_orderstatus) AS n,
                              row_number() OVER (PARTITION BY o_orderstatus
                                                 ORDER BY md5(CAST(o_orderkey AS VARCHAR)), o_orderkey) AS place FROM orders)
       SELECT o_orderkey, o_orderstatus, CAST(place > floor(n * 0.7::DOUBLE + 0.5) AS INTEGER)
              + CAST(place > floor(n * 0.9::DOUBLE + 0.5) AS INTEGER) AS part FROM placed""",
)
def exact_parts(t: Tables) -> DataFrame:
    """Training, validation and test rows, exactly 70, 20 and 10 per cent of each status."""
    return split_exactly(t.orders.select("o_orderkey", "o_orderstatus"), "o_orderkey", [7, 2, 1], ["o_orderstatus"])


# a word is frequent if it is more than one of so many
WORDS_PER_FREQUENT = 500


@query(
    "frequent_words",
    f"""WITH words AS (SELECT unnest({FIELDS_SQL.format(col='text', sep=' ')}) AS word FROM documents)
        SELECT word, count(*) AS n FROM words GROUP BY word
        HAVING count(*) > (SELECT count(*) FROM words) // {WORDS_PER_FREQUENT}""",
)
def frequent_words(t: Tables) -> DataFrame:
    """All words above a share of all words; rare words, most of the vocabulary, are never counted."""
    # read three times, so the texts stay where they are
    words = t.documents.select(F.explode(split_fields(F.col("text"), " ")).alias("word"))
    rows = words.count()
    return frequent_keys(words, "word", rows // WORDS_PER_FREQUENT, rows)
