"""Credit-card defaults from raw statements to rate reports, correlations, models and customer groups.

Each step is a lazy DataFrame function; the whole analysis is one plan up to the models.
"""

from __future__ import annotations

from pyspark.ml.base import Estimator
from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.functions import (
    bin_percent,
    bucket_by_last_digit,
    bucket_nearest,
    mean_abs_across,
    mean_across,
    normalise_code,
    number_or,
    truncated_mean_abs_across,
    whole_percent,
)
from millrace.operators.aggregates import correlation_report, rate_report
from millrace.operators.features import assemble, center_and_scale
from millrace.operators.joins import lookup_join
from millrace.operators.models import classifiers, compare_classifiers, fit_clusters
from millrace.operators.partitions import stated_layout
from millrace.operators.sampling import split_by_key
from millrace.plans.registry import Tables, query
from millrace.plans.rows import round_sql
from millrace.sources import inline_table
from millrace.workspace import materialize

# Raw columns, in file order.
MONTHS = range(1, 7)
DELAYS = [f"PAY_{m}" for m in MONTHS]
BILLS = [f"BILL_AMT{m}" for m in MONTHS]
PAYMENTS = [f"PAY_AMT{m}" for m in MONTHS]
RAW_COLUMNS = [
    "CUSTID", "LIMIT_BAL", "SEX", "EDUCATION", "MARRIAGE", "AGE", *DELAYS, *BILLS, *PAYMENTS, "DEFAULTED",
]
RAW_SCHEMA = ", ".join(f"{c} string" for c in RAW_COLUMNS)

# How garbage lines begin, and what the codes mean.
GARBAGE_PREFIX = "aaaaa"
SEX_LETTERS = {"M": 1.0, "F": 2.0}
SEX_NAMES = [(1.0, "Male"), (2.0, "Female")]
EDUCATION_NAMES = [(1.0, "Graduate"), (2.0, "University"), (3.0, "High School"), (4.0, "Others")]
MARRIAGE_NAMES = [(1.0, "Single"), (2.0, "Married"), (3.0, "Others")]

# The columns of the features, in order; the models read the eight between customer and outcome.
FEATURE_COLUMNS = [
    "CustId", "LimitBal", "Sex", "Education", "Marriage", "Age",
    "AvgPayDur", "AvgBillAmt", "AvgPayAmt", "PerPaid", "Defaulted",
]
MODEL_COLUMNS = FEATURE_COLUMNS[2:10]
GROUP_COLUMNS = FEATURE_COLUMNS[2:6]


def clean(raw: DataFrame, unknown_sex: float | None = None) -> DataFrame:
    """Drop rows without a usable customer id, and make numbers of all columns.

    Text that is no number becomes 0, and a sex code that is neither a letter nor a number ``unknown_sex``.
    """
    good = raw.where(~F.col("CUSTID").startswith(GARBAGE_PREFIX) & F.col("CUSTID").try_cast("double").isNotNull())
    typed = {c: number_or(F.col(c), 0) for c in RAW_COLUMNS if c != "SEX"}
    return good.withColumns({**typed, "SEX": normalise_code(F.col("SEX"), SEX_LETTERS, unknown_sex)})


def features(cleaned: DataFrame) -> DataFrame:
    """One row per customer with averages over six months, the age decade and the share paid."""
    averages = cleaned.select(
        F.col("CUSTID").alias("CustId"),
        F.col("LIMIT_BAL").alias("LimitBal"),
        F.col("SEX").alias("Sex"),
        F.col("EDUCATION").alias("Education"),
        F.col("MARRIAGE").alias("Marriage"),
        bucket_nearest(F.col("AGE")).alias("Age"),
        mean_abs_across([F.col(c) for c in DELAYS]).alias("AvgPayDur"),
        F.abs(mean_across([F.col(c) for c in BILLS])).alias("AvgBillAmt"),
        F.abs(mean_across([F.col(c) for c in PAYMENTS])).alias("AvgPayAmt"),
        F.col("DEFAULTED").alias("Defaulted"),
    )
    paid = bin_percent(F.col("AvgPayAmt"), F.col("AvgBillAmt"))
    return averages.withColumn("PerPaid", paid).select(*FEATURE_COLUMNS)


def whole_number_features(cleaned: DataFrame) -> DataFrame:
    """The variant in whole numbers: all raw columns, with averages of the first five months cut to integers."""
    whole = cleaned.select(*[F.col(c).cast("int").alias(c) for c in RAW_COLUMNS])
    first_five = slice(0, 5)
    averages = whole.withColumns(
        {
            "AGE": bucket_by_last_digit(F.col("AGE")),
            "AVG_DELAY": truncated_mean_abs_across([F.col(c) for c in DELAYS[first_five]]),
            "AVG_BILL": truncated_mean_abs_across([F.col(c) for c in BILLS[first_five]]),
            "AVG_PAYMENT": truncated_mean_abs_across([F.col(c) for c in PAYMENTS[first_five]]),
        }
    )
    return averages.withColumn("PER_PAID", whole_percent(F.col("AVG_PAYMENT"), F.col("AVG_BILL")))


def with_names(rows: DataFrame, how: str = "inner") -> DataFrame:
    """Add ``sexName``, ``eduName`` and ``marriageName``; ``how="left"`` keeps rows with unknown codes."""
    spark = rows.sparkSession
    # fixed values: the names of the lookup columns
    for key, names, id_column, name_column in (
        ("Sex", SEX_NAMES, "sexId", "sexName"),
        ("Education", EDUCATION_NAMES, "eduId", "eduName"),
        ("Marriage", MARRIAGE_NAMES, "marriageId", "marriageName"),
    ):
        lookup = inline_table(spark, names, f"{id_column} double, {name_column} string")
        rows = lookup_join(rows, lookup, key, id_column, how)
    return rows


def default_rates(named: DataFrame, *keys: str) -> DataFrame:
    return rate_report(named, keys, "Defaulted").orderBy(*keys)


def default_correlations(rows: DataFrame) -> DataFrame:
    return correlation_report(rows, "Defaulted", FEATURE_COLUMNS)


def compare_models(rows: DataFrame, estimators: dict[str, Estimator] | None = None) -> DataFrame:
    """Accuracy of each classifier on the same 30 per cent of the customers."""
    # read many times by the training loops: written once, so no lost executor repeats the joins
    prepared = materialize(stated_layout(rows.select("CustId", "Defaulted", *MODEL_COLUMNS), key=["CustId"]), "credit-features")
    vectors = assemble(prepared, MODEL_COLUMNS).select("CustId", "Defaulted", "features")
    train, test = split_by_key(vectors.withColumn("id", F.col("CustId").cast("bigint")), "id", 0.7)
    return compare_classifiers(train, test, "Defaulted", estimators or classifiers())


def customer_groups(rows: DataFrame, k: int = 4, seed: int = 1) -> DataFrame:
    """``CustId`` and ``prediction``: the group by centred and scaled sex, education, marriage and age."""
    prepared = materialize(stated_layout(rows.select("CustId", *GROUP_COLUMNS), key=["CustId"]), "credit-groups")
    points = assemble(center_and_scale(prepared, GROUP_COLUMNS), GROUP_COLUMNS).select("CustId", "features")
    return fit_clusters(points, k, seed).transform(points).select("CustId", "prediction")


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """Raw statements: CSV with a header, every cell as text until ``clean``."""
    return spark.read.schema(RAW_SCHEMA).option("header", True).csv(path)


# --- the same analysis over the standard tables ----------------------------------------------------

# Two months of the year make one statement period. Orders are the bills, finished orders the
# payments, and the number of open orders, three of them being normal, the delay.


def statements(t: Tables) -> DataFrame:
    """Raw statement rows, as text, for every customer: orders summed per period."""
    bills = t.orders.select(
        "o_custkey",
        (F.floor((F.month("o_orderdate") - 1) / 2) + 1).alias("period"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("price"),
        (F.col("o_orderstatus") == "F").alias("finished"),
        (F.col("o_orderstatus") == "O").alias("open"),
    )
    period, price, finished, open_ = (F.col(c) for c in ("period", "price", "finished", "open"))
    per_customer = bills.groupBy("o_custkey").agg(
        *[(F.count_if((period == m) & open_) - 3).alias(f"PAY_{m}") for m in MONTHS],
        *[F.sum(F.when(period == m, price)).alias(f"BILL_AMT{m}") for m in MONTHS],
        *[F.sum(F.when((period == m) & finished, price)).alias(f"PAY_AMT{m}") for m in MONTHS],
        F.when(F.count_if(finished) < F.count_if(open_), 1).otherwise(0).alias("DEFAULTED"),
    )
    sex = F.when(F.col("c_mktsegment") == "BUILDING", "M").when(F.col("c_mktsegment") == "MACHINERY", "F")
    people = t.customer.select(
        F.col("c_custkey").alias("CUSTID"),
        F.floor("c_acctbal").alias("LIMIT_BAL"),
        sex.otherwise(F.when(F.col("c_acctbal") < 4000, "1").otherwise("2")).alias("SEX"),
        (F.col("c_nationkey") % 4 + 1).alias("EDUCATION"),
        (F.col("c_nationkey") % 3 + 1).alias("MARRIAGE"),
        (F.floor(F.abs("c_acctbal") / 200) + 20).alias("AGE"),
    )
    # one row per customer on both sides
    rows = people.join(per_customer, F.col("CUSTID") == F.col("o_custkey"), "left")
    return rows.select(*[F.col(c).cast("string").alias(c) for c in RAW_COLUMNS])


def _statement_sql() -> str:
    """The SQL form of ``statements`` and ``clean``: typed columns, one row per customer."""
    period = "((month(o_orderdate) - 1) // 2 + 1)"
    sums = []
    for m in MONTHS:
        sums += [
            f"count(*) FILTER ({period} = {m} AND o_orderstatus = 'O') - 3 AS d{m}",
            f"sum(CAST(o_totalprice AS DECIMAL(18, 2))) FILTER ({period} = {m}) AS b{m}",
            f"sum(CAST(o_totalprice AS DECIMAL(18, 2))) FILTER ({period} = {m} AND o_orderstatus = 'F') AS p{m}",
        ]
    number = "CAST(coalesce({0}, 0) AS DOUBLE)"
    d, b, p = ([number.format(f"{kind}{m}") for m in MONTHS] for kind in "dbp")
    return f"""
        SELECT CAST(c_custkey AS DOUBLE) AS "CustId", coalesce(floor(c_acctbal), 0) AS "LimitBal",
               CAST(CASE c_mktsegment WHEN 'BUILDING' THEN 1 WHEN 'MACHINERY' THEN 2
                    ELSE CASE WHEN c_acctbal < 4000 THEN 1 ELSE 2 END END AS DOUBLE) AS "Sex",
               CAST(c_nationkey % 4 + 1 AS DOUBLE) AS "Education", CAST(c_nationkey % 3 + 1 AS DOUBLE) AS "Marriage",
               coalesce(floor(abs(c_acctbal) / 200) + 20, 0) AS age, ({' + '.join(f'abs({x})' for x in d)}) / 6 AS delay,
               abs(({' + '.join(b)}) / 6) AS "AvgBillAmt", abs(({' + '.join(p)}) / 6) AS "AvgPayAmt",
               CAST(coalesce(late, 0) AS DOUBLE) AS "Defaulted"
        FROM customer LEFT JOIN (
            SELECT o_custkey, {', '.join(sums)}, CASE WHEN count(*) FILTER (o_orderstatus = 'F')
                   < count(*) FILTER (o_orderstatus = 'O') THEN 1 ELSE 0 END AS late
            FROM orders GROUP BY o_custkey) ON c_custkey = o_custkey"""


_FEATURES_SQL = f"""
    SELECT "CustId", "LimitBal", "Sex", "Education", "Marriage", CAST({round_sql('age / 10')} * 10 AS DOUBLE) AS "Age",
           CAST({round_sql('delay')} AS DOUBLE) AS "AvgPayDur", "AvgBillAmt", "AvgPayAmt",
           CAST({round_sql('"AvgPayAmt" / ("AvgBillAmt" + 1) * 100 / 25')} * 25 AS DOUBLE) AS "PerPaid", "Defaulted"
    FROM ({_statement_sql()})"""

_NAMED_SQL = f"""
    SELECT * FROM ({_FEATURES_SQL})
    JOIN (VALUES (1, 'Male'), (2, 'Female')) AS s(sexId, "sexName") ON "Sex" = sexId
    JOIN (VALUES (1, 'Graduate'), (2, 'University'), (3, 'High School'), (4, 'Others')) AS e(eduId, "eduName")
         ON "Education" = eduId
    JOIN (VALUES (1, 'Single'), (2, 'Married'), (3, 'Others')) AS m(marriageId, "marriageName") ON "Marriage" = marriageId"""

_RATES_SQL = """count(*) AS total, CAST(sum("Defaulted") AS BIGINT) AS hits,
    round(sum("Defaulted") * 100 / count(*)) AS percent"""


def _features(t: Tables) -> DataFrame:
    return features(clean(statements(t)))


@query(
    "credit_features",
    f"""SELECT * REPLACE (round("AvgBillAmt", 4) AS "AvgBillAmt", round("AvgPayAmt", 4) AS "AvgPayAmt")
        FROM ({_FEATURES_SQL})""",
)
def credit_features(t: Tables) -> DataFrame:
    rounded = {c: F.round(c, 4) for c in ("AvgBillAmt", "AvgPayAmt")}
    return _features(t).withColumns(rounded)


@query("credit_rate_by_sex", f'SELECT "sexName", {_RATES_SQL} FROM ({_NAMED_SQL}) GROUP BY "sexName"')
def credit_rate_by_sex(t: Tables) -> DataFrame:
    return default_rates(with_names(_features(t)), "sexName")


@query(
    "credit_rate_by_marriage_education",
    f'SELECT "marriageName", "eduName", {_RATES_SQL} FROM ({_NAMED_SQL}) GROUP BY 1, 2 ORDER BY 1, 2',
)
def credit_rate_by_marriage_education(t: Tables) -> DataFrame:
    return default_rates(with_names(_features(t)), "marriageName", "eduName")


@query("credit_rate_by_delay", f'SELECT "AvgPayDur", {_RATES_SQL} FROM ({_NAMED_SQL}) GROUP BY 1 ORDER BY 1')
def credit_rate_by_delay(t: Tables) -> DataFrame:
    return default_rates(with_names(_features(t)), "AvgPayDur")


@query(
    "credit_corr",
    f"WITH f AS ({_FEATURES_SQL}) "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS name, round(corr(\"Defaulted\", \"{c}\"), 6) AS correlation FROM f" for c in FEATURE_COLUMNS
    ),
)
def credit_corr(t: Tables) -> DataFrame:
    return default_correlations(_features(t)).withColumn("correlation", F.round("correlation", 6))


@query("model_compare")
def model_compare(t: Tables) -> DataFrame:
    return compare_models(with_names(_features(t)))


@query("credit_groups")
def credit_groups(t: Tables) -> DataFrame:
    return customer_groups(with_names(_features(t))).groupBy("prediction").agg(F.count("*").alias("n"))


def _whole_sql() -> str:
    """The SQL form of ``whole_number_features`` over the statements, from the typed columns behind them."""
    inner = _statement_sql()
    source = inner[inner.index("FROM customer") :]
    d, b, p = ([f"CAST(coalesce({kind}{m}, 0) AS INTEGER)" for m in MONTHS] for kind in "dbp")
    cut = lambda xs: f"CAST(trunc(({' + '.join(f'abs(CAST({x} AS DOUBLE))' for x in xs[:5])}) / 5) AS INTEGER)"
    raw = [f'{x} AS "{c}"' for x, c in zip([*d, *(f"CAST(trunc(coalesce({k}{m}, 0)) AS INTEGER)" for k in "bp" for m in MONTHS)], [*DELAYS, *BILLS, *PAYMENTS])]
    whole = lambda xs: [f"CAST(trunc(coalesce({x}, 0)) AS INTEGER)" for x in xs]
    bills, paid = whole([f"b{m}" for m in MONTHS]), whole([f"p{m}" for m in MONTHS])
    age = "CAST(coalesce(floor(abs(c_acctbal) / 200) + 20, 0) AS INTEGER)"
    return f"""
        SELECT *, CASE WHEN "AVG_BILL" = 0 THEN 100 ELSE CAST(trunc("AVG_PAYMENT" / "AVG_BILL") AS INTEGER) * 100 END AS "PER_PAID"
        FROM (SELECT CAST(c_custkey AS INTEGER) AS "CUSTID", CAST(coalesce(floor(c_acctbal), 0) AS INTEGER) AS "LIMIT_BAL",
                     CASE c_mktsegment WHEN 'BUILDING' THEN 1 WHEN 'MACHINERY' THEN 2
                          ELSE CASE WHEN c_acctbal < 4000 THEN 1 ELSE 2 END END AS "SEX",
                     CAST(c_nationkey % 4 + 1 AS INTEGER) AS "EDUCATION", CAST(c_nationkey % 3 + 1 AS INTEGER) AS "MARRIAGE",
                     CASE WHEN {age} % 10 < 5 THEN {age} - {age} % 10 ELSE {age} + 10 - {age} % 10 END AS "AGE",
                     {', '.join(raw)}, CAST(coalesce(late, 0) AS INTEGER) AS "DEFAULTED",
                     {cut(d)} AS "AVG_DELAY", {cut(bills)} AS "AVG_BILL", {cut(paid)} AS "AVG_PAYMENT"
              {source})"""


@query("credit_whole_numbers", _whole_sql())
def credit_whole_numbers(t: Tables) -> DataFrame:
    return whole_number_features(clean(statements(t)))
