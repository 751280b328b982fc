import math

import pytest
from pyspark.ml.feature import Tokenizer
from pyspark.sql import functions as F

from millrace import functions as M


def one(spark, expression, **columns):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in columns.items()])
    return df.select(expression.alias("out")).first()["out"]


@pytest.mark.parametrize(
    "text, sep, parts",
    [
        ("a,b,,c", ",", ["a", "b", "", "c"]),
        ("a,b,,", ",", ["a", "b"]),
        (",,", ",", []),
        ("", ",", [""]),
        (" a b ", " ", ["", "a", "b"]),
        ("a.b", ".", ["a", "b"]),
        ("x|y||", "|", ["x", "y"]),
    ],
)
def test_split_fields_keeps_inner_and_drops_trailing_empties(spark, text, sep, parts):
    assert one(spark, M.split_fields(F.col("t"), sep), t=text) == parts


TEXTS = ["The  Da,Vinci ", "", "   ", " \tA\nb\r\n", "plain", "a b c", "x\x0by", "tail\n\n"]


def test_tokens_equal_the_tokenizer(spark, rows):
    df = rows([(t,) for t in TEXTS], "text string")
    both = Tokenizer(inputCol="text", outputCol="words").transform(df).withColumn("mine", M.tokens(F.col("text")))
    for row in both.collect():
        assert row["mine"] == row["words"], row["text"]


def test_tokens_of_the_worked_example(spark):
    assert one(spark, M.tokens(F.col("t")), t="The  Da,Vinci ") == ["the", "", "da,vinci"]


@pytest.mark.parametrize(
    "pattern, yes, no",
    [
        (M.SIGNED_DECIMAL, ["1", "-2.5", "+.5", "007"], ["", ".", "1.", "a1", "1e5", "--1"]),
        (M.ONE_DIGIT_FRACTION, ["5", "5.", "5.1", "-12.3", "123"], ["", ".5", "5.12", "x"]),
        (M.OPTIONAL_DIGITS, ["", ".", "1.", ".5", "-", "12.34"], ["1a", "1.2.3", "?"]),
    ],
)
def test_numeric_patterns(rows, pattern, yes, no):
    df = rows([(t,) for t in yes + no], "t string").withColumn("ok", M.is_number(F.col("t"), pattern))
    assert {r["t"]: r["ok"] for r in df.collect()} == {**dict.fromkeys(yes, True), **dict.fromkeys(no, False)}


def test_render_list(spark):
    assert one(spark, M.render_list(F.col("a"), F.col("b")), a="x", b="y") == "[x, y]"


@pytest.mark.parametrize(
    "value, expected",
    [(2.5, 3), (-2.5, -2), (2.4, 2), (-2.6, -3), (0.49999999999999994, 0), (0.5, 1), (-0.5, 0), (1e12 + 0.5, 1e12 + 1)],
)
def test_round_half_up(spark, value, expected):
    assert one(spark, M.round_half_up(F.col("v")), v=value) == expected


@pytest.mark.parametrize("age, bucket", [(24, 20), (25, 30), (104, 100), (105, 110), (0, 0), (30, 30)])
def test_both_age_buckets(spark, age, bucket):
    assert one(spark, M.bucket_nearest(F.col("v")), v=age) == bucket
    assert one(spark, M.bucket_by_last_digit(F.col("v")), v=age) == bucket


def test_means_across_columns(spark):
    cols = [F.col(c) for c in "abc"]
    data = {"a": -4, "b": 2, "c": 3}
    assert one(spark, M.mean_across(cols), **data) == pytest.approx(1 / 3)
    assert one(spark, M.mean_abs_across(cols), **data) == 3
    assert one(spark, M.truncated_mean_abs_across([F.col("a"), F.col("c")]), **data) == 3


@pytest.mark.parametrize("paid, billed, percent", [(0, 500, 0), (499, 999, 50), (1200, 1199, 100), (100, 0, 10000)])
def test_bin_percent(spark, paid, billed, percent):
    assert one(spark, M.bin_percent(F.col("p"), F.col("b")), p=float(paid), b=float(billed)) == percent


@pytest.mark.parametrize("paid, billed, percent", [(5, 0, 100), (5, 9, 0), (25, 10, 200), (10, 10, 100)])
def test_whole_percent(spark, paid, billed, percent):
    assert one(spark, M.whole_percent(F.col("p"), F.col("b")), p=paid, b=billed) == percent


def test_number_or(rows):
    df = rows([("12",), ("?",), (None,), ("-3.5",)], "t string")
    assert [r[0] for r in df.select(M.number_or(F.col("t"), 80.0)).collect()] == [12.0, 80.0, 80.0, -3.5]
    assert [r[0] for r in df.select(M.number_or(F.col("t"), None)).collect()] == [12.0, None, None, -3.5]


def test_recode_and_normalise(rows):
    df = rows([("M",), ("F",), ("2",), ("x",), (None,)], "t string")
    assert [r[0] for r in df.select(M.normalise_code(F.col("t"), {"M": 1.0, "F": 2.0})).collect()] == [
        1.0, 2.0, 2.0, None, None,
    ]
    assert [r[0] for r in df.select(M.normalise_code(F.col("t"), {"M": 1.0}, otherwise=2.0)).collect()] == [
        1.0, 2.0, 2.0, 2.0, 2.0,
    ]
    assert [r[0] for r in df.select(M.recode(F.col("t"), {"2": "two", "3": "three"}, "one")).collect()] == [
        "one", "one", "two", "one", "one",
    ]


def test_recode_by_substring_takes_the_first_listed_word(rows):
    df = rows([("5.1,setosa",), ("6,virginica",), ("7,versicolor",), ("Species",)], "t string")
    codes = {"setosa": "1", "virginica": "2", "versicolor": "3"}
    assert [r[0] for r in df.select(M.recode_by_substring(F.col("t"), codes)).collect()] == [
        "5.1,1", "6,2", "7,3", "Species",
    ]


def test_indicators(rows):
    df = rows([("single",), ("married",), (None,)], "marital string")
    wide = df.withColumns(M.indicators("marital", ["single", "married", "divorced"]))
    assert [tuple(r)[1:] for r in wide.collect()] == [(1.0, 0.0, 0.0), (0.0, 1.0, 0.0), (0.0, 0.0, 0.0)]


def test_two_level_keeps_the_given_type(rows):
    df = rows([("two",), ("four",)], "doors string").select(M.two_level(F.col("doors"), "two", 2, 4).alias("d"))
    assert df.dtypes == [("d", "int")] and [r.d for r in df.collect()] == [2, 4]
    assert not math.isnan(df.first().d)


def test_only_plain_numbers_are_numbers(rows):
    from millrace.functions import bin_percent, number_or

    texts = ["12d", "1f", "NaN", "Infinity", "-Infinity", "0x1", "", "1.2.3", None, " 7 ", "-.5", "3.", "1e3"]
    df = rows([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(number_or(df["t"], -1)).collect()]
    assert got == [-1.0] * 9 + [7.0, -0.5, 3.0, 1000.0]
    ratio = rows([(1.0, -1.0), (1.0, 1.0)], "a double, b double")
    assert [r[0] for r in ratio.select(bin_percent(ratio["a"], ratio["b"])).collect()] == [None, 50.0]
