import math
import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import aggregates as A
from millrace.operators.joins import fits_broadcast, hot_keys, lookup_join, salted_join, skew_safe_join
from millrace.operators.ordering import top_k, with_ordinal
from millrace.operators.partitions import partition_count, spread_small_input
from millrace.operators.sampling import key_in_fraction, split_at_random, split_by_key
from millrace.operators.sets import intersect_distinct, union_all
from millrace.workspace import materialize

INTS_A = [7, 0, -4, 7, 20, 7, 31, 0]
INTS_B = [31, 8, 0, -9, 31]


@pytest.fixture
def employees(rows):
    data = [("a", "male", 100, 51, 2700.0), ("b", "male", 100, 31, 4600.0), ("c", "female", 200, 44, 5500.0)]
    return rows(data, "name string, gender string, dept int, age int, salary double")


# --- joins ---


def skewed(n):
    """A third of the rows on key 0, a few null keys, the others spread out."""
    return [(i, 0 if i % 3 == 0 else (None if i % 50 == 1 else i % 17)) for i in range(n)]


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("rows_per_task", [10, 100, 10**6])
def test_salted_join_equals_the_plain_join(rows, values, how, rows_per_task):
    fact = rows(skewed(600), "id long, k long")
    other = rows([(k, f"v{k}") for k in range(0, 12)] + [(0, "again")], "k long, name string")
    expected = values(fact.join(other, "k", how), "id", "k", "name")
    result = salted_join(fact, other, "k", ["id"], how, rows_per_task=rows_per_task)
    assert values(result, "id", "k", "name") == expected


def test_salted_join_on_two_columns_with_given_counts(rows, values):
    data = [(i, i % 2, "x" if i % 4 else "y") for i in range(200)]
    fact = rows(data, "id long, a int, b string")
    other = rows([(0, "x", 1.0), (1, "x", 2.0)], "a int, b string, w double")
    counts = fact.groupBy("a", "b").agg(F.count("*").alias("n"))
    result = salted_join(fact, other, ["a", "b"], ["id"], key_counts=counts, rows_per_task=20)
    assert values(result, "id", "w") == values(fact.join(other, ["a", "b"]), "id", "w")


def test_hot_keys_get_one_piece_per_task(rows, values):
    counts = rows([("hot", 35), ("warm", 11), ("cold", 10)], "k string, n long")
    hot = {r["_hot"]: r["_pieces"] for r in hot_keys(counts, ["k"], "n", rows_per_task=10).collect()}
    named = {r.k: hot.get(r.h) for r in counts.select("k", F.xxhash64("k").alias("h")).collect()}
    assert named == {"hot": 4, "warm": 2, "cold": None}


def test_salting_spreads_a_hot_key(rows):
    fact = rows([(i, 7) for i in range(2000)], "id long, k long")
    other = rows([(7, "seven")], "k long, name string")
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    session = fact.sparkSession
    before = session.conf.get(threshold)
    session.conf.set(threshold, "-1")
    session.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = salted_join(fact, other, "k", ["id"], rows_per_task=50)
        sizes = [r["n"] for r in joined.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    finally:
        session.conf.set(threshold, before)
        session.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(sizes) == 2000 and len(sizes) > 4 and max(sizes) < 1000


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_skew_safe_join_broadcasts_only_what_is_small(spark, rows, values, tmp_path):
    fact = rows(skewed(300), "id long, k long")
    path = str(tmp_path / "other")
    rows([(k, f"v{k}") for k in range(12)], "k long, name string").write.parquet(path)
    other = spark.read.parquet(path)
    expected = values(fact.join(other, "k"), "id", "name")
    assert fits_broadcast(other) and not fits_broadcast(spark.range(10**9))
    small = skew_safe_join(fact, other, "k", ["id"])
    assert "_piece" not in plan_of(small) and values(small, "id", "name") == expected
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        large = skew_safe_join(fact, other, "k", ["id"])
        assert "_piece" in plan_of(large) and values(large, "id", "name") == expected
    finally:
        spark.conf.set(threshold, before)


def test_rows_are_counted_where_files_compress_well(spark, tmp_path):
    path = str(tmp_path / "constant")
    spark.range(2_000_000).selectExpr("1L AS k").write.parquet(path)
    assert not fits_broadcast(spark.read.parquet(path))


def test_lookup_join_drops_the_lookup_key(employees, rows, values):
    departments = rows([(100, "Sales")], "id int, department string")
    inner = lookup_join(employees, departments, "dept", "id")
    assert "id" not in inner.columns and values(inner, "name", "department") == [("a", "Sales"), ("b", "Sales")]
    left = lookup_join(employees, departments, "dept", "id", "left")
    assert values(left, "name", "department") == [("a", "Sales"), ("b", "Sales"), ("c", None)]


# --- order, sets, samples ---


def test_with_ordinal_numbers_rows_in_order(rows):
    data = list(range(1000))
    random.Random(1).shuffle(data)
    df = rows([(v, v % 7) for v in data], "v long, m long").repartition(6)
    numbered = with_ordinal(df, [F.col("m").desc(), F.col("v").asc()])
    expected = {v: i for i, v in enumerate(sorted(range(1000), key=lambda v: (-(v % 7), v)))}
    assert {r["v"]: r["ordinal"] for r in numbered.collect()} == expected


def test_with_ordinal_of_nothing(rows):
    assert with_ordinal(rows([], "v long"), [F.col("v")]).count() == 0


def test_top_k(rows):
    df = rows([(v,) for v in INTS_A], "v int")
    assert [r.v for r in top_k(df, 3, F.desc("v")).collect()] == [31, 20, 7]


def test_set_operations(rows, values):
    a, b = rows([(v,) for v in INTS_A], "v int"), rows([(v,) for v in INTS_B], "v int")
    assert [v for (v,) in values(union_all(a, b))] == sorted(INTS_A + INTS_B, key=lambda v: repr((v,)))
    assert sorted(v for (v,) in values(intersect_distinct(a, b))) == [0, 31]
    assert sorted(v for (v,) in values(a.distinct())) == [-4, 0, 7, 20, 31]
    words = rows([(w,) for w in ["hello", "war", "peace", "world"]], "w string")
    other = rows([(w,) for w in ["war", "peace", "universe"]], "w string")
    assert values(intersect_distinct(words, other)) == [("peace",), ("war",)]


def test_split_by_key_is_complete_and_repeatable(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    train, test = split_by_key(df, "k", 0.7)
    assert train.count() + test.count() == 5000 and 3300 < train.count() < 3700
    again = df.repartition(7).where(key_in_fraction(F.col("k"), 0.7))
    assert again.exceptAll(train).count() == 0 and again.count() == train.count()
    assert df.where(key_in_fraction(F.col("k"), 1.0)).count() == 5000
    assert df.where(key_in_fraction(F.col("k"), 0.0)).count() == 0


def test_split_at_random_keeps_all_rows(spark):
    parts = split_at_random(spark.range(1000), [0.9, 0.1], 3)
    assert sum(p.count() for p in parts) == 1000


def test_partitions(spark):
    assert partition_count(spark.range(100, numPartitions=5)).first()["n"] == 5
    assert spread_small_input(spark.range(100, numPartitions=1)).rdd.getNumPartitions() == 8
    huge = spark.range(10**12, numPartitions=1)
    assert spread_small_input(huge) is huge


# --- aggregates ---


def test_sum_count_mean(rows, values):
    df = rows([("k", 88), ("k", 145), ("m", 7)], "make string, hp int")
    assert values(A.sum_count_mean(df, ["make"], "hp")) == [("k", 233, 2, 116.5, 116), ("m", 7, 1, 7.0, 7)]
    assert values(A.sum_count_mean(df, [], "hp"), "total", "whole_mean") == [(240, 80)]


def test_rate_report_from_rows_and_from_partial_counts(rows, values):
    data = [("Male", 1), ("Male", 0), ("Male", 0), ("Female", 1), ("Female", 1), ("Female", 0), ("Female", 1)]
    df = rows(data, "sex string, defaulted int")
    expected = [("Female", 4, 3, 75.0), ("Male", 3, 1, 33.0)]
    assert values(A.rate_report(df, ["sex"], "defaulted")) == expected
    partial = A.partial_rate(df.withColumn("id", F.monotonically_increasing_id()), ["id", "sex"], F.col("defaulted") == 1)
    assert values(A.rate_report(partial, ["sex"], "hits", "n")) == expected


def test_shortest_and_longest_break_ties_by_value(rows):
    df = rows([("bb",), (None,), ("aa",), ("dddd",), ("cccc",), ("xxx",)], "t string")
    assert tuple(A.shortest_and_longest(df, "t").first()) == ("aa", "dddd")


def test_concat_ordered_in_pieces(rows):
    data = [("hot", i, f"{i},") for i in range(95)] + [("cold", 1, "b"), ("cold", 0, "a")]
    random.Random(2).shuffle(data)
    df = rows(data, "k string, turn long, text string").repartition(5)
    pieces = A.concat_ordered(df, ["k"], ["turn"], "text", bytes_per_piece=30).collect()
    hot = sorted((r.piece, r.text) for r in pieces if r.k == "hot")
    whole = "".join(f"{i}," for i in range(95))
    assert [p for p, _ in hot] == list(range(-(-len(whole) // 30)))
    assert "".join(t for _, t in hot) == whole and all(27 < len(t) < 33 for _, t in hot[:-1])
    assert [(r.piece, r.text) for r in pieces if r.k == "cold"] == [(0, "ab")]


def test_counters(rows):
    df = rows([("sedan",), ("hatchback",), ("sedan",)], "body string")
    conditions = {"sedans": F.col("body") == "sedan", "hatchbacks": F.col("body") == "hatchback"}
    assert tuple(A.count_where(df, conditions).first()) == (2, 1)
    watched, seen = A.observe_counts(df, "bodies", conditions)
    assert watched.count() == 3 and seen.get == {"sedans": 2, "hatchbacks": 1}


def test_statistics(rows, values):
    df = rows([(1.0, 2.0, -1.0), (2.0, 4.0, 0.5), (3.0, 6.0, -4.0)], "x double, y double, z double")
    stats = {r["name"]: (r["mean"], r["deviation"]) for r in A.mean_and_deviation(df, ["x", "y"]).collect()}
    assert stats == {"x": (2.0, 1.0), "y": (4.0, 2.0)}
    corr = {r["name"]: r["correlation"] for r in A.correlation_report(df, "x", ["x", "y", "z"]).collect()}
    assert corr["x"] == pytest.approx(1) and corr["y"] == pytest.approx(1) and corr["z"] == pytest.approx(-0.654654, abs=1e-6)
    cov = {(r["left"], r["right"]): r["covariance"] for r in A.covariance_report(df, ["x", "y"]).collect()}
    assert cov == {("x", "x"): pytest.approx(1), ("x", "y"): pytest.approx(2), ("y", "y"): pytest.approx(4)}


def test_correlation_uses_complete_pairs_and_survives_constants(rows):
    df = rows([(1.0, 2.0, 5.0), (2.0, None, 5.0), (None, 9.0, 5.0), (3.0, 6.0, 5.0)], "x double, y double, c double")
    report = {r["name"]: r["correlation"] for r in A.correlation_report(df, "x", ["y", "c"]).collect()}
    assert report == {"y": pytest.approx(1), "c": None}
    empty = A.correlation_report(df.where("false"), "x", ["y"]).first()
    assert empty["correlation"] is None


def test_empty_input_gives_nulls(rows):
    df = rows([], "x double, label double, prediction double")
    assert tuple(A.sum_count_mean(df, [], "x").first()) == (None, 0, None, None)
    assert A.r_squared(df).first()[0] is None and A.accuracy(df).first()[0] is None
    assert A.above_mean(df, "x").count() == 0


def test_above_mean(rows, values):
    df = rows([(v,) for v in [3, 6, 3, 4, 8]], "v int")
    assert values(A.above_mean(df, "v")) == [(6,), (8,)]


def test_prediction_checks(rows, values):
    df = rows([(1.0, 1.0), (1.0, 0.0), (0.0, 0.0), (0.0, 0.0)], "label double, prediction double")
    assert values(A.confusion_matrix(df)) == [(0.0, 0.0, 2), (1.0, 0.0, 1), (1.0, 1.0, 1)]
    assert A.accuracy(df).first()[0] == 0.75
    line = rows([(1.0, 1.5), (2.0, 2.0), (3.0, 2.5)], "label double, prediction double")
    assert A.r_squared(line).first()[0] == pytest.approx(0.75)


def test_cascade_filter_join_group(employees, rows, values):
    departments = rows([(100, "Sales"), (200, "Engineering")], "id int, department string")
    joined = lookup_join(employees.where("age > 30"), departments, "dept", "id")
    report = joined.groupBy("dept").agg(F.avg("salary"), F.max("age"))
    assert values(report) == [(100, 3650.0, 51), (200, 5500.0, 44)]
    assert not math.isnan(report.first()[1])


# --- nulls, decoded sizes and large keys ---


def test_null_keys_stay_where_they_are_asked_for(rows, values):
    fact = rows([(1, None), (2, "a"), (3, "b")], "id int, k string")
    other = rows([(None, 10), ("a", 20)], "k string, v int")
    for join in (skew_safe_join, salted_join):
        assert values(join(fact, other, "k", ["id"], null_safe=True), "id", "v") == [(1, 10), (2, 20)]
        assert values(join(fact, other, "k", ["id"]), "id", "v") == [(2, 20)]
        assert len(values(join(fact, other, "k", ["id"], "left", null_safe=True), "id", "k", "v")) == 3


def test_concat_keeps_the_group_without_a_key(rows, values):
    df = rows([(None, 2, "b"), (None, 1, "a"), ("k", 1, "c"), ("k", 2, None)], "k string, o int, text string")
    assert values(A.concat_ordered(df, ["k"], ["o"], "text"), "k", "piece", "text") == [("k", 0, "c"), (None, 0, "ab")]


def test_pieces_do_not_depend_on_the_ranges(spark, rows, values):
    data = [(f"k{i % 3}", i, f"{i};" * (i % 5)) for i in range(400)]
    results = []
    for parts in ("2", "7"):
        before = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            results.append(values(A.concat_ordered(rows(data, "k string, o int, t string"), ["k"], ["o"], "t", 50)))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)
    assert results[0] == results[1] and len(results[0]) > 30


def test_means_leave_nulls_out_and_are_exact_for_integers(rows):
    row = A.sum_count_mean(rows([(10,), (None,), (20,)], "v int"), [], "v").first()
    assert (row.total, row.n, row["mean"], row.whole_mean) == (30, 2, 15.0, 15)
    large = A.sum_count_mean(rows([(9007199254740993,)], "v long"), [], "v").first()
    assert large.whole_mean == 9007199254740993
    empty = A.sum_count_mean(rows([(None,)], "v int"), [], "v").first()
    assert (empty.n, empty["mean"], empty.whole_mean) == (0, None, None)


def test_texts_that_compress_well_are_not_broadcast(spark, tmp_path):
    path = str(tmp_path / "wide")
    spark.range(3000).select("id", F.repeat(F.lit("x"), 20_000).alias("text")).write.parquet(path)
    wide = spark.read.parquet(path)
    assert not fits_broadcast(wide) and fits_broadcast(wide.select("id"))


def test_lookups_never_turn_the_large_side_into_the_broadcast_one(spark, tmp_path):
    from millrace.plans.catalogue import QUERIES, as_callable

    spark.range(25).selectExpr("id n_nationkey", "concat('n', id) n_name", "id % 5 n_regionkey").repartition(5).write.parquet(f"{tmp_path}/nation.parquet")
    spark.range(5).selectExpr("id r_regionkey", "concat('r', id) r_name").repartition(3).write.parquet(f"{tmp_path}/region.parquet")
    spark.range(2000).selectExpr("id c_custkey", "id % 25 c_nationkey").write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(9000).selectExpr("id o_orderkey", "id % 2000 o_custkey", "'F' o_orderstatus", "'1' o_orderpriority").write.parquet(f"{tmp_path}/orders.parquet")
    for key in ("lookup_join", "rate_report", "rate_report_2key"):
        df = as_callable(QUERIES[key])(spark, str(tmp_path))
        plan = df._jdf.queryExecution().executedPlan().toString()
        for line in plan.splitlines():
            if "nationkey" in line or "regionkey" in line:
                assert "SortMergeJoin" not in line and "BuildLeft" not in line, line
        assert not [x for x in plan.splitlines() if "hashpartitioning(c_nationkey" in x and key == "lookup_join"]
        assert df.count() == {"lookup_join": 2000, "rate_report": 5, "rate_report_2key": 5}[key]


def test_salted_join_does_not_shuffle_rows_for_few_hot_keys_of_many_counts(spark):
    fact = spark.range(20_000).select(F.col("id"), (F.col("id") % 5_000).alias("k"))
    counts = materialize(fact.groupBy("k").agg(F.count("*").alias("n")), "counts")
    other = counts.select("k", (F.col("k") * 2).alias("v"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "4k")
    try:
        joined = salted_join(fact, other, "k", ["id"], key_counts=counts)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning(_hash" not in plan
        assert joined.where(F.col("v") == F.col("k") * 2).count() == 20_000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
