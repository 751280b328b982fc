"""Frequent keys: all of them, with their exact numbers, and without a count of the others."""

import random

import pytest
from millrace.operators import frequent
from millrace.operators.joins import salted_join
from pyspark.sql import functions as F


def plain(data, more_than):
    counts = {}
    for k in data:
        counts[k] = counts.get(k, 0) + 1
    return sorted(((k, n) for k, n in counts.items() if n > more_than), key=repr)


@pytest.mark.parametrize("more_than", [0, 1, 9, 10, 11, 200, 10_000])
def test_all_keys_above_the_bound(rows, values, more_than):
    r = random.Random(more_than)
    data = [None] * 30 + ["hot"] * 400 + ["x"] * 10 + ["y"] * 11 + [f"k{r.randrange(3000)}" for _ in range(3000)]
    r.shuffle(data)
    df = rows([(k, i) for i, k in enumerate(data)], "k string, id int").repartition(7)
    assert values(frequent.frequent_keys(df, "k", more_than)) == plain(data, more_than)


def test_no_key_is_missed_at_the_bound_of_the_sketch(spark, values):
    # many keys just above the bound among a hundred times as many below it, in the worst order for a sketch
    hot = spark.range(0, 200 * 101).select((F.col("id") % 200).alias("k"))
    cold = spark.range(200_000).select((F.col("id") + 1000).alias("k"))
    df = hot.union(cold).repartition(5)
    out = values(frequent.frequent_keys(df, "k", 100))
    assert out == sorted(((k, 101) for k in range(200)), key=repr)


def test_two_columns_and_more_keys_than_the_sketch_follows(rows, values, monkeypatch):
    monkeypatch.setattr(frequent, "MOST_TRACKED", 100)
    data = [(i % 5, "ab"[i % 2], i) for i in range(300)] + [(None, None, 0)] * 40
    df = rows(data, "a int, b string, n int")
    assert values(frequent.frequent_keys(df.select("a", "b"), ["a", "b"], 30)) == [(None, None, 40)]
    assert frequent.frequent_keys(df.limit(0), "a", 0).count() == 0


def test_the_join_shuffles_the_fact_once_and_spreads_its_hot_key(spark, rows, values, tmp_path):
    spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), "id").write.parquet(f"{tmp_path}/f")
    fact = spark.read.parquet(f"{tmp_path}/f")
    other = spark.range(0, 3000, 2).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    other = other.union(rows([(7, 0)], "k long, v long"))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100")
    try:
        joined = salted_join(fact, other, "k", ["id"], rows_per_task=100)
        plan = joined._jdf.queryExecution().optimizedPlan().toString()
        # the list of hot keys is a written table: nothing adds up the fact again
        assert "Aggregate [k" not in plan
        assert values(joined) == values(fact.join(other, "k"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
