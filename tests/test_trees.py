"""Trees as tables of nodes."""

import random

import pytest
from millrace.operators import trees
from millrace.operators.features import assemble
from millrace.operators.partitions import stated_layout
from millrace.workspace import materialize
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorIndexer
from pyspark.sql import functions as F


@pytest.fixture
def points(rows):
    r = random.Random(4)
    data = [(i, float(r.randrange(5)), r.uniform(0, 10), r.gauss(0, 1)) for i in range(500)]
    return rows([(i, float((a > 2) + (b > 4 + c)), a, b, c) for i, a, b, c in data], "id int, label double, a double, b double, c double")


@pytest.mark.parametrize("estimator", [(DecisionTreeClassifier, {"maxDepth": 4}), (RandomForestClassifier, {"numTrees": 7, "maxDepth": 3, "seed": 1}), (DecisionTreeClassifier, {"maxDepth": 0})])
@pytest.mark.parametrize("categorical", [False, True])
def test_the_table_gives_what_the_model_gives(spark, points, estimator, categorical):
    df = assemble(points, ["a", "b", "c"])
    if categorical:
        df = VectorIndexer(inputCol="features", outputCol="indexed", maxCategories=6).fit(df).transform(df).drop("features").withColumnRenamed("indexed", "features")
    kind, options = estimator
    model = kind(**options).fit(df)
    nodes = trees.node_table(model, spark)
    assert nodes.where("categories is not null").count() > 0 or not categorical or model.getMaxDepth() == 0
    out = trees.classified(df, "features", nodes, *trees.size_of(model), key=["id"])
    told = {r.id: r.prediction for r in model.transform(df).collect()}
    assert {r.id: r.prediction for r in out.collect()} == told


def test_nodes_have_the_rows_that_training_saw(spark, points, values):
    df = assemble(points, ["a", "b", "c"])
    model = DecisionTreeClassifier(maxDepth=4).fit(df)
    nodes = trees.node_table(model, spark)
    seen = trees.walked(df, "features", nodes, *trees.size_of(model), keep=[], every_node=True).groupBy("node").count()
    assert values(seen, "node", "count") == values(nodes, "node", "n")
    assert model.numNodes == nodes.count() and nodes.where("node = 0").first().n == 500


@pytest.mark.parametrize("estimator", [(DecisionTreeClassifier, {"maxDepth": 5, "seed": 1}), (RandomForestClassifier, {"numTrees": 5, "seed": 1})])
def test_two_layouts_give_one_table(spark, points, values, estimator):
    def table(df):
        laid_out = stated_layout(df)
        return values(trees.node_table(estimator[0](**estimator[1]).fit(assemble(laid_out, ["a", "b", "c"])), spark))

    assert table(points.repartition(3)) == table(points.orderBy(F.rand(1)).coalesce(1))


@pytest.mark.parametrize("estimator", [(DecisionTreeClassifier, {"maxDepth": 4}), (RandomForestClassifier, {"numTrees": 7, "maxDepth": 3, "seed": 1})])
def test_rows_are_classified_where_they_are(spark, points, estimator):
    kind, options = estimator
    df = assemble(points.repartition(3, "id").withColumn("at", F.spark_partition_id()), ["a", "b", "c"])
    model = kind(**options).fit(df)
    nodes = materialize(trees.node_table(model, spark), "nodes")
    out = trees.classified(df, "features", nodes, *trees.size_of(model), key=["id", "at"])
    assert out.where(F.col("at") == F.spark_partition_id()).count() == 500
    # equal rows need no key that tells them apart
    twice = trees.with_class(df.unionByName(df), "features", nodes, trees.size_of(model)[1], "found")
    told = {r.id: r.prediction for r in model.transform(df).collect()}
    assert sorted((r.id, r.found) for r in twice.collect()) == sorted([*told.items()] * 2)
