"""Trained trees as a table of nodes, and scoring from that table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import DecisionTreeClassificationModel, RandomForestClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from millrace.workspace import new_folder

TreeModel = DecisionTreeClassificationModel | RandomForestClassificationModel


def node_table(model: TreeModel, spark) -> DataFrame:
    """One row for each node of each tree.

    ``tree`` and ``node`` name it, node 0 is the root. An inner node has a ``feature`` and goes ``left`` where that is at
    most ``threshold``, or among ``categories`` if the feature has such, and else ``right``; a leaf has nulls there. ``n`` is
    the number of training rows that came to the node (for a forest, of its own sample), ``class_counts`` their weights by
    class, ``prediction`` the heaviest class.
    """
    path = new_folder(spark, "model")
    model.write().save(path)
    saved = spark.read.parquet(f"{path}/data")
    if "nodeData" in saved.columns:
        rows = saved.select(F.col("treeID").alias("tree"), "nodeData.*")
    else:
        rows = saved.withColumn("tree", F.lit(0))
    inner = F.col("leftChild") >= 0
    continuous = F.col("split.numCategories") < 0
    return rows.select(
        "tree",
        F.col("id").alias("node"),
        F.when(inner, F.col("split.featureIndex")).alias("feature"),
        F.when(inner & continuous, F.get("split.leftCategoriesOrThreshold", F.lit(0))).alias("threshold"),
        F.when(inner & ~continuous, F.col("split.leftCategoriesOrThreshold")).alias("categories"),
        F.when(inner, F.col("leftChild")).alias("left"),
        F.when(inner, F.col("rightChild")).alias("right"),
        F.col("rawCount").alias("n"),
        F.col("impurityStats").alias("class_counts"),
        "prediction",
    )


def size_of(model: TreeModel) -> tuple[int, int]:
    """The number of trees, and the depth of the deepest."""
    trees = getattr(model, "trees", None)
    return (1, model.depth) if trees is None else (len(trees), max(t.depth for t in trees))


def _by_tree(nodes: DataFrame, **cols: Column) -> Column:
    """``cols`` of all nodes as one value of the plan, as large as the model.

    A struct for each tree in order, with an array for each column, in which node i is at place i.
    """
    row = F.struct("node", *[c.alias(name) for name, c in cols.items()])
    each = nodes.groupBy("tree").agg(F.array_sort(F.collect_list(row)).alias("n"))
    cut = F.struct(*[F.col(f"n.{name}").alias(name) for name in cols])
    return each.agg(F.array_sort(F.collect_list(F.struct("tree", cut.alias("cut")))).getField("cut")).scalar()


def _splits(nodes: DataFrame) -> Column:
    """Where each node leads, a leaf to itself."""
    same = {c: F.col(c) for c in ("threshold", "categories")}
    return _by_tree(nodes, feature=F.coalesce("feature", F.lit(0)), **same, **{side: F.coalesce(side, "node") for side in ("left", "right")})


def _leaves(features: str, depth: int) -> Column:
    """The leaf that a row comes to in each tree of ``_trees``."""

    def down(tree: Column, node: Column, values: Column) -> Column:
        value = F.get(values, F.get(tree["feature"], node))
        # leaves have neither
        goes_left = F.coalesce(value <= F.get(tree["threshold"], node), F.array_contains(F.get(tree["categories"], node), value), F.lit(False))
        return F.when(goes_left, F.get(tree["left"], node)).otherwise(F.get(tree["right"], node))

    def through(values: Column) -> Column:
        return F.transform("_trees", lambda tree: F.aggregate(F.array_repeat(F.lit(0), depth), F.lit(0), lambda node, _: down(tree, node, values)))

    # a transform over a one-element array names the values, so that the vector is opened once
    return F.get(F.transform(F.array(vector_to_array(F.col(features))), through), 0)


def ways(nodes: DataFrame, depth: int) -> DataFrame:
    """``tree``, ``node`` and the nodes on the ``way`` to it, itself first and the root last."""
    children = F.explode(F.array("left", "right")).alias("node")
    above = nodes.where("left is not null").select("tree", F.col("node").alias("_above"), children)
    found = nodes.select("tree", "node", F.array("node").alias("way"))
    for _ in range(depth):
        up = above.withColumnRenamed("node", "_at")
        found = found.withColumn("_at", F.element_at("way", -1)).join(up, ["tree", "_at"], "left")
        found = found.select("tree", "node", F.when(F.col("_above").isNull(), F.col("way")).otherwise(F.array_append("way", F.col("_above"))).alias("way"))
    return found


def walked(df: DataFrame, features: str, nodes: DataFrame, trees: int, depth: int, keep: Sequence[str], every_node: bool = False) -> DataFrame:
    """The columns ``keep`` of each row with the leaf (``tree``, ``node``) it comes to in each tree.

    With ``every_node`` all nodes on the way are rows. Rows walk where they are: the nodes are a value of the plan.
    """
    leaves = df.withColumn("_trees", _splits(nodes)).select(*keep, F.posexplode(_leaves(features, depth)).alias("tree", "node"))
    leaves = leaves.where(F.col("tree") < trees)
    if not every_node:
        return leaves
    return leaves.join(ways(nodes, depth), ["tree", "node"]).select(*keep, "tree", F.explode("way").alias("node"))


def with_class(df: DataFrame, features: str, nodes: DataFrame, depth: int, output: str, leaves: str = "_leaves") -> DataFrame:
    """``df`` with the index of the class of each row in ``output`` and the leaf it comes to in each tree in ``leaves``.

    Every tree gives its leaf's shares of the classes; the class with the largest sum wins, the first of equal ones.
    Nothing is shuffled.
    """
    total = F.aggregate("class_counts", F.lit(0.0), lambda a, b: a + b)
    share = F.transform("class_counts", lambda c: F.coalesce(F.try_divide(c, total), F.lit(0.0)))
    given = df.withColumns({"_trees": _splits(nodes), "_shares": _by_tree(nodes, share=share)})
    found = given.withColumn(leaves, _leaves(features, depth))
    found = found.withColumn("_each", F.zip_with(leaves, "_shares", lambda node, tree: F.get(tree["share"], node)))
    others = F.slice("_each", 2, F.size("_each"))
    sums = F.aggregate(others, F.get("_each", F.lit(0)), lambda a, b: F.zip_with(a, b, lambda x, y: x + y))
    found = found.withColumn("_sums", sums)
    best = F.array_position("_sums", F.array_max("_sums")) - 1
    return found.select(*df.columns, leaves, best.cast("double").alias(output))


def classified(df: DataFrame, features: str, nodes: DataFrame, trees: int, depth: int, key: Sequence[str]) -> DataFrame:
    """``key`` and ``prediction`` (index of the class, see ``with_class``) of each row."""
    return with_class(df, features, nodes.where(F.col("tree") < trees), depth, "prediction").select(*key, "prediction")
