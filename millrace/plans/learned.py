"""Fitted models. Results depend on solvers; what must hold of any fitted model has SQL."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from millrace.operators.aggregates import confusion_matrix
from millrace.operators.features import assemble, center_and_scale, principal_components
from millrace.operators.joins import skew_safe_join
from millrace.operators.models import (
    RATING_REG,
    SEED,
    fit_classifier,
    fit_clusters,
    fit_ratings,
    fit_text_classifier,
    score_ratings,
)
from millrace.operators.optimality import centre_residuals, rating_residuals
from millrace.operators.partitions import stated_layout
from millrace.operators.sampling import split_by_key
from millrace.operators.trees import TreeModel, node_table, size_of, ways, with_class
from millrace.plans.registry import Tables, query
from millrace.workspace import materialize

# rows of a training partition where a row holds a text or a vector
WIDE_ROWS = 20_000


def _embedding_vectors(t: Tables) -> DataFrame:
    return t.embeddings.select(
        "vec_id", "label", array_to_vector(F.col("embedding").cast("array<double>")).alias("raw")
    )


@query("pca")
def pca(t: Tables) -> DataFrame:
    reduced = principal_components(_embedding_vectors(t), 3, "raw", "components")
    values = vector_to_array("components")
    return reduced.select("vec_id", *[values[i].alias(f"c{i}") for i in range(3)])


@query("random_forest")
def random_forest(t: Tables) -> DataFrame:
    reduced = principal_components(_embedding_vectors(t), 3, "raw", "features")
    train, test = split_by_key(reduced.select("vec_id", "label", "features"), "vec_id", 0.7)
    model = fit_classifier(train, RandomForestClassifier(labelCol="label_index", seed=SEED), "label")
    return confusion_matrix(model.transform(test), "label", "predicted")


def _lines(t: Tables) -> DataFrame:
    """The lines with their numbers as features, laid out by their rows alone."""
    features = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    given = t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag", *features)
    lines = stated_layout(given, key=["l_orderkey", "l_linenumber"])
    return assemble(lines, features).select("l_orderkey", "l_returnflag", "features")


@query("decision_tree")
def decision_tree(t: Tables) -> DataFrame:
    train, test = split_by_key(_lines(t), "l_orderkey", 0.7)
    model = fit_classifier(train, DecisionTreeClassifier(labelCol="label_index", seed=SEED), "l_returnflag")
    return confusion_matrix(model.transform(test), "l_returnflag", "predicted")


@query(
    "decision_tree_table",
    """SELECT l_returnflag, count(*) AS n, count(*) AS n_same, CAST(0 AS BIGINT) AS nodes_wrong FROM lineitem
       WHERE l_returnflag IS NOT NULL GROUP BY l_returnflag""",
)
def decision_tree_table(t: Tables) -> DataFrame:
    """A tree trained on all lines and scored from its table of nodes.

    For how many lines that gives what the model gives, and how many nodes do not have the rows that training saw there.
    """
    rows = materialize(_lines(t).where("l_returnflag is not null").select("l_returnflag", "features"), "lines")
    model = fit_classifier(rows, DecisionTreeClassifier(labelCol="label_index", seed=SEED), "l_returnflag")
    tree = model.stages[1]
    nodes = materialize(node_table(tree, t.spark), "nodes")
    # a row for each label and leaf
    found = materialize(_same_by(rows, "l_returnflag", model, tree, nodes, F.get("_leaves", F.lit(0)).alias("node")), "by-leaf")
    seen = found.join(ways(nodes, tree.depth), "node").select(F.explode("way").alias("node"), "n")
    seen = seen.groupBy("node").agg(F.sum("n").alias("seen"))
    wrong = nodes.join(seen, "node", "left").agg(F.count_if(F.coalesce("seen", F.lit(0)) != F.col("n")).alias("w")).scalar()
    return found.groupBy("l_returnflag").agg(F.sum("n").alias("n"), F.sum("n_same").alias("n_same")).withColumn("nodes_wrong", wrong)


@query("random_forest_table", "SELECT label, count(*) AS n, count(*) AS n_same FROM embeddings WHERE label IS NOT NULL GROUP BY label")
def random_forest_table(t: Tables) -> DataFrame:
    """A forest trained on all embeddings and scored from its table of nodes: where it gives what the model gives."""
    given = t.embeddings.select("vec_id", "label", "embedding").where("label is not null")
    raw = stated_layout(given, key=["vec_id"], rows=WIDE_ROWS)
    vectors = raw.select("vec_id", "label", array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))
    rows = materialize(vectors, "vectors")
    model = fit_classifier(rows, RandomForestClassifier(labelCol="label_index", seed=SEED), "label")
    forest = model.stages[1]
    nodes = materialize(node_table(forest, t.spark), "nodes")
    return _same_by(rows, "label", model, forest, nodes)


def _same_by(rows: DataFrame, label: str, model: PipelineModel, trees: TreeModel, nodes: DataFrame, *by: Column) -> DataFrame:
    """Rows of each label (and of ``by``), and those with one prediction by the model and by the table of its nodes."""
    told = model.transform(rows).select(label, "features", F.col("prediction").alias("_told"))
    both = with_class(told, "features", nodes, size_of(trees)[1], "_found")
    return both.groupBy(label, *by).agg(F.count("*").alias("n"), F.count_if(F.col("_told").eqNullSafe(F.col("_found"))).alias("n_same"))


@query("nb_text")
def nb_text(t: Tables) -> DataFrame:
    labelled = t.labels.join(t.documents.select("doc_id", "text"), "doc_id")
    label = F.col("quality").cast("double").alias("label")
    rows = stated_layout(labelled.select("doc_id", "text", label).na.fill("", ["text"]), key=["doc_id"], rows=WIDE_ROWS)
    train, test = split_by_key(rows, "doc_id", 0.7)
    return confusion_matrix(fit_text_classifier(train, "text", "label").transform(test))


def _customer_points(t: Tables) -> DataFrame:
    cols = ["c_acctbal", "c_nationkey", "segment"]
    segment = F.ascii("c_mktsegment").alias("segment")
    customers = t.customer.select("c_custkey", "c_acctbal", "c_nationkey", segment)
    return assemble(center_and_scale(customers, cols), cols).select("c_custkey", "features")


@query("kmeans")
def kmeans(t: Tables) -> DataFrame:
    points = _customer_points(t)
    clusters = fit_clusters(points, k=4, seed=1).transform(points)
    return clusters.groupBy(F.col("prediction").alias("cluster")).agg(F.count("*").alias("n"))


# how far the conditions on a fitted model may be missed, relative to their terms
RATING_BOUND = 1e-3
CENTRE_BOUND = 1e-6


@query("kmeans_fixed_point", "SELECT CAST(unnest(range(4)) AS INTEGER) AS cluster, TRUE AS is_mean")
def kmeans_fixed_point(t: Tables) -> DataFrame:
    """Every centre is the mean of the customers nearest to it, once the training has come to rest."""
    points = materialize(_customer_points(t), "points")
    model = KMeans(k=4, seed=1, maxIter=1000, tol=1e-12).fit(points)
    return centre_residuals(model, points).select("cluster", (F.col("residual") < CENTRE_BOUND).alias("is_mean"))


@query(
    "als_normal_equations",
    """SELECT o_custkey, count(DISTINCT l_partkey) AS n, TRUE AS holds
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey
       WHERE l_partkey IS NOT NULL AND l_quantity IS NOT NULL AND o_custkey IS NOT NULL GROUP BY o_custkey""",
)
def als_normal_equations(t: Tables) -> DataFrame:
    """The factors of every customer solve their normal equations."""
    ratings = materialize(_ratings(t).select(F.col("o_custkey").cast("int"), F.col("l_partkey").cast("int"), "rating"), "ratings")
    model = fit_ratings(ratings, "o_custkey", "l_partkey", "rating")
    found = rating_residuals(model, ratings, "o_custkey", "l_partkey", "rating", RATING_REG)
    return found.select(F.col("o_custkey").cast("bigint").alias("o_custkey"), "n", (F.col("residual") < RATING_BOUND).alias("holds"))


def _ratings(t: Tables) -> DataFrame:
    """Customers rate parts by the mean quantity they order."""
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey", "l_quantity").na.drop()
    orders = t.orders.select("o_orderkey", "o_custkey").na.drop()
    bought = skew_safe_join(lines, orders, "o_orderkey", salt_by=["l_partkey"])
    return bought.groupBy("o_custkey", "l_partkey").agg(F.avg("l_quantity").alias("rating"))


def _rated(t: Tables) -> tuple[DataFrame, DataFrame]:
    """The ratings, of which nine tenths are for training."""
    ratings = materialize(_ratings(t), "ratings").withColumn("pair", F.concat_ws("-", "o_custkey", "l_partkey"))
    train, test = split_by_key(ratings, "pair", 0.9)
    return train.drop("pair"), test.drop("pair")


# parts recommended to each customer
RECOMMENDED = 3


@query("als_recommend")
def als_recommend(t: Tables) -> DataFrame:
    """Predictions for the pairs held out, and the parts recommended to every customer, which have a ``place``."""
    return score_ratings(*_rated(t), "o_custkey", "l_partkey", "rating", top=RECOMMENDED)


@query("als_rmse")
def als_rmse(t: Tables) -> DataFrame:
    """Root mean squared error of the ratings model on the pairs it has not seen, beside that of the mean rating."""
    train, test = _rated(t)
    scored = score_ratings(train, test, "o_custkey", "l_partkey", "rating")
    mean = train.agg(F.avg("rating")).scalar()
    error = lambda guess: F.sqrt(F.avg((F.col("rating") - guess) * (F.col("rating") - guess)))
    return scored.agg(F.count("*").alias("n"), error(F.col("prediction")).alias("rmse"), error(mean).alias("rmse_of_mean"))
