import math
import random

import numpy as np
import pytest
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from millrace.functions import indicator, indicators
from millrace.operators import models as M
from millrace.operators.aggregates import accuracy, r_squared
from millrace.operators.features import assemble
from millrace.operators.sampling import split_by_key
from millrace.workspace import materialize


@pytest.fixture
def flowers(rows):
    """Three separable groups of points."""
    rnd = random.Random(5)
    centres = {"one": (1.0, 1.0), "two": (5.0, 1.0), "three": (3.0, 6.0)}
    data = [
        (i * 3 + j, name, x + rnd.random(), y + rnd.random())
        for i in range(40)
        for j, (name, (x, y)) in enumerate(centres.items())
    ]
    return rows(data, "id long, species string, x double, y double")


def test_linear_regression_recovers_a_plane(rows):
    rnd = random.Random(3)
    points = [(i, rnd.random() * 10, rnd.random() * 5) for i in range(120)]
    df = rows([(i, a, b, 7 + 2 * a - 3 * b) for i, a, b in points], "id long, a double, b double, mpg double")
    train, test = split_by_key(df, "id", 0.9)
    model = M.fit_linear(train, ["a", "b"], "mpg")
    terms = {r["name"]: r["coefficient"] for r in M.linear_terms(model, ["a", "b"], df).collect()}
    assert terms == {"intercept": pytest.approx(7), "a": pytest.approx(2), "b": pytest.approx(-3)}
    scored = M.predict(model, test, ["a", "b"])
    assert r_squared(scored, "mpg").first()[0] == pytest.approx(1)


def test_linear_regression_equals_least_squares(rows):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(200, 3)) * [1, 10, 0.1]
    y = x @ [2.0, -0.5, 30.0] + 4 + rng.normal(size=200)
    df = rows([(*map(float, a), float(b)) for a, b in zip(x, y)], "a double, b double, c double, y double")
    model = M.fit_linear(df, ["a", "b", "c"], "y")
    expected = np.linalg.lstsq(np.column_stack([np.ones(200), x]), y, rcond=None)[0]
    np.testing.assert_allclose([model.intercept, *model.coefficients], expected, rtol=1e-8)


def test_rows_without_a_label_are_not_trained_on(flowers, rows):
    more = flowers.unionByName(rows([(9999, None, 3.0, 6.2)], "id long, species string, x double, y double"))
    model = M.fit_classifier(assemble(more, ["x", "y"]), M.classifiers()["decision_tree"], "species")
    scored = model.transform(assemble(more, ["x", "y"])).where("species IS NULL").collect()
    assert [r.predicted for r in scored] == ["three"]


@pytest.mark.parametrize("name", ["decision_tree", "random_forest", "naive_bayes"])
def test_classifiers_learn_separable_groups(flowers, name):
    vectors = assemble(flowers, ["x", "y"])
    train, test = split_by_key(vectors, "id", 0.7)
    scored = M.fit_classifier(train, M.classifiers()[name], "species").transform(test)
    share = accuracy(scored, "species", "predicted").first()[0]
    assert share > (0.9 if name != "naive_bayes" else 0.4)


def test_predictions_come_back_as_labels(flowers):
    model = M.fit_classifier(assemble(flowers, ["x", "y"]), M.classifiers()["decision_tree"], "species")
    scored = model.transform(assemble(flowers, ["x", "y"]))
    assert {r.predicted for r in scored.select("predicted").distinct().collect()} == {"one", "two", "three"}


def test_random_forest_has_the_default_size(flowers):
    model = M.fit_classifier(assemble(flowers, ["x", "y"]), M.classifiers()["random_forest"], "species")
    assert model.stages[1].getNumTrees == 20


def test_compare_classifiers(flowers):
    numbered = flowers.withColumn("label", F.when(F.col("species") == "one", 1.0).otherwise(0.0))
    train, test = split_by_key(assemble(numbered, ["x", "y"]), "id", 0.7)
    result = {r.model: r.accuracy for r in M.compare_classifiers(train, test, "label", M.classifiers()).collect()}
    assert set(result) == {"decision_tree", "random_forest", "naive_bayes"}
    assert result["decision_tree"] > 0.9 and result["random_forest"] > 0.9


def test_bank_rows_with_indicator_columns(rows):
    data = [
        (i, 20 + i % 50, ["single", "married", "divorced"][i % 3], ["primary", "secondary", "tertiary"][i // 3 % 3],
         "yes" if i % 7 == 0 else "no", float(i % 11) * 100, "yes" if i % 3 == 1 else "no")
        for i in range(210)
    ]
    df = rows(data, "id long, age int, marital string, education string, dflt string, balance double, outcome string")
    marital, education = ["single", "married", "divorced"], ["primary", "secondary", "tertiary"]
    wide = df.withColumns(
        {**indicators("marital", marital), **indicators("education", education), "dflt": indicator(F.col("dflt"), "yes")}
    )
    vectors = assemble(wide, ["age", *marital, *education, "dflt", "balance"])
    train, test = split_by_key(vectors, "id", 0.7)
    scored = M.fit_classifier(train, M.classifiers()["random_forest"], "outcome").transform(test)
    assert accuracy(scored, "outcome", "predicted").first()[0] > 0.9


def test_naive_bayes_of_the_worked_example(rows):
    df = rows([(0.0, [1.0, 2.0]), (0.0, [3.0, 0.0]), (1.0, [0.0, 5.0])], "label double, a array<double>")
    model = NaiveBayes(smoothing=1.0).fit(df.select("label", array_to_vector("a").alias("features")))
    assert list(model.pi) == pytest.approx([math.log(3 / 5), math.log(2 / 5)])
    priors = {r["class"]: r["log_prior"] for r in M.class_priors(df, "label").collect()}
    assert priors == {0.0: pytest.approx(math.log(3 / 5)), 1.0: pytest.approx(math.log(2 / 5))}


def test_term_likelihoods_of_the_worked_example(rows):
    # the same counts as words: class 0 has a x4 and b x2, class 1 has b x5
    df = rows([(0, "a b b"), (0, "a a a"), (1, "b b b b b")], "label int, text string")
    result = {(r["class"], r.term): r.log_likelihood for r in M.term_likelihoods(df, "text", "label").collect()}
    assert result == {
        (0, "a"): pytest.approx(math.log(5 / 8)), (0, "b"): pytest.approx(math.log(3 / 8)),
        (1, "a"): pytest.approx(math.log(1 / 7)), (1, "b"): pytest.approx(math.log(6 / 7)),
    }


def test_text_classifier_separates_messages(rows):
    spam = ["win a free prize now", "free cash call now", "claim your prize today"]
    ham = ["see you at lunch", "are you home yet", "the meeting moved to noon"]
    data = [(1.0 if i % 2 else 0.0, (spam if i % 2 else ham)[i // 2 % 3] + f" {i % 5}") for i in range(100)]
    df = rows(data, "label double, text string")
    scored = M.fit_text_classifier(df, "text", "label").transform(df)
    assert accuracy(scored).first()[0] == 1.0


def test_clusters_find_the_groups_and_beat_the_start(flowers):
    points = assemble(flowers, ["x", "y"])
    model = M.fit_clusters(points, k=3, seed=1)
    sizes = sorted(r["count"] for r in model.transform(points).groupBy("prediction").count().collect())
    assert sizes == [40, 40, 40] and model.summary.trainingCost < 40


def test_assign_to_nearest(rows, values):
    points = rows([(1, [0.0, 0.0]), (2, [10.0, 0.0]), (3, [5.0, 0.0])], "id int, v array<double>")
    groups = rows([("l", [0.0, 0.0]), ("l", [0.0, 2.0]), ("r", [10.0, 1.0])], "g string, v array<double>")
    centres = M.mean_vectors(groups, "g", "v")
    assert values(centres) == [("l", [0.0, 1.0]), ("r", [10.0, 1.0])]
    result = M.assign_to_nearest(points, "v", centres, "g")
    assert values(result, "id", "cluster") == [(1, "l"), (2, "r"), (3, "l")]
    assert {r.id: r.distance for r in result.collect()}[2] == pytest.approx(1.0)


def test_ratings_are_fitted_and_unseen_ids_are_dropped(rows):
    data = [(u, 100 + i, float((u % 2) * 4 + 1 + (i % 3))) for u in range(12) for i in range(10)]
    ratings = rows(data, "user int, item int, rating double")
    model = M.fit_ratings(ratings, "user", "item", "rating")
    assert model.rank == 10
    scored = model.transform(ratings)
    rmse = scored.agg(F.sqrt(F.avg((F.col("rating") - F.col("prediction")) ** 2))).first()[0]
    assert scored.count() == 120 and rmse < 0.5
    assert model.transform(rows([(999, 100)], "user int, item int")).count() == 0


def test_more_centres_than_a_block_holds(spark, rows):
    centres = spark.range(1001).selectExpr("id as k", "array(cast(id as double), 0.0D) as centre")
    points = rows([(0, [3.2, 1.0]), (1, [999.6, 0.0]), (2, [2.5, 0.0])], "id int, v array<double>")
    found = M.assign_to_nearest(points, "v", centres, "k").collect()
    assert {r.id: r.cluster for r in found} == {0: 3, 1: 1000, 2: 2}
    assert M.assign_to_nearest(points, "v", centres.limit(0), "k").select("cluster").first()[0] is None


def test_ratings_take_ids_of_any_size(rows):
    data = [(3_000_000_000 + u, f"item{i}", float(1 + (u * i) % 5)) for u in range(8) for i in range(6)]
    train = rows(data, "u long, i string, r double")
    scored = M.score_ratings(train, rows([*data[:5], (7, "item1", 1.0), (3_000_000_001, "new", 1.0)], "u long, i string, r double"), "u", "i", "r")
    assert sorted((r.u, r.i) for r in scored.collect()) == sorted((u, i) for u, i, _ in data[:5])


def test_likelihoods_of_three_classes(rows):
    df = rows([(0, "a b"), (1, "b b"), (2, "c"), (None, "d")], "label int, text string")
    got = {(r["class"], r.term): r.log_likelihood for r in M.term_likelihoods(df, "text", "label").collect()}
    counts = {0: {"a": 1, "b": 1}, 1: {"b": 2}, 2: {"c": 1}}
    for label, own in counts.items():
        for term in "abc":
            assert got[label, term] == pytest.approx(math.log((own.get(term, 0) + 1) / (sum(own.values()) + 3)))
    assert len(got) == 9


def test_numeric_likelihoods_equal_the_fitted_model(rows):
    from pyspark.ml.classification import NaiveBayes

    from millrace.operators.features import assemble

    df = rows([(float(i % 3), float(i % 4), float(i % 5), 1.0) for i in range(30)], "label double, a double, b double, c double")
    theta = NaiveBayes().fit(assemble(df, ["a", "b", "c"])).theta.toArray()
    for r in M.feature_likelihoods(df, ["a", "b", "c"], "label").collect():
        assert r.log_likelihood == pytest.approx(theta[int(r["class"])]["abc".index(r.feature)])


def test_the_stated_layout_does_not_depend_on_the_one_before(spark, rows):
    from pyspark.sql import functions as F

    from millrace.operators.partitions import stated_layout

    df = rows([(i, i % 7) for i in range(500)], "id int, v int")
    seen = []
    for before in (df.coalesce(1), df.repartition(9), df.orderBy(F.desc("id"))):
        laid = stated_layout(before, 4).select("id", F.spark_partition_id().alias("p"), F.monotonically_increasing_id().alias("place"))
        seen.append({tuple(r) for r in laid.collect()})
    assert seen[0] == seen[1] == seen[2] and len({p for _, p, _ in seen[0]}) == 4


def test_the_layout_has_a_partition_for_so_many_rows_and_sorts_by_key(spark):
    from millrace.operators.partitions import LEAST_MODEL_PARTS, stated_layout

    df = spark.range(1000, numPartitions=3).select((F.col("id") % 500).alias("k"), F.col("id").cast("string").alias("text"))
    assert stated_layout(df, key=["k"], rows=50).rdd.getNumPartitions() == 20
    assert stated_layout(df.where("k < 3"), key=["k"]).rdd.getNumPartitions() == LEAST_MODEL_PARTS
    placed = [
        {r["text"]: (r["p"], r["place"]) for r in stated_layout(x, key=["k"], rows=50)
         .select("text", F.spark_partition_id().alias("p"), F.monotonically_increasing_id().alias("place")).collect()}
        for x in (df, df.repartition(7))
    ]
    assert placed[0] == placed[1] and len(placed[0]) == 1000


def test_ratings_of_ids_that_training_has_not_seen_are_dropped(spark, rows):
    ddl = "u string, i bigint, r double"
    train = rows([(f"u{u}", 10**12 + i, float((u * i) % 5)) for u in range(12) for i in range(9) if (u + i) % 3] + [(None, 1, 1.0), ("u1", None, 2.0)], ddl)
    test = rows([("u0", 10**12, 1.0), ("u5", 10**12 + 7, 2.0), ("new", 10**12, 1.0), ("u0", 5, 1.0), (None, 10**12, 3.0)], ddl)
    scored = M.score_ratings(train, test, "u", "i", "r", blocks=2)
    assert scored.columns == ["u", "i", "r", "prediction"]
    assert sorted((x["u"], x["i"]) for x in scored.collect()) == [("u0", 10**12), ("u5", 10**12 + 7)]


def test_numbered_ratings_keep_the_ids_of_test_rows_only(rows, monkeypatch):
    written = {}
    monkeypatch.setattr(M, "materialize", lambda df, label: written.setdefault(label, materialize(df, label)))
    data = [(100 + u, f"item{i}", float(1 + (u * i) % 5)) for u in range(8) for i in range(6)]
    ratings = rows(data, "u long, i string, r double")
    M.score_ratings(ratings, ratings.limit(5), "u", "i", "r", blocks=2)
    numbered = written["dense-ratings"]
    assert numbered.where("_train").count() == 48
    assert numbered.where("_train and (u is not null or i is not null)").count() == 0
    assert numbered.where("not _train and u is not null and i is not null").count() == 5
