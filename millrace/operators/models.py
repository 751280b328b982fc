"""Models. Training and scoring are ``pyspark.ml`` jobs; only model parameters reach the driver."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.base import Estimator
from pyspark.ml.classification import DecisionTreeClassifier, NaiveBayes, RandomForestClassifier
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import IDF, HashingTF, IndexToString, StringIndexer, StringIndexerModel, Tokenizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions import tokens
from millrace.operators.aggregates import accuracy
from millrace.operators.features import assemble
from millrace.operators.joins import skew_safe_join
from millrace.operators.nearest import assign_by_cells
from millrace.operators.ordering import with_ordinal
from millrace.operators.products import largest_products
from millrace.sources import inline_table
from millrace.workspace import materialize

SEED = 42
RATING_REG = 0.01

# So many centres are one value of the plan; more are searched by cells.
CENTRES_PER_BLOCK = 1_000


def fit_linear(df: DataFrame, features: Sequence[str], label: str) -> LinearRegressionModel:
    """Least squares with intercept, solved from one pass over the data."""
    return LinearRegression(labelCol=label, solver="normal").fit(assemble(df, features))


def linear_terms(model: LinearRegressionModel, features: Sequence[str], df: DataFrame) -> DataFrame:
    """The fitted terms as rows ``name``, ``coefficient``; the intercept is named so."""
    terms = [("intercept", float(model.intercept))]
    terms += [(name, float(value)) for name, value in zip(features, model.coefficients)]
    return inline_table(df.sparkSession, terms, "name string, coefficient double")


def predict(model, df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Score rows with a model that was trained on the same feature columns."""
    return model.transform(assemble(df, features)).drop("features")


def classifiers(seed: int = SEED) -> dict[str, Estimator]:
    """The classifiers to compare, with default parameters and reading the label's index."""
    return {
        "decision_tree": DecisionTreeClassifier(labelCol="label_index", seed=seed),
        "random_forest": RandomForestClassifier(labelCol="label_index", seed=seed),
        "naive_bayes": NaiveBayes(labelCol="label_index", smoothing=1.0, modelType="multinomial"),
    }


def label_index(df: DataFrame, label: str) -> StringIndexerModel:
    """The classes of ``label``, the most frequent first, read into ``label_index``."""
    known = df.where(F.col(label).isNotNull())
    return StringIndexer(inputCol=label, outputCol="label_index", handleInvalid="keep").fit(known)


def fit_classifier(
    df: DataFrame, estimator: Estimator, label: str, indexer: StringIndexerModel | None = None
) -> PipelineModel:
    """Index ``label``, train on ``features`` and turn predictions back into label values.

    Rows without a label take no part in training. The scored rows carry the predicted label, as text,
    in ``predicted``. The labels are a parameter of the model: the classes that it can predict. ``indexer`` may
    bring an index of them that is fitted already.
    """
    df = df.where(F.col(label).isNotNull())
    indexer = indexer or label_index(df, label)
    names = IndexToString(inputCol="prediction", outputCol="predicted", labels=indexer.labels)
    return Pipeline(stages=[indexer, estimator, names]).fit(df)


def compare_classifiers(
    train: DataFrame, test: DataFrame, label: str, estimators: Mapping[str, Estimator]
) -> DataFrame:
    """Train each classifier on the same rows and report its accuracy on the same test rows.

    Naive Bayes among them needs features that are not negative.
    """

    indexer = label_index(train, label)

    def scored(name: str) -> DataFrame:
        result = fit_classifier(train, estimators[name], label, indexer).transform(test)
        scores = accuracy(result.withColumn(label, F.col(label).cast("string")), label, "predicted")
        return scores.select(F.lit(name).alias("model"), "accuracy")

    return reduce(DataFrame.unionByName, [scored(name) for name in estimators])


def fit_text_classifier(df: DataFrame, text: str, label: str) -> PipelineModel:
    """Words, hashed term frequencies, inverse document frequency, naive Bayes; trained as one pipeline."""
    stages = [
        Tokenizer(inputCol=text, outputCol="words"),
        HashingTF(inputCol="words", outputCol="frequencies"),
        IDF(inputCol="frequencies", outputCol="features"),
        NaiveBayes(labelCol=label, smoothing=1.0, modelType="multinomial"),
    ]
    return Pipeline(stages=stages).fit(df)


def term_likelihoods(df: DataFrame, text: str, label: str) -> DataFrame:
    """Multinomial naive Bayes over words, for any number of classes, as a table.

    Rows ``class``, ``term``, ``log_likelihood`` for every class and word, with smoothing 1 over the whole
    vocabulary. Rows without a class take no part. The classes are the parameter of the model: each term
    keeps one row with a count for each, so unseen pairs need no cross join.
    """
    rows = df.where(F.col(label).isNotNull()).select(F.col(label).alias("class"), F.explode(tokens(F.col(text))).alias("term"))
    per_pair = rows.groupBy("term", "class").agg(F.count("*").alias("n"))
    return _likelihoods(per_pair, df.select(F.col(label).alias("class")), "term")


def feature_likelihoods(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """The same for numeric features that are not negative: rows ``class``, ``feature``, ``log_likelihood``."""
    named = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("n")) for f in features]))
    rows = df.where(F.col(label).isNotNull()).select(F.col(label).alias("class"), named.alias("e"))
    per_pair = rows.groupBy(F.col("e.feature").alias("feature"), "class").agg(F.sum("e.n").alias("n"))
    return _likelihoods(per_pair, df.select(F.col(label).alias("class")), "feature")


def _likelihoods(per_pair: DataFrame, labelled: DataFrame, name: str) -> DataFrame:
    """Smoothed shares from the sums ``n`` of each pair of ``name`` and class."""
    # read three times, so the texts are taken apart once
    per_pair = materialize(per_pair, "pairs")
    # one number for each class, and the size of the vocabulary
    classes = labelled.where("class is not null").distinct().agg(F.array_sort(F.collect_list("class")).alias("c")).scalar()
    per_class = per_pair.groupBy("class").agg(F.sum("n").alias("n"))
    totals = per_class.agg(F.map_from_entries(F.collect_list(F.struct("class", "n"))).alias("t")).scalar()
    by_name = per_pair.groupBy(name).agg(F.map_from_entries(F.collect_list(F.struct("class", "n"))).alias("by_class"))
    size = by_name.agg(F.count("*").alias("v")).scalar()
    each = by_name.select(name, "by_class", F.explode(classes).alias("class"))
    zero = F.lit(0)
    share = (F.coalesce(F.try_element_at("by_class", F.col("class")), zero) + 1) / (
        F.coalesce(F.try_element_at(totals, F.col("class")), zero) + size
    )
    return each.select("class", name, F.log(share).alias("log_likelihood"))


def class_priors(df: DataFrame, label: str) -> DataFrame:
    """Rows ``class``, ``log_prior`` of naive Bayes with smoothing 1."""
    counts = df.groupBy(F.col(label).alias("class")).agg(F.count("*").alias("n"))
    totals = counts.agg(F.struct(F.sum("n").alias("rows"), F.count("*").alias("classes"))).scalar()
    log_prior = F.log((F.col("n") + 1) / (totals.getField("rows") + totals.getField("classes")))
    return counts.select("class", log_prior.alias("log_prior"))


def fit_clusters(df: DataFrame, k: int = 4, seed: int = 1, features: str = "features") -> KMeansModel:
    return KMeans(k=k, seed=seed, featuresCol=features).fit(df)


def mean_vectors(df: DataFrame, key: str, vector: str) -> DataFrame:
    """The mean of an array column per key, as ``key`` and ``centre``."""
    as_vector = array_to_vector(F.col(vector).cast("array<double>"))
    return df.groupBy(key).agg(vector_to_array(Summarizer.mean(as_vector)).alias("centre"))


def assign_to_nearest(df: DataFrame, vector: str, centres: DataFrame, key: str) -> DataFrame:
    """Add ``cluster``, the ``key`` of the nearest centre, and the ``distance`` to it.

    Equal distances go to the smaller key. There may be any number of centres: up to ``CENTRES_PER_BLOCK`` are a
    value that the plan computes, more are searched by cells, see ``assign_by_cells``. Points are read once, and
    never joined with centres; centres are computed once.
    """
    centres = materialize(centres.select(key, "centre"), "centres")
    n = centres.limit(CENTRES_PER_BLOCK + 1).count()
    if not 0 < n <= CENTRES_PER_BLOCK:
        return assign_by_cells(df, vector, centres, key)
    point = F.col("_point")
    listed = centres.agg(F.collect_list(F.struct(F.col("centre").alias("c"), F.col(key).alias("k"))).alias("l")).scalar()

    def candidate(centre: Column) -> Column:
        gaps = F.zip_with(point, centre.getField("c"), lambda a, b: (a - b) * (a - b))
        distance = F.aggregate(gaps, F.lit(0.0), lambda total, gap: total + gap)
        return F.struct(distance.alias("d"), centre.getField("k").alias("k"))

    nearest = F.array_min(F.transform("_centres", candidate))
    found = df.withColumns({"_point": F.col(vector).cast("array<double>"), "_centres": listed}).withColumn("_nearest", nearest)
    found = found.withColumns({"cluster": F.col("_nearest.k"), "distance": F.sqrt("_nearest.d")})
    return found.drop("_nearest", "_point", "_centres")


def fit_ratings(
    df: DataFrame, user: str, item: str, rating: str, seed: int = SEED, blocks: int | None = None
) -> ALSModel:
    """Explicit-rating factors of rank 10. Users or items unseen in training get no prediction row.

    Ids must be whole numbers of 32 bits; ``score_ratings`` takes ids of any kind. Ratings are divided into
    ``blocks`` blocks of users and of items: by default 10, or one per core where there are more.
    """
    blocks = blocks or max(10, df.sparkSession.sparkContext.defaultParallelism)
    als = ALS(
        userCol=user, itemCol=item, ratingCol=rating, maxIter=5, regParam=RATING_REG, coldStartStrategy="drop", seed=seed
    )
    return als.setNumBlocks(blocks).fit(df)


def score_ratings(
    train: DataFrame, test: DataFrame, user: str, item: str, rating: str, *, top: int = 0, **options
) -> DataFrame:
    """``test`` with a ``prediction`` from factors of ``train``, for ids of any type and size.

    Ids are replaced by dense numbers for the training, users and items that ``train`` does not have are
    dropped, and the result has the original ids. Both kinds of ids are counted and numbered together, and
    ``train`` and ``test`` are joined with the numbers as one table.

    With ``top`` the rows of ``test`` are followed by what the model recommends: for every user of ``train`` the
    ``top`` items of ``train`` with the highest predictions, rated ones among them, as in the library. These
    have a ``place`` from 1 on, and nulls in the other columns of ``test``; rows of ``test`` have no place.
    """
    # the first grouping set is that of the users, whose numbers come before those of the items
    counts = train.groupingSets([[user], [item]], user, item).agg(
        F.grouping(user).alias("_is_item"), F.count("*").alias("_n")
    )
    counts = counts.where(F.when(F.col("_is_item") == 0, F.col(user).isNotNull()).otherwise(F.col(item).isNotNull()))
    numbers = materialize(with_ordinal(counts, [F.col(c) for c in ("_is_item", user, item)], "_dense"), "dense")
    rows = train.select(user, item, rating, F.lit(True).alias("_train"))
    rows = rows.unionByName(test.withColumn("_train", F.lit(False)), allowMissingColumns=True)
    for is_item, (col, number, other) in enumerate(((user, "_user", item), (item, "_item", "_user"))):
        own = numbers.where(F.col("_is_item") == is_item).select(col, F.col("_dense").cast("int").alias(number), "_n")
        rows = skew_safe_join(rows, own.drop("_n"), col, [other], key_counts=own.select(col, F.col("_n").alias("n")))
        # training needs the numbers only
        rows = rows.withColumn(col, F.when(~F.col("_train"), F.col(col)))
    rows = materialize(rows, "dense-ratings")
    model = fit_ratings(rows.where("_train"), "_user", "_item", rating, **options)
    scored = model.transform(rows.where("not _train")).select(*test.columns, "prediction")
    if not top:
        return scored
    liked = _recommended(model, numbers, user, item, top)
    return scored.withColumn("place", F.lit(None).cast("int")).unionByName(liked, allowMissingColumns=True)


def _recommended(model: ALSModel, numbers: DataFrame, user: str, item: str, top: int) -> DataFrame:
    """``user``, ``item``, ``prediction`` and ``place`` of the ``top`` items of every user, by their original ids."""

    def factors(found: DataFrame, is_item: int, col: str) -> DataFrame:
        own = numbers.where(F.col("_is_item") == is_item).select(col, F.col("_dense").cast("int").alias("id"))
        return found.join(own, "id")

    users = factors(model.userFactors, 0, user).select(user, "features")
    items = factors(model.itemFactors, 1, item).withColumnRenamed("features", "_other")
    return largest_products(users, "features", items, item, "_other", "id", top).withColumnRenamed("product", "prediction")
