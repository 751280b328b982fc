"""Whether fitted models are what their training is to reach: conditions on the model, as aggregates over the data."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import add

from pyspark.ml.clustering import KMeansModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.recommendation import ALSModel
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda total, x: total + x)


def _norm(a: Column) -> Column:
    return F.sqrt(_dot(a, a))


def _plus(terms: Iterable[Column]) -> Column:
    return reduce(add, terms)


def rating_residuals(model: ALSModel, ratings: DataFrame, user: str, item: str, rating: str, reg: float) -> DataFrame:
    """``user``, its number of ratings ``n`` and the ``residual`` of its normal equations, relative to their terms.

    The factors p of a user solve, for the factors q of the items it has rated, sum(q (q.p - rating)) + reg n p = 0. The
    last step of the training solves just that for every user, so what is left is rounding to 32 bits. Ratings are joined
    with the factors of both sides and added up once per user.
    """
    users = model.userFactors.select(F.col("id").alias(user), F.col("features").alias("_p"))
    items = model.itemFactors.select(F.col("id").alias(item), F.col("features").alias("_q"))
    rated = ratings.select(user, item, F.col(rating).cast("float").cast("double").alias("_r")).na.drop()
    rows = rated.join(items, item).join(users, user)
    # place by place in columns of doubles, which Spark compiles; factors travel as the arrays of floats that they are
    places = range(model.rank)
    names = [f"_q{i}" for i in places]
    opened = rows.select(user, "_r", "_p", *[F.get("_q", F.lit(i)).cast("double").alias(n) for i, n in zip(places, names)])
    error = _plus(F.col(n) * F.get("_p", F.lit(i)) for i, n in zip(places, names)) - F.col("_r")
    size = F.sqrt(_plus(F.col(n) * F.col(n) for n in names)) * F.abs("_r")
    sized = opened.select(user, "_p", *names, error.alias("_e"), size.alias("_size"))
    pulls = F.array(*[F.sum(F.col(n) * F.col("_e")) for n in names])
    sums = sized.groupBy(user, "_p").agg(F.count("*").alias("n"), pulls.alias("_sum"), F.sum("_size").alias("_size"))
    sums = sums.withColumn("_p", F.col("_p").cast("array<double>"))
    left = F.zip_with("_sum", "_p", lambda s, p: s + F.lit(reg) * F.col("n") * p)
    scale = F.col("_size") + F.lit(reg) * F.col("n") * _norm(F.col("_p"))
    return sums.select(user, "n", F.coalesce(F.try_divide(_norm(left), scale), F.lit(0.0)).alias("residual"))


def centre_residuals(model: KMeansModel, points: DataFrame, features: str = "features") -> DataFrame:
    """``cluster``, its number of points ``n``, and how far its centre is from their mean.

    Where the training has come to rest every centre is the mean of the points nearest to it.
    """
    centres = [F.array(*[F.lit(float(x)) for x in c]) for c in model.clusterCenters()]
    assigned = model.transform(points).select(F.col("prediction").alias("cluster"), F.col(features).alias("_at"))
    means = assigned.groupBy("cluster").agg(F.count("*").alias("n"), vector_to_array(Summarizer.mean(F.col("_at"))).alias("_mean"))
    gap = F.zip_with("_mean", F.get(F.array(*centres), F.col("cluster")), lambda a, b: a - b)
    return means.select("cluster", "n", _norm(gap).alias("residual"))
