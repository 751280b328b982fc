"""Feature preparation."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from millrace.functions import tokens
from millrace.operators.joins import skew_safe_join
from millrace.operators.ordering import with_ordinal
from millrace.operators.partitions import spread_small_input
from millrace.workspace import materialize

# words that a task counts together, besides the rest of a document; all are counted
WORDS_AT_A_TIME = 2_000_000


def assemble(df: DataFrame, cols: Sequence[str], output: str = "features") -> DataFrame:
    """Add one dense vector of the given numeric columns; a null in any of them is an error."""
    return VectorAssembler(inputCols=list(cols), outputCol=output, handleInvalid="error").transform(df)


def center_and_scale(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Replace each column by ``(x - mean) / sample standard deviation``.

    The statistics are one scalar subquery of the same plan; a column that never varies becomes 0.
    """
    stats = df.agg(
        F.struct(*[F.struct(F.avg(c).alias("mean"), F.stddev_samp(c).alias("deviation")).alias(c) for c in cols])
    ).scalar()

    def scaled(c: str) -> Column:
        mean, deviation = stats.getField(c).getField("mean"), stats.getField(c).getField("deviation")
        return F.when(deviation == 0, F.lit(0.0)).otherwise((F.col(c) - mean) / deviation)

    return df.withColumns({c: scaled(c) for c in cols})


def impute_constant(df: DataFrame, col: str, value: float) -> DataFrame:
    """Turn text into a number, with ``value`` where it is missing or not a number."""
    return df.withColumn(col, F.coalesce(F.col(col).try_cast("double"), F.lit(value)))


def impute_mean(df: DataFrame, col: str) -> DataFrame:
    """Turn text into a number, with the mean of the good values where it is missing or not a number."""
    typed = df.withColumn(col, F.col(col).try_cast("double"))
    return typed.withColumn(col, F.coalesce(F.col(col), typed.agg(F.avg(col)).scalar()))


def value_index(df: DataFrame, col: str) -> DataFrame:
    """Index every distinct value of ``col``: ``col``, ``n`` rows, and ``index``.

    Index 0 is the most frequent value; equally frequent values are in alphabetical order. The
    numbering is distributed, so the number of distinct values may be large.
    """
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count("*").alias("n"))
    # joined more than once, so written down with its true size
    return materialize(with_ordinal(counts, [F.col("n").desc(), F.col(col).asc()], "index"), "index")


def index_strings(
    df: DataFrame, index: DataFrame, col: str, salt_by: Sequence[str], output: str, unknown: str = "keep"
) -> DataFrame:
    """Add the index of ``col`` to each row; ``index`` comes from ``value_index``.

    Values that the index does not have, null among them, get no index with ``unknown="keep"``, drop their
    row with ``"drop"``, and end the query with ``"error"``.
    """
    lookup = index.select(F.col(col), F.col("index").alias(output))
    how = "inner" if unknown == "drop" else "left"
    out = skew_safe_join(df, lookup, col, salt_by, how, key_counts=index.select(col, "n"))
    if unknown != "error":
        return out
    complain = F.raise_error(F.concat(F.lit(f"{col} without an index: "), F.coalesce(F.col(col).cast("string"), F.lit("null"))))
    return out.withColumn(output, F.coalesce(output, complain.cast("bigint")))


def strings_of_index(
    df: DataFrame, index: DataFrame, col: str, source: str, salt_by: Sequence[str], output: str
) -> DataFrame:
    """Add the original value of the index in ``source``; the inverse of ``index_strings``. No index, no value."""
    lookup = index.select(F.col("index").alias(source), F.col(col).alias(output))
    counts = index.select(F.col("index").alias(source), "n")
    return skew_safe_join(df, lookup, source, salt_by, "left", key_counts=counts)


def _lists_of(ids: pa.Array, words: pa.Array) -> pa.RecordBatch:
    """The lists of ``_term_lists`` for some documents and their words."""
    coded = words.flatten().dictionary_encode()
    # one number for each word and document, so that equal ones are occurrences in one document
    keys = coded.indices.to_numpy().astype(np.int64)
    keys *= len(words)
    keys += pc.list_parent_indices(words).to_numpy(zero_copy_only=False)
    pairs, tf = np.unique(keys, return_counts=True)
    code, row = np.divmod(pairs, max(1, len(words)))
    # the pairs are in the order of their words; those of a word are brought into the order of their counts
    same = code * (tf.max(initial=0) + 1) + tf
    order = np.argsort(same, kind="stable")
    starts = np.flatnonzero(np.diff(same[order], prepend=-1))
    ends = np.append(starts, len(order))
    first = order[starts]
    docs = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), ids.take(pa.array(row[order])))
    columns = [coded.dictionary.take(pa.array(code[first])), pa.array(tf[first], pa.int64()), pa.array(np.diff(ends), pa.int64()), docs]
    return pa.RecordBatch.from_arrays(columns, names=["term", "tf", "_n", "_docs"])


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, words = batch.columns
        # cut before the document that starts in another stretch of words
        stretch = words.offsets.to_numpy()[:-1] // WORDS_AT_A_TIME
        cuts = [0, *(np.flatnonzero(np.diff(stretch)) + 1).tolist(), len(batch)]
        for lo, hi in pairwise(cuts):
            yield _lists_of(ids.slice(lo, hi - lo), words.slice(lo, hi - lo))


def _term_lists(df: DataFrame, doc: str, text: str) -> DataFrame:
    """Terms with the list of rows that have them ``tf`` times: ``term``, ``tf``, ``_n`` rows, ``_docs``.

    A list is made from a part of an Arrow batch, which bounds its length, so a term has lists for each part it is in.
    """
    words = spread_small_input(df.select(doc, text)).select(doc, tokens(F.col(text)).alias("_words"))
    docs = StructField("_docs", ArrayType(df.schema[doc].dataType))
    schema = StructType([*StructType.fromDDL("term string, tf bigint, _n bigint").fields, docs])
    return words.mapInArrow(_gathered, schema)


def term_counts(df: DataFrame, doc: str, text: str, *, one_row_per_doc: bool = False) -> DataFrame:
    """``doc``, ``term`` and its number of occurrences ``tf``.

    Terms are counted within their row, and then the rows of a document are brought together. Who knows that
    each ``doc`` has one row says so and saves that shuffle.
    """
    counts = _term_lists(df, doc, text).select(F.explode("_docs").alias(doc), "term", "tf")
    if one_row_per_doc:
        return counts
    return counts.groupBy(doc, "term").agg(F.sum("tf").alias("tf"))


def tf_idf(df: DataFrame, doc: str, text: str, *, one_row_per_doc: bool = False, digits: int | None = None) -> DataFrame:
    """``doc``, ``term``, ``tf`` and ``tf_idf`` = tf * ln((documents + 1) / (documents with the term + 1)).

    The texts are read and tokenised once: their terms are written down, and read for the vocabulary and for the
    result. With one row for each document they stay lists of documents until they have met the vocabulary and have
    their weight, rounded if ``digits`` are given. Terms of nearly every document are hot keys and are spread by document
    or list.
    """
    if one_row_per_doc:
        found, spread = _term_lists(df, doc, text), "_docs"
    else:
        found, spread = term_counts(df, doc, text).withColumn("_n", F.lit(1).cast("bigint")), doc
    found = materialize(found, "term-counts")
    frequency = materialize(found.groupBy("term").agg(F.sum("_n").alias("n")), "vocabulary")
    # documents, not rows; one without words counts as well
    ids = df if one_row_per_doc else df.select(doc).distinct()
    documents = ids.agg(F.count("*").alias("m")).scalar()
    weights = frequency.select("term", F.log((documents + 1) / (F.col("n") + 1)).alias("idf"))
    joined = skew_safe_join(found.drop("_n"), weights, "term", salt_by=[spread], key_counts=frequency)
    weight = F.col("tf") * F.col("idf")
    weighted = joined.withColumn("tf_idf", weight if digits is None else F.round(weight, digits))
    if one_row_per_doc:
        weighted = weighted.withColumn(doc, F.explode("_docs"))
    return weighted.select(doc, "term", "tf", "tf_idf")


def principal_components(df: DataFrame, k: int, source: str = "features", output: str = "components") -> DataFrame:
    """Project each vector on the ``k`` directions of largest variance; the mean is not subtracted."""
    return PCA(k=k, inputCol=source, outputCol=output).fit(df).transform(df)
