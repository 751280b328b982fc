import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.feature import IDF, HashingTF, StringIndexer, Tokenizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from millrace.operators import features as X


def test_assemble_keeps_other_columns_and_rejects_nulls(rows):
    df = rows([(1, 2.0, 3)], "id int, a double, b int")
    assert X.assemble(df, ["a", "b"]).first().asDict() == {"id": 1, "a": 2.0, "b": 3, "features": Vectors.dense(2, 3)}
    with pytest.raises(Exception, match="null"):
        X.assemble(rows([(None,)], "a double"), ["a"]).collect()


def test_center_and_scale(rows):
    df = rows([(1, 1.0, 5.0), (2, 2.0, 5.0), (3, 3.0, 5.0)], "id int, a double, b double")
    scaled = X.center_and_scale(df, ["a", "b"]).orderBy("id").collect()
    assert [(r.a, r.b) for r in scaled] == [(-1.0, 0.0), (0.0, 0.0), (1.0, 0.0)]


def test_imputation(rows):
    df = rows([("130",), ("?",), ("150",)], "hp string")
    assert [r.hp for r in X.impute_constant(df, "hp", 80.0).collect()] == [130.0, 80.0, 150.0]
    assert [r.hp for r in X.impute_mean(df, "hp").collect()] == [130.0, 140.0, 150.0]


def test_value_index_equals_the_string_indexer(rows):
    data = [(i, w) for i, w in enumerate(["b", "a", "c", "c", "d", "d", "d", "e", "a"])]
    df = rows(data, "id int, w string")
    index = X.value_index(df, "w")
    mine = {r.id: r.idx for r in X.index_strings(df, index, "w", ["id"], "idx").collect()}
    theirs = StringIndexer(inputCol="w", outputCol="idx").fit(df).transform(df)
    assert mine == {r.id: int(r.idx) for r in theirs.collect()}
    back = X.strings_of_index(X.index_strings(df, index, "w", ["id"], "idx").drop("w"), index, "w", "idx", ["id"], "w")
    assert {(r.id, r.w) for r in back.collect()} == set(data)


def test_value_index_of_the_worked_example(rows, values):
    index = X.value_index(rows([(w,) for w in "bacc"], "w string"), "w")
    assert [w for _, w in values(index, "index", "w")] == ["c", "a", "b"]


def test_tf_idf_of_the_worked_example(rows):
    df = rows([(1, "a b"), (2, "a"), (3, "c")], "id int, text string")
    weights = {(r.id, r.term): r.tf_idf for r in X.tf_idf(df, "id", "text").collect()}
    a, rare = math.log(4 / 3), math.log(2)
    assert weights == {
        (1, "a"): pytest.approx(a), (1, "b"): pytest.approx(rare),
        (2, "a"): pytest.approx(a), (3, "c"): pytest.approx(rare),
    }


def test_tf_idf_equals_the_ml_stages(rows):
    df = rows([(1, "x y x z"), (2, "y y"), (3, "q x"), (4, "")], "id int, text string")
    words = Tokenizer(inputCol="text", outputCol="words").transform(df)
    hashed = HashingTF(inputCol="words", outputCol="tf").transform(words)
    weighted = IDF(inputCol="tf", outputCol="v").fit(hashed).transform(hashed)
    theirs = {r.id: sorted(w for w in r.v if w) for r in weighted.select("id", vector_to_array("v").alias("v")).collect()}
    mine = {}
    for r in X.tf_idf(df, "id", "text").collect():
        mine.setdefault(r.id, []).append(r.tf_idf)
    assert mine.keys() == theirs.keys()
    for key in mine:
        assert sorted(mine[key]) == pytest.approx(theirs[key])


def test_principal_components_follow_the_largest_variance(spark):
    df = spark.range(200).select(
        F.col("id"), F.array(F.col("id") * 1.0, F.col("id") * 2.0, (F.col("id") % 3) * 1.0).alias("a")
    )
    out = X.principal_components(df.select("id", array_to_vector("a").alias("v")), 1, "v", "c")
    first = {r.id: r.c[0] for r in out.collect()}
    # the direction is (1, 2, 0) / sqrt(5), the sign is free, and the mean stays in
    assert abs(first[100]) == pytest.approx(100 * math.sqrt(5), rel=1e-3)


def test_principal_components_equal_an_eigen_decomposition(rows):
    rng = np.random.default_rng(4)
    data = rng.normal(size=(60, 5)) @ rng.normal(size=(5, 5)) + 3
    df = rows([(i, [float(x) for x in v]) for i, v in enumerate(data)], "id int, a array<double>")
    out = X.principal_components(df.select("id", array_to_vector("a").alias("v")), 3, "v", "c").orderBy("id").collect()
    values, vectors = np.linalg.eigh(np.cov(data.T))
    expected = data @ vectors[:, np.argsort(values)[::-1][:3]]
    mine = np.array([r.c.toArray() for r in out])
    np.testing.assert_allclose(np.abs(mine), np.abs(expected), rtol=1e-6, atol=1e-8)


WORDS = ["a", "b", "B", "", "cé", "dd\t", "\n", "x"]


def test_term_counts_equal_brute_force(rows):
    rnd = random.Random(6)
    texts = [" ".join(rnd.choices(WORDS, k=rnd.randrange(40))) for _ in range(80)] + ["", "   ", None, "one " * 5000]
    df = rows(list(enumerate(texts)), "id int, text string")
    expected = Counter()
    for i, text in enumerate(texts):
        if text is None or (text and not text.strip(" \t\n")):
            continue
        parts = re.split(r"[ \t\n]", text.lower().rstrip(" \t\n"))
        expected.update((i, p) for p in parts)
    assert {(r.id, r.term): r.tf for r in X.term_counts(df, "id", "text").collect()} == expected


def test_rows_of_one_document_are_counted_together(rows, values):
    df = rows([(1, "a b a"), (1, "a"), (2, "b")], "id int, text string")
    assert values(X.term_counts(df, "id", "text")) == [(1, "a", 3), (1, "b", 1), (2, "b", 1)]


def test_documents_in_several_rows_count_once(rows):
    df = rows([(1, "x y"), (1, "x"), (2, "x")], "id int, text string")
    got = {(r.id, r.term): (r.tf, r.tf_idf) for r in X.tf_idf(df, "id", "text").collect()}
    assert got[1, "x"] == (2, 0.0) and got[2, "x"] == (1, 0.0)
    assert got[1, "y"][0] == 1 and got[1, "y"][1] == pytest.approx(math.log(3 / 2))


def test_tf_idf_lists_the_documents_of_a_term_and_rounds(spark, monkeypatch):
    texts = ["a b b", "a", "a", "", None, "b b a a", "  "]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string").coalesce(1)
    monkeypatch.setattr(X, "spread_small_input", lambda df: df)
    written = {}

    def materialize(df, label):
        written[label] = df.localCheckpoint()
        return written[label]

    monkeypatch.setattr(X, "materialize", materialize)
    got = sorted(tuple(r) for r in X.tf_idf(df, "id", "text", one_row_per_doc=True, digits=3).collect())
    # seven documents, of which four have an "a", two a "b" and one the empty term
    a, b, empty = math.log(8 / 5), math.log(8 / 3), math.log(8 / 2)
    expected = [(0, "a", 1, a), (0, "b", 2, 2 * b), (1, "a", 1, a), (2, "a", 1, a), (3, "", 1, empty), (5, "a", 2, 2 * a), (5, "b", 2, 2 * b)]
    assert got == [(i, term, tf, round(w, 3)) for i, term, tf, w in expected]
    # what is written, shuffled and joined is a row for each term and count, not for each term of a document
    lists = sorted((r.term, r.tf, r._docs) for r in written["term-counts"].collect())
    assert lists == [("", 1, [3]), ("a", 1, [0, 1, 2]), ("a", 2, [5]), ("b", 2, [0, 5])]


def test_term_lists_do_not_depend_on_where_they_are_cut(monkeypatch):
    rnd = random.Random(7)
    words = [[rnd.choice("abcdé") for _ in range(rnd.randrange(30))] for _ in range(60)]
    words[7:9] = [None, []]
    expected = Counter((i, w) for i, doc in enumerate(words) for w in doc or [])
    batch = pa.RecordBatch.from_arrays([pa.array(range(60)), pa.array(words, pa.list_(pa.string()))], names=["id", "words"])
    for most in (1, 17, 400, 10**6):
        monkeypatch.setattr(X, "WORDS_AT_A_TIME", most)
        for batches in ([batch], [batch.slice(0, 0), batch.slice(0, 25), batch.slice(25)]):
            lists = [r for part in X._gathered(iter(batches)) for r in part.to_pylist()]
            entries = [((doc, r["term"]), r["tf"]) for r in lists for doc in r["_docs"]]
            assert len(entries) == len(expected) and dict(entries) == expected
            assert all(r["_n"] == len(r["_docs"]) for r in lists)


def test_rows_without_a_value_keep_drop_or_refuse(rows, values):
    df = rows([(1, "a"), (2, None), (3, "a")], "id int, c string")
    index = X.value_index(df, "c")
    assert values(X.index_strings(df, index, "c", ["id"], "i"), "id", "i") == [(1, 0), (2, None), (3, 0)]
    assert values(X.index_strings(df, index, "c", ["id"], "i", unknown="drop"), "id", "i") == [(1, 0), (3, 0)]
    with pytest.raises(Exception, match="without an index"):
        X.index_strings(df, index, "c", ["id"], "i", unknown="error").collect()
    indexed = X.index_strings(df, index, "c", ["id"], "i")
    assert values(X.strings_of_index(indexed, index, "c", "i", ["id"], "back"), "id", "back") == [(1, "a"), (2, None), (3, "a")]
