"""Token alignment against walking through both encodings."""

import random

import brute
import numpy as np
import pyarrow.parquet as pq
import pytest
from millrace.llm import token_alignment
from millrace.llm.queries import tokenizer_file
from millrace.workspace import materialize
from pyspark.sql import functions as F

FILES = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")
FRAGMENTS = [" ", "  ", "\n", "\t", "the", " house", "Straße", "日本語", "😀", "ab", "zq", "é", "1234", "...", "<|endoftext|>", "<s>", "<unk>", "<0x41>", "\0", "xX"]


def found(df):
    out = token_alignment.align(df, "doc_id", "text", *FILES).collect()
    return {r.doc_id: (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in out}


def made(seed, n=150):
    r = random.Random(seed)
    texts = ["".join(r.choices(FRAGMENTS, k=r.randint(0, 40))) for _ in range(n)]
    texts += ["".join(r.choices("abcdefgh", k=r.randint(1, 300))) for _ in range(n // 3)]
    texts += ["odd ▁ sign", None, "", " ", "▁", "a" * 500, "copy", "copy"]
    return list(zip(r.sample(range(-1000, 1000), len(texts)), texts))


@pytest.mark.parametrize(("stored", "work", "terms"), [(4_000_000, 500_000, 2_000_000), (300, 100, 5)])
def test_against_walking_through(docs, monkeypatch, stored, work, terms):
    monkeypatch.setattr(token_alignment, "STORED_BYTES", stored)
    monkeypatch.setattr(token_alignment, "WORK_BYTES", work)
    monkeypatch.setattr(token_alignment.Sparse.times, "__defaults__", (terms,))
    monkeypatch.setattr(token_alignment, "ROWS_PER_TASK", 3 if stored < 1000 else 1_000_000)
    rows = made(stored)
    want = brute.aligned(rows, *FILES)
    assert found(docs(rows)) == want
    assert any(x[3] > max(x[0], x[1]) > 0 for x in want.values())
    assert sum(x[0] == 0 for x in want.values()) > 3


def test_a_very_long_text(docs):
    r = random.Random(5)
    rows = [(1, " ".join(r.choices(FRAGMENTS[3:14], k=60_000))), (2, "".join(r.choices("abcdefgh", k=30_000))), (3, "the house")]
    assert found(docs(rows)) == brute.aligned(rows, *FILES)


def test_repeats_nulls_and_clashing_names(spark):
    rows = [(1, "a house", "x"), (1, "a house", "x"), (1, "other words", "x"), (None, "a house", "x"), (2, None, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, slice string").withColumn("count", F.lit(1)).withColumn("a", F.lit("b"))
    out = token_alignment.align(df, "doc_id", "text", *FILES).collect()
    # as if all ids were different
    want = brute.aligned([(i, t) for i, (_, t, _) in enumerate(rows)], *FILES)
    assert sorted((r.n_a, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in out) == sorted((x[0], *x[3:]) for x in want.values())
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in out) == [(False, 1), (False, 1), (False, 1), (False, 2), (True, 0)]
    assert token_alignment.align(df.limit(0), "doc_id", "text", *FILES).count() == 0


def test_only_texts_without_tokens(docs):
    assert found(docs([(1, None), (2, ""), (3, "▁")])) == {i: (0, 0, 0, 0, 0, 0, "") for i in (1, 2, 3)}


def test_overlaps_share_bytes(docs):
    out = token_alignment.align(docs([(1, "zqab Straße houses")]), "doc_id", "text", *FILES).first()
    assert max(out.n_a, out.n_b) <= out.n_overlaps <= out.n_links


@pytest.mark.parametrize("terms", [1, 10, 1000])
def test_product_of_sparse_matrices(terms):
    rng = np.random.default_rng(terms)
    a, b = rng.integers(0, 3, (13, 9)) * (rng.random((13, 9)) < 0.4), rng.integers(0, 3, (9, 17)) * (rng.random((9, 17)) < 0.4)
    sparse = [token_alignment.Sparse.of_counts(np.repeat(np.nonzero(m)[0], m[m > 0]), np.repeat(np.nonzero(m)[1], m[m > 0]), *m.shape) for m in (a, b)]
    out = np.zeros((13, 17), np.int64)
    for rows, columns, values in sparse[0].times(sparse[1], terms):
        assert (out[rows, columns] == 0).all()
        out[rows, columns] = values
    assert (out == a @ b).all()
    turned = sparse[0].transposed()
    assert [turned.columns[lo:hi].tolist() for lo, hi in zip(turned.first, turned.first[1:])] == [np.nonzero(x)[0].tolist() for x in a.T]


def test_what_is_stored_has_a_row_for_each_document_and_small_groups_of_rows(docs, monkeypatch):
    written = {}

    def keep(df, label, *options):
        return written.setdefault(label, materialize(df, label, *options))

    monkeypatch.setattr(token_alignment, "materialize", keep)
    r = random.Random(9)
    rows = [(i, " ".join(r.choices(FRAGMENTS[3:14], k=4000))) for i in range(40)] + [(40, None), (41, "the house")]
    monkeypatch.setattr(token_alignment, "STORED_GROUP", token_alignment.STORED_GROUP | {"parquet.block.size": 30_000})
    assert found(docs(rows)) == brute.aligned(rows, *FILES)
    stored = written["alignment"]
    slices = stored.select("slice").distinct().count()
    # no row holds what a whole slice has
    assert slices < len(rows) and stored.count() == len(rows) + slices
    assert stored.groupBy("slice").agg(F.count("pairs").alias("n")).where("n != 1").count() == 0
    files = [pq.ParquetFile(x.removeprefix("file:")).metadata for x in stored.inputFiles()]
    sizes = [f.row_group(i).num_rows for f in files for i in range(f.num_row_groups)]
    assert sum(sizes) == len(rows) + slices and max(sizes) < 20
