import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from brute import shingles

from millrace.llm import fingerprints as fp


def rows_of(df):
    return {r.doc_id: r for r in fp.edited_pairs(df, "doc_id", "text").collect()}


def edited(rows):
    """{doc_id: edited text}; null ids last, ids distinct."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = {}
    for i, (doc_id, text) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        half = len(text) // 2
        out[doc_id] = text[: len(text) - half] + after[:half]
    return out


def sample(seed, n=80):
    r = random.Random(seed)
    vocab = [f"wörd{i}" for i in range(400)]
    rows = [(i * 3, " ".join(r.choice(vocab) for _ in range(r.randint(0, 300)))) for i in range(n)]
    return [*rows, (1000, None), (1001, ""), (-5, "\U0001f600" * 7), (None, "end of all"), (1 << 62, "x" * 1001)]


@pytest.mark.parametrize("parts", [1, 5])
def test_edited_texts_and_lengths(docs, parts):
    rows = sample(parts)
    got, want = rows_of(docs(rows, parts)), edited(rows)
    assert got.keys() == want.keys()
    for doc_id, text in rows:
        assert got[doc_id].n_chars == len(text or "")
        assert got[doc_id].edited_sha256 == hashlib.sha256(want[doc_id].encode()).hexdigest()
        assert got[doc_id].edited_fingerprint == packed(want[doc_id])
        assert got[doc_id].fingerprint == packed(text)


def packed(text):
    return fp.packed(fp.codes(pa.array([text], pa.string()))[0])[0]


def test_likeness_is_close_to_the_jaccard_similarity():
    r = random.Random(1)
    errors = []
    for share in (0.0, 0.2, 0.5, 0.8, 0.95, 1.0):
        for _ in range(20):
            a = [f"w{r.randrange(10**6)}" for _ in range(400)]
            b = [x if i < share * 400 else f"v{r.randrange(10**6)}" for i, x in enumerate(a)]
            x, y = " ".join(a), " ".join(b)
            (p, pw), (q, qw) = (fp.codes(pa.array([t])) for t in (x, y))
            s, t = shingles(x, 5), shingles(y, 5)
            errors.append(fp.likeness(p, q, pw, qw)[0] - len(s & t) / len(s | t))
    assert abs(np.mean(errors)) < 0.01 and np.max(np.abs(errors)) < 0.1


def test_densification_fills_every_bin_from_a_full_one():
    table = np.full((2, 64), fp._EMPTY, dtype=np.uint64)
    table[0, 5], table[1, ::2] = 77, np.arange(32)
    dense = fp._densify(table, np.array([True, True]))
    assert (dense[0] == 77).all()
    assert (dense[1, ::2] == np.arange(32)).all() and (dense[1] < 32).all()
    # texts with the same full bins take over the same places
    again = fp._densify(table[1:] + np.where(table[1:] == fp._EMPTY, 0, 100).astype(np.uint64), np.array([True]))
    assert (again[0] == dense[1] + 100).all()


def test_texts_without_words_and_short_texts():
    texts = pa.array([None, "", " \n", "one", "ONE", "one two", "one two three four five"], pa.string())
    low, words = fp.codes(texts)
    same = lambda i, j: fp.likeness(low[i : i + 1], low[j : j + 1], words[i : i + 1], words[j : j + 1])[0]
    assert same(0, 1) == same(1, 2) == 1 and same(2, 3) == 0
    assert same(3, 4) == 1 and same(3, 5) < 0.3
    assert len(set(fp.packed(low))) == 4


def test_one_document_follows_itself_and_none_gives_nothing(docs):
    got = rows_of(docs([(1, "a b c d e f")]))[1]
    assert got.near_next == 1 and got.n_chars == 11
    assert rows_of(docs([])) == {}


def test_repeated_ids_and_rows(docs):
    out = fp.edited_pairs(docs([(1, "a a"), (1, "a a"), (1, "b"), (2, "c c c")]), "doc_id", "text").collect()
    assert sorted((r.doc_id, r.n_chars) for r in out) == [(1, 1), (1, 3), (1, 3), (2, 5)]
    assert len({r.fingerprint for r in out if r.n_chars == 3}) == 1


def test_a_column_of_fingerprints(spark):
    df = spark.createDataFrame([(1, "a b c", "x"), (2, None, "y"), (3, "A b  c", "z")], "doc_id int, text string, bucket string")
    out = {r.doc_id: r for r in fp.with_fingerprint(df, "text").collect()}
    assert out[1].fingerprint == out[3].fingerprint == packed("a b c") and out[2].fingerprint == "0" * 512
    assert out[1].bucket == "x"
    with pytest.raises(ValueError):
        fp.codes(pa.array(["x"]), bins=100)
