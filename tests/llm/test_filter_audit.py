"""The filter audit against counting every order by itself."""

import random
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from millrace.llm import filter_audit
from pyspark.sql import functions as F

COLUMNS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def fails_of(rows):
    """The letters each row fails."""
    smallest = {}
    for doc_id, text, _ in rows:
        if doc_id is not None:
            smallest[text or ""] = min(doc_id, smallest.get(text or "", doc_id))
    out = []
    for doc_id, text, _ in rows:
        text = text or ""
        words = [w for w in "".join(" " if c in " \t\n\v\f\r" else c for c in text).split(" ") if w]
        first = smallest.get(text)
        checks = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text),
            "D": any(c in "#$%&*|" for c in text),
            "E": first is not None and (doc_id is None or first < doc_id),
        }
        out.append({letter for letter, bad in checks.items() if bad})
    return out


def brute(rows, labels):
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, t in labels if t == 1}
    out = {}
    fails = fails_of(rows)
    for part in {p or "" for _, _, p in rows}:
        mine = [(i, f) for (i, _, p), f in zip(rows, fails) if (p or "") == part]
        shapley = Counter()
        for order in permutations("ABCDE"):
            left = mine
            for step, letter in enumerate(order, 1):
                gone = [x for x in left if letter in x[1]]
                left = [x for x in left if letter not in x[1]]
                failing = sum(letter in f for _, f in mine)
                shapley[letter] += len(gone)
                lost = [sum(i is not None and i in s for i, _ in gone) for s in (good, toxic)]
                out[part, "".join(order), step] = [len(left), len(gone), failing - len(gone), sum(f == {letter} for _, f in mine), *lost]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return out


def reported(spark, rows, labels):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").selectExpr("*", "1 AS digest", "2 AS word", "3 AS quality").repartition(4)
    said = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    out = filter_audit.audit(docs, said, "doc_id", "text", "lang").collect()
    found = {(r.part, r.filter_order, r.step): [r[c] for c in COLUMNS] for r in out}
    assert len(found) == len(out)
    return found


def made(seed, n=120):
    r = random.Random(seed)
    words = [*(f"w{i}" for i in range(400)), "#", "a|b", "ABCDEFGH", "XY", "é", "日本", " ", "\x85"]
    texts = []
    for _ in range(n):
        k = r.choice([0, 1, 150, 199, 200, 201, 320, 900])
        vocabulary = r.sample(words, r.choice([3, 100, 300, len(words)]))
        texts.append(r.choice([" ", "\n", " \t"]).join(r.choices(vocabulary, k=k)))
    texts += r.choices(texts, k=n // 3)
    ids = r.sample(range(-500, 500), len(texts))
    rows = [(i, t, r.choice(["en", "de", None, ""])) for i, t in zip(ids, texts)]
    labels = [(i, r.choice([0, 1, None]), r.choice([0, 1, None])) for i in r.sample(ids, n // 2)]
    return rows, labels


@pytest.mark.parametrize("seed", [1, 2])
def test_all_orders(spark, seed):
    rows, labels = made(seed)
    assert reported(spark, rows, labels) == brute(rows, labels)


def test_nulls_repeats_and_ties(spark):
    text = " ".join(f"w{i}" for i in range(250))
    rows = [(1, text, "en"), (1, text, "en"), (1, text, None), (2, text, "de"), (None, text, "en"), (None, "only here", "en"), (None, "only here", "en"), (3, None, "en"), (4, "", "en")]
    labels = [(1, 1, 0), (1, 0, 1), (None, 1, 1), (9, 1, 1)]
    assert reported(spark, rows, labels) == brute(rows, labels)


def test_empty_tables(spark):
    assert reported(spark, [], []) == {}
    found = reported(spark, [(1, "a", "en")], [])
    assert len(found) == 600 and found["en", "ABCDE", 1] == [0, 1, 0, 1, 0, 0, 120]


def test_a_very_long_text_and_a_large_group_of_copies(spark, monkeypatch):
    monkeypatch.setattr(filter_audit, "ROWS_PER_TASK", 7)
    rows = [(i, "copy of this", "en") for i in range(300)] + [(1000, "long text " * 400_000, "fr")]
    assert reported(spark, rows, [(5, 1, 1)]) == brute(rows, [(5, 1, 1)])


def test_many_parts(spark, monkeypatch):
    monkeypatch.setattr(filter_audit, "_HELD_PARTS", 3)
    rows = [(i, f"t{i % 7}", f"p{i % 11}") for i in range(60)]
    assert reported(spark, rows, []) == brute(rows, [])


@pytest.mark.parametrize("n", [0, 1, 2, 3, 7, 1000, 4097])
def test_positional_counts(n):
    words = np.random.default_rng(n).integers(0, 1 << 32, n, dtype=np.uint32)
    assert filter_audit.positional_counts(words).tolist() == [int((words >> i & 1).sum()) for i in range(32)]


def test_words_are_truth_tables(spark):
    out = spark.range(32).select("id", filter_audit.survival_word(F.col("id").cast("int")).alias("w")).collect()
    for r in out:
        assert [r.w >> s & 1 for s in range(32)] == [int(not r.id & s) for s in range(32)]
