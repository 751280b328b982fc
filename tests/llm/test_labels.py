"""Toxicity, benchmark decontamination and licence scans."""

import random

import duckdb
import numpy as np
import pytest
from brute import held_out
from pyspark.sql import functions as F

from millrace.llm import decontamination as dc, licences, toxicity

BAD = ["idiot", "scum", "moron"]


def labelled(seed, n=600):
    r = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        w = [f"n{r.randrange(300)}" for _ in range(r.randint(3, 60))]
        bad = r.random() < 0.2
        if bad:
            for _ in range(r.randint(1, 3)):
                w.insert(r.randint(0, len(w)), r.choice(BAD))
        rows.append((i, r.choice([" ".join(w), " ".join(w).upper(), "!! ".join(w)])))
        labels.append((i, int(bad)))
    return rows, labels


def test_held_out_fold(spark):
    df = spark.createDataFrame([(i,) for i in [*range(200), None, -7]], "i bigint")
    for r in df.select("i", toxicity.held_out(df["i"]).alias("h")).collect():
        assert r.h == held_out(r.i)


def test_held_out_texts_are_told_apart(spark, docs):
    rows, labels = labelled(1)
    given = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    df = docs([*rows, (9000, None), (9001, ""), (None, "idiot"), (9001, "scum " * 30_000)])
    models = toxicity.train(df, given, "doc_id", "text", "toxic", usable=~toxicity.held_out(F.col("id")))
    assert len(models) == toxicity.CLASSIFIERS
    out = df.select("doc_id", "text", toxicity.score(df["text"], models).alias("s")).collect()
    truth = dict(labels)
    test = [(truth[r.doc_id], r.s) for r in out if r.doc_id in truth and held_out(r.doc_id)]
    assert np.mean([t == (s >= 0.5) for t, s in test]) > 0.97
    assert all(0 <= r.s <= 1 for r in out)
    odd = {(r.doc_id, r.text and r.text[:4]): r.s for r in out if r.doc_id is None or r.doc_id >= 9000}
    assert odd[9000, None] == odd[9001, ""] < 0.5 < odd[None, "idio"] and odd[9001, "scum"] > 0.5


def test_training_reads_usable_labels_only(spark, docs):
    rows, labels = labelled(2, 300)
    flipped = [(i, 1 - t if held_out(i) else t) for i, t in labels]
    usable = ~toxicity.held_out(F.col("id"))
    fits = [
        toxicity.train(docs(rows), spark.createDataFrame(x, "doc_id bigint, toxic int"), "doc_id", "text", "toxic", usable=usable)
        for x in (labels, flipped)
    ]
    for a, b in zip(*fits, strict=True):
        assert (a.words == b.words).all() and np.allclose(a.weights, b.weights)


def test_without_toxic_examples_every_score_is_zero(spark, docs):
    for labels in ([], [(1, 0)], [(1, None)], [(None, 1)]):
        given = spark.createDataFrame(labels, "doc_id bigint, toxic int")
        df = docs([(1, "x"), (2, None)])
        models = toxicity.train(df, given, "doc_id", "text", "toxic")
        assert [r.s for r in df.select(toxicity.score(df["text"], models).alias("s")).collect()] == [0, 0]


def test_the_clean_risk_does_not_go_below_zero():
    r = np.random.default_rng(0)
    toxic = np.arange(400) < 40
    # a word in a third of the toxic texts and, as the prior says, in a tenth of that share of all
    pairs = [(1, t) for t in range(40) if t % 3] + [(1, t) for t in range(40, 400) if t % 15 == 0]
    pairs += [(int(w), int(t)) for t in range(400) for w in r.integers(2, 40, 5)]
    words, text = np.array([p[0] for p in pairs], np.uint64), np.array([p[1] for p in pairs])
    order = np.lexsort((words, text))
    model = toxicity.train_one(words[order], text[order], toxic, 0.1)
    weights = dict(zip(model.words.tolist(), model.weights))
    assert weights[1] == max(weights.values()) and weights[1] + model.bias > 0
    assert np.isfinite(model.weights).all() and abs(model.weights).max() < 20


# ---------------------------------------------------------------- decontamination


def item(r, n):
    w = [r.choice(["the", "of", "a", "to"]) if r.random() < 0.4 else f"t{r.randrange(3000)}" for _ in range(n)]
    w[n // 2] += "."
    return " ".join(w) + "."


@pytest.mark.parametrize("seed", range(3))
def test_wand_finds_what_scoring_all_items_finds(seed):
    r = random.Random(seed)
    items = [(i, item(r, r.randint(8, 40))) for i in range(60)]
    index = dc.build(items)
    scores = {}
    for t, (numbers, values, _, _) in index.postings.items():
        for number, value in zip(numbers, values):
            scores[number, t] = value
    for number in range(60):
        assert sum(v for (n, _), v in scores.items() if n == number) == pytest.approx(1)
    for _ in range(60):
        words = [w for i in r.sample(range(60), 3) for w in dc.words_of(items[i][1]) if r.random() < 0.7]
        for threshold in (0.05, 0.3, 0.6, 0.9):
            got = dict(dc.block_max_wand(index, sorted(set(words)), threshold))
            want = {n: sum(scores.get((n, t), 0) for t in set(words)) for n in range(60)}
            assert got == pytest.approx({n: s for n, s in want.items() if s >= threshold - 1e-9})
        # the first bound never loses a block
        array = np.array(words, np.uint64)
        bound = dc.block_bounds(index, array, np.zeros(len(array), np.int64), 1)[0]
        for n, s in want.items():
            assert bound[n // dc.BLOCK_ITEMS] >= s - 1e-9


def found(df, items, **options):
    out = dc.contaminated(df, items, "doc_id", "text", "item_id", "text", **options).collect()
    return {(r.doc_id, r.item_id): r for r in out}


@pytest.mark.parametrize("index_bytes", [1 << 20, 400])
def test_planted_items_are_found_wherever_they_stand(spark, docs, index_bytes):
    r = random.Random(7)
    items = [(i, item(r, r.randint(8, 40))) for i in range(25)]
    rows, want = [], set()
    for i in range(80):
        w = item(r, 300).split()
        if i % 2:
            j = r.randrange(25)
            at = r.randint(0, len(w))
            w[at:at] = items[j][1].upper().split()
            want.add((i, j))
        rows.append((i, "\n".join(w)))
    rows += [(100, None), (101, ""), (None, items[3][1]), (102, items[4][1] * 3), (103, "x " * 200_000 + items[5][1])]
    want |= {(None, 3), (102, 4), (103, 5)}
    bench = spark.createDataFrame([*items, (90, None), (91, " "), (92, "..")], "item_id bigint, text string")
    got = found(docs(rows), bench, index_bytes=index_bytes)
    assert got.keys() == want
    assert all(r.score == pytest.approx(1) and r.question_share == r.answer_share == 1 for r in got.values())


def test_partial_hits_are_the_same_for_one_index_and_for_many(spark, docs):
    r = random.Random(11)
    items = [(i, item(r, r.randint(8, 60))) for i in range(40)]
    rows = []
    for i in range(120):
        w = items[i % 40][1].split()
        # the score of what is left is near the threshold
        kept = [x for x in w if r.random() < 0.75]
        rows.append((i, item(r, 150) + " " + " ".join(kept) + " " + item(r, 150)))
    bench = spark.createDataFrame([*items, (90, None), (91, " ")], "item_id bigint, text string")
    one = found(docs(rows), bench, overlap=0.3)
    many = found(docs(rows), bench, overlap=0.3, index_bytes=1500)
    assert len(list(dc.item_shards(bench, "item_id", "text", 1500))) > 3
    assert any(x.score < 0.9 for x in one.values())
    assert one.keys() == many.keys()
    for key, x in one.items():
        y = many[key]
        assert y.score == pytest.approx(x.score) and y[3:] == x[3:]
    index = dc.build(items)
    (n, mean, df), longest = dc.benchmark_statistics(bench, "text")
    assert (n, mean, df) == dc.corpus_statistics(t for _, t in items) and longest == index.longest


def test_upper_case_is_the_same_text(spark, docs):
    text = "Éauxouai et ßer straße, ñoñ élan öl über zehn weiße mäuse. Ça n'est que la réponse."
    bench = spark.createDataFrame([(1, text)], "item_id bigint, text string")
    assert found(docs([(1, f"A B {text.upper()} C"), (2, text)]), bench).keys() == {(1, 1), (2, 1)}


def test_question_without_the_answer_is_not_a_hit(spark, docs):
    question, answer = " ".join(f"q{i}" for i in range(20)) + "?", " ".join(f"a{i}" for i in range(6)) + "."
    bench = spark.createDataFrame([(1, f"{question} {answer}")], "item_id bigint, text string")
    got = found(docs([(1, question), (2, f"{question}\n{answer}"), (3, answer)]), bench)
    assert got.keys() == {(2, 1)}
    assert dc.question_and_answer(f"{question} {answer}") == (question, answer)


def test_empty_benchmark_and_documents(spark, docs):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert found(docs([(1, "a b")]), none) == {}
    assert found(docs([]), spark.createDataFrame([(1, "a b c")], "item_id bigint, text string")) == {}


# ---------------------------------------------------------------- licences


def scanned(spark, rows):
    df = spark.createDataFrame(rows, "doc_id bigint, text string, licence string")
    return {r.doc_id: tuple(r)[1:] for r in licences.scan(df, "doc_id", "text", licences.known_licences(spark)).collect()}


def test_layout_case_copyright_lines_and_spellings_do_not_matter(spark):
    mit = licences.LICENCES["MIT"][0]
    wrapped = "mit licence\n\nCopyright (c) 2020 Some One <a@b.c>\n© 2021 Other\nAll rights reserved.\n\n" + "\n".join(
        mit.removeprefix("MIT License ").upper().replace(",", " ,").split(". ")
    )
    long = "word " * 300_000
    rows = [
        (1, wrapped, "x"),
        (2, mit + " And more.", "x"),
        (3, "prose\n* Released under the MIT Licence!\nmore\nreleased UNDER the mit license\n", None),
        (4, "Licensed under CC BY-NC 4.0.", None),
        (5, None, None),
        (6, "", None),
        (None, "SPDX-License-Identifier: MIT\nx\nLicensed under the Apache License, Version 2.0.", None),
        (7, long + "\nLicensed under CC BY 4.0.", None),
    ]
    assert scanned(spark, rows) == {
        1: ("MIT", 0, "MIT"),
        2: (None, 0, ""),
        3: (None, 2, "MIT"),
        4: ("CC-BY-NC-4.0", 0, "CC-BY-NC-4.0"),
        5: (None, 0, ""),
        6: (None, 0, ""),
        None: (None, 2, "Apache-2.0,MIT"),
        7: (None, 1, "CC-BY-4.0"),
    }
    assert scanned(spark, []) == {}
    connection = duckdb.connect()
    connection.execute("CREATE TABLE documents(doc_id BIGINT, text VARCHAR)")
    connection.executemany("INSERT INTO documents VALUES (?, ?)", [r[:2] for r in rows])
    got = connection.execute(f"SELECT doc_id, whole_licence, n_lines, licences FROM ({licences.scan_sql()})").fetchall()
    assert {r[0]: r[1:] for r in got} == scanned(spark, rows)


def test_every_known_form_is_found(spark):
    forms = [(n, t) for n, texts in licences.LICENCES.items() for t in texts]
    out = scanned(spark, [(i, t, None) for i, (_, t) in enumerate(forms)])
    assert [out[i][0] for i in range(len(forms))] == [n for n, _ in forms]


def test_the_list_of_licences_is_small_by_its_estimate(spark):
    known = licences.known_licences(spark)
    assert int(str(known._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) < 1_000_000
