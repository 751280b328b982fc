"""Substring dedup of words and of bytes against plain versions."""

import random

import numpy as np
import pyarrow as pa
import pytest
from brute import corpus, cut_bytes, cut_words

from millrace.llm import repeats, substring_dedup, suffix_dedup
from millrace.llm.repeats import Windows
from millrace.llm.words import word_hashes


def words_result(df, **options):
    out = substring_dedup.remove_repeats(df, "doc_id", "text", **options).collect()
    for r in out:
        assert r.n_removed == sum(s.end - s.begin for s in r.spans)
    return {r.doc_id: (r.n_words, r.n_removed, r.kept_text.encode()) for r in out}


def bytes_result(df, **options):
    out = suffix_dedup.remove_repeats(df, "doc_id", "text", **options).collect()
    for r in out:
        assert r.n_removed == sum(s.end - s.begin for s in r.spans) and r.n_spans == len(r.spans)
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in out}


@pytest.mark.parametrize("seed", range(3))
def test_words_against_plain_version(docs, seed):
    rows = [*corpus(seed), (2000, None), (2001, ""), (2002, " \n "), (None, corpus(seed)[3][1])]
    assert words_result(docs(rows)) == cut_words(rows)


@pytest.mark.parametrize("seed", range(3))
def test_bytes_against_plain_version(docs, seed):
    rows = [*corpus(seed), (2000, None), (2001, ""), (None, corpus(seed)[3][1])]
    assert bytes_result(docs(rows)) == cut_bytes(rows)


def test_short_windows_of_a_tiny_alphabet(docs):
    r = random.Random(5)
    rows = [(i, "".join(r.choice("ab") for _ in range(r.randint(0, 60)))) for i in range(40)]
    assert bytes_result(docs(rows), length=8, seed=4) == cut_bytes(rows, 8)
    rows = [(i, " ".join(r.choice("ab") for _ in range(r.randint(0, 40)))) for i in range(40)]
    assert words_result(docs(rows), words=5, seed=2) == cut_words(rows, 5)


def test_one_unit_repeated_very_often(docs):
    rows = [(1, "a" * 5000), (2, "a" * 30_000), (3, "a" * 49)]
    assert bytes_result(docs(rows)) == cut_bytes(rows)
    rows = [(1, "x " * 5000), (2, "x " * 30_000), (3, "x " * 19)]
    assert words_result(docs(rows)) == cut_words(rows)


def test_a_very_long_text_and_a_very_long_word(docs):
    r = random.Random(1)
    long = " ".join("".join(r.choice("abcdef") for _ in range(7)) for _ in range(400_000))
    rows = [(1, long), (2, "y" * 3_000_000 + " " + long[1_000_000:1_001_000]), (3, long[:2_000_000])]
    got = words_result(docs(rows))
    assert got[1][:2] == (400_000, 0)
    assert got[3][:2] == (250_000, 250_000)
    assert got[2][1] >= 120
    assert bytes_result(docs(rows))[3][1:3] == (2_000_000, 1)


def test_copies_in_one_batch_and_in_many(docs):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(i, text) for i in range(200)]
    for parts in (1, 7):
        got = words_result(docs(rows, parts))
        assert got[0][1] == 0 and all(got[i][1] == 30 for i in range(1, 200))
        got = bytes_result(docs(rows, parts))
        assert got[0][1] == 0 and all(got[i][1] == len(text) for i in range(1, 200))


def test_ids_that_repeat_with_other_texts_and_with_the_same(docs):
    text = " ".join(f"w{i}" for i in range(30))
    same = docs([(1, text), (1, text), (2, text)])
    counts = sorted((r.doc_id, r.n_removed) for r in substring_dedup.remove_repeats(same, "doc_id", "text").collect())
    assert counts == [(1, 0), (1, 0), (2, 30)]
    other = docs([(1, text + " a"), (1, text + " b")])
    counts = sorted(r.n_removed for r in substring_dedup.remove_repeats(other, "doc_id", "text").collect())
    assert counts == [0, 30]


def test_empty_table(docs):
    assert words_result(docs([])) == {} and bytes_result(docs([])) == {}


def test_other_columns_stay_and_clashing_ones_are_replaced(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(1, text, "x", 7, 8), (2, text, None, 7, 8)]
    df = spark.createDataFrame(rows, "doc_id int, text string, _doc string, bucket int, n_removed int")
    out = substring_dedup.remove_repeats(df, "doc_id", "text")
    assert out.columns == ["doc_id", "text", "_doc", "bucket", "n_words", "n_removed", "spans", "kept_text"]
    assert sorted((r.doc_id, r["_doc"], r.bucket, r.n_removed) for r in out.collect()) == [(1, "x", 7, 0), (2, None, 7, 30)]
    out = suffix_dedup.remove_repeats(df, "doc_id", "text")
    assert sorted((r.doc_id, r["_doc"], r.n_removed) for r in out.collect()) == [(1, "x", 0), (2, None, len(text))]


def test_equal_windows_have_equal_anchors():
    r = random.Random(2)
    texts = [" ".join(r.choice("abcd") for _ in range(r.randint(0, 50))) for _ in range(30)]
    windows = Windows(10, 4, word_hashes)
    values, first = word_hashes(pa.array(texts))
    found = windows.anchors(values, first)
    place = {}
    covered = 0
    for t, at, low, high in zip(found.text, found.at, found.low, found.high):
        for s in range(low, high + 1):
            assert first[t] <= s <= at <= s + 6 and s + 10 <= first[t + 1]
            window = tuple(values[s : s + 10].tolist())
            assert place.setdefault(window, at - s) == at - s
            covered += 1
    assert covered == sum(max(0, n - 9) for n in np.diff(first))


def test_windows_around_a_frequent_anchor_are_spread():
    r = random.Random(3)
    line = " ".join(f"line{i}" for i in range(8))
    fill = lambda: " ".join(f"w{r.randrange(10**9)}" for _ in range(30))
    texts = pa.array([f"{fill()} {line} {fill()}" for _ in range(500)] + [f"{fill()} {line} {line} {line} x"] * 2, pa.large_string())
    windows = Windows(20, 6, word_hashes)
    found = windows.anchors(*(units := windows.units(texts)))
    hashes, many = np.unique(found.hash, return_counts=True)
    at = np.flatnonzero(found.hash == hashes[np.argmax(many)])
    assert len(at) > 200
    doc = np.arange(len(texts))
    place = (found.at - units[1][found.text])[at].astype(np.uint32)
    facts = repeats.Facts([repeats.to_block(repeats._candidates(found.text[at], 0 * at, place))])
    batch = pa.RecordBatch.from_pydict({repeats.DOC: doc, repeats.TIE: 0 * doc, "text": texts})
    rows = substring_dedup._windows(batch, facts, "text", windows)
    buckets = substring_dedup._buckets(rows, 64)
    assert np.bincount(buckets, minlength=64).max() < len(rows) / 16
    # equal windows meet
    by_window: dict = {}
    for h1, h2, bucket in zip(rows.column("h1").to_pylist(), rows.column("h2").to_pylist(), buckets.tolist(), strict=True):
        by_window.setdefault((h1, h2), set()).add(bucket)
    assert len(by_window) < len(rows) and all(len(b) == 1 for b in by_window.values())


def rows_of_texts(texts, windows, docs=None):
    """The rows around all anchors of the texts."""
    column = pa.array(texts, pa.large_string())
    found = windows.anchors(*(units := windows.units(column)))
    doc = np.arange(len(texts)) if docs is None else np.array(docs)
    facts = repeats.Facts([repeats.to_block(repeats._candidates(doc[found.text], 0 * found.text, (found.at - units[1][found.text]).astype(np.uint32)))])
    batch = pa.RecordBatch.from_pydict({repeats.DOC: doc, repeats.TIE: 0 * doc, "text": column})
    return substring_dedup._windows(batch, facts, "text", windows)


def removed_starts(rows, length):
    row, place = substring_dedup.repeated_windows(rows, length)
    doc, start = rows.column("doc").to_numpy(), rows.column("start").to_numpy().astype(np.int64)
    return sorted(zip(doc[row].tolist(), (start[row] + place).tolist()))


def later_windows(texts, length):
    seen, out = set(), []
    for doc, text in enumerate(texts):
        w = text.split()
        for i in range(len(w) - length + 1):
            window = tuple(w[i : i + length])
            if window in seen:
                out.append((doc, i))
            seen.add(window)
    return out


@pytest.mark.parametrize("length, seed", [(20, 6), (6, 2), (5, 5), (4, 1)])
def test_rows_around_seeds_are_extended_to_all_repeated_windows(length, seed):
    r = random.Random(length)
    texts = [" ".join(r.choice("ab") for _ in range(r.randint(0, 3 * length))) for _ in range(60)]
    line = " ".join(f"l{i}" for i in range(length + 3))
    texts += [f"{r.random()} {line} {r.random()}" for _ in range(20)] + [f"x {line}", f"{line}", f"y y {line}  \n z"]
    rows = rows_of_texts(texts, Windows(length, seed, word_hashes))
    assert removed_starts(rows, length) == later_windows(texts, length)
    # in parts by gram, and with what is equal settled before
    parts = [x for part in substring_dedup.by_gram(rows) for x in removed_starts(part, length)]
    assert sorted(parts) == later_windows(texts, length)
    sent, runs = substring_dedup._settled(rows, length)
    passed = [(d, s) for d, a, b in zip(*(runs.column(c).to_pylist() for c in ("doc", "start", "stop"))) for s in range(a, b + 1)]
    assert sorted({*passed, *removed_starts(sent, length)}) == later_windows(texts, length)


def test_grams_with_equal_hashes_are_told_apart_by_their_words():
    r = random.Random(4)
    a, b = (" ".join(f"{x}{i}" for i in range(24)) for x in "ab")
    texts = [a, b, f"c {a}", f"{b} c", f"{a} {b}"] + [" ".join(r.choice("ab") for _ in range(30)) for _ in range(9)]
    rows = rows_of_texts(texts, Windows(20, 6, word_hashes))
    clash = {"h1": pa.array(np.zeros(len(rows), np.uint64)), "h2": pa.array(np.zeros(len(rows), np.uint32))}
    clashing = pa.RecordBatch.from_pydict({c: clash.get(c, rows.column(c)) for c in rows.schema.names}, schema=rows.schema)
    assert removed_starts(clashing, 20) == removed_starts(rows, 20) == later_windows(texts, 20)


def test_hash_compared_sort_is_the_suffix_order():
    r = random.Random(3)
    data = np.frombuffer("".join(r.choice("ab") for _ in range(400)).encode(), np.uint8)
    anchor = np.array(sorted(r.sample(range(30, 370), 80)))
    reach = np.array([r.randint(0, 30) for _ in anchor])
    group = np.array([r.randint(0, 3) for _ in anchor])
    for left, salt in ((False, 0), (True, 0), (False, 3)):
        suffixes = suffix_dedup.Suffixes(data, suffix_dedup.salted_sums(data, salt), anchor, reach, left)
        text = [bytes(data[a - n : a])[::-1] if left else bytes(data[a : a + n]) for a, n in zip(anchor, reach)]
        order, common = suffix_dedup.extension_order(suffixes, group)
        assert [(group[i], text[i]) for i in order] == sorted(zip(group.tolist(), text))
        for i in range(1, len(order)):
            a, b = text[order[i - 1]], text[order[i]]
            n = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert common[i] == (n if group[order[i - 1]] == group[order[i]] else 0)
    assert not suffixes.verified(np.array([0]), np.array([1]), np.array([40])) or (data[:40] == data[1:41]).all()


def test_blocks_are_gathered_in_one_order(spark):
    rows = [(i % 8, i % 3, f"block {i}".encode()) for i in range(400)]
    orders = []
    for seed, parts in ((1, 1), (2, 7), (3, 40)):
        given = spark.createDataFrame(random.Random(seed).sample(rows, len(rows)), "bucket int, kind int, block binary")
        dealt = repeats.by_bucket(given.repartition(parts), 4).selectExpr("spark_partition_id() AS part", "*").collect()
        orders.append([(r.part, r.bucket, r.kind, bytes(r.block)) for r in dealt])
        assert {r.part for r in dealt} == set(range(4))
    assert orders[0] == orders[1] == orders[2]
