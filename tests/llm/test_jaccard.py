import random

import pytest
from brute import components, corpus

from millrace.llm import jaccard
from millrace.llm.components import connected_components


def result(df, **options):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.components_by_id(df, "doc_id", "text", **options).collect()}


@pytest.mark.parametrize("seed,k,percent", [(0, 4, 85), (1, 5, 80), (2, 1, 50), (3, 2, 60)])
def test_against_all_pairs(docs, seed, k, percent):
    rows = [*corpus(seed, 90), (2000, None), (2001, ""), (2002, "one two"), (2003, "One TWO"), (2004, "  ")]
    assert result(docs(rows), k=k, percent=percent) == components(rows, k, percent)


def test_a_large_group_of_near_copies_and_a_frequent_passage(docs, monkeypatch):
    monkeypatch.setattr(jaccard, "TOTAL_COUNT", 8)
    r = random.Random(4)
    base = [f"b{i}" for i in range(60)]
    rows = []
    for i in range(60):
        w = list(base)
        for _ in range(r.randint(0, 3)):
            w[r.randrange(60)] = f"x{r.randrange(10_000)}"
        rows.append((i, " ".join(w)))
    passage = " ".join(f"p{i}" for i in range(40))
    rows += [(100 + i, passage + " " + " ".join(f"u{i}_{j}" for j in range(r.randint(3, 60)))) for i in range(60)]
    assert result(docs(rows), k=4, percent=70) == components(rows, 4, 70)


def test_the_limit_itself_links(docs):
    # 17 of 20 shingles of one word are 85 percent
    a, b = [f"w{i}" for i in range(20)], [f"w{i}" for i in range(17)]
    assert result(docs([(1, " ".join(a)), (2, " ".join(b))]), k=1, percent=85)[2] == (17, 1)
    assert result(docs([(1, " ".join(a)), (2, " ".join(b[:16]))]), k=1, percent=85)[2] == (16, 2)


def test_beginnings_of_linked_sets_share_what_the_bound_says():
    for percent in (50, 80, 85, 95):
        for n in range(1, 200):
            for m in range(n, min(200, 100 * n // percent + 2)):
                # the least overlap that links, and the worst place for it: at the ends of the order
                both = next((o for o in range(1, n + 1) if 100 * o >= percent * (n + m - o)), None)
                if both is None:
                    continue
                rest = max(n - int(jaccard.beginning(n, percent)), m - int(jaccard.beginning(m, percent)))
                assert both - rest >= jaccard.least_met(n, percent) and both - rest >= jaccard.least_met(m, percent)


def test_chains_reach_the_smallest_id(docs):
    w = [f"w{i}" for i in range(200)]
    rows = [(50 - i, " ".join(w[2 * i : 2 * i + 60])) for i in range(12)]
    assert result(docs(rows), k=1, percent=90) == components(rows, 1, 90)


def test_null_and_repeated_ids_and_empty_table(docs):
    text = "a b c d e f"
    out = jaccard.components_by_id(docs([(None, text), (7, text), (7, text), (7, "other words here")]), "doc_id", "text")
    got = sorted(((r.doc_id is None, r.doc_id, r.n_shingles, r.component_id) for r in out.collect()), key=str)
    assert got == [(False, 7, 1, 7), (False, 7, 2, 7), (False, 7, 2, 7), (True, None, 2, 7)]
    assert result(docs([(None, "x y")]))[None] == (1, None)
    assert result(docs([])) == {}


def test_components_of_paths_stars_and_repeats(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 100 + i) for i in range(30)] + [(5, 4), (5, 5), (200, 199), (199, 200)]
    out = connected_components(spark.createDataFrame(edges, "u int, v int")).collect()
    want = {i: 0 for i in range(31)} | {100 + i: 100 for i in range(30)} | {199: 199, 200: 199}
    assert {r.node: r.root for r in out} == want and len(out) == len(want)
    assert connected_components(spark.createDataFrame([], "u int, v int")).count() == 0
