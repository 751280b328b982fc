import random

import pytest

from millrace.llm import mixing

SCHEMA = "doc_id bigint, text string, source string"


def targets(sizes, weights=(5, 2, 1), percent=150, times=2):
    """Share by weight, stop at the limits, share the excess again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, open_, left = {}, set(order), sum(sizes.values()) * percent / 100
    while open_:
        unit = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if unit * weight[s] >= times * sizes[s]}
        if not over:
            return target | {s: unit * weight[s] for s in open_}
        for s in over:
            target[s] = times * sizes[s]
            left -= target[s]
        open_ -= over
    return target


def mixed(df):
    return mixing.mix(df, "doc_id", "text", "source").collect()


@pytest.mark.parametrize("seed", range(4))
def test_targets_and_budgets(spark, seed):
    r = random.Random(seed)
    names = ["a", "B", "é", "", None, "zz", "src10", "src9"][: r.randint(1, 8)]
    rows = [(i, "w " * r.choice([0, 1, 3, 50, 400]), r.choice(names) if r.random() < 0.6 else names[0]) for i in range(200)]
    out = mixed(spark.createDataFrame(rows, SCHEMA).repartition(5))
    assert sorted(x.doc_id for x in out) == list(range(200))
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(text.split())
    want = targets(sizes)
    for source in sizes:
        own = [x for x in out if x.source == source]
        assert all(x.source_size == sizes[source] and x.target == pytest.approx(want[source]) for x in own)
        assert sum(x.taken for x in own) == pytest.approx(want[source], abs=1)
    assert all(0 <= x.taken <= 2 * x.size for x in out)
    again = mixed(spark.createDataFrame(rows[::-1], SCHEMA).repartition(2))
    assert {(x.doc_id, x.taken) for x in out} == {(x.doc_id, x.taken) for x in again}


def test_words_nulls_and_empty_tables(spark):
    rows = [(1, None, None), (2, "a b\tc\x0b d", None), (None, "x y", "s"), (None, "x y z", "s"), (4, "", "t")]
    out = mixed(spark.createDataFrame(rows, SCHEMA))
    # a no-break space is part of a word
    assert sorted((str(x.doc_id), x.size) for x in out) == [("1", 0), ("2", 3), ("4", 0), ("None", 2), ("None", 3)]
    assert sum(x.taken for x in out) == 12
    assert mixed(spark.createDataFrame([], SCHEMA)) == []
    only_empty = mixed(spark.createDataFrame([(1, "", "a"), (2, None, "b")], SCHEMA))
    assert [(x.size, x.target, x.taken) for x in only_empty] == [(0, 0.0, 0)] * 2


def test_hot_source_is_cut_over_many_ranges(spark):
    rows = [(i, "w w w", "hot" if i % 3 else f"s{i % 7}") for i in range(3000)]
    out = mixed(spark.createDataFrame(rows, SCHEMA).repartition(8))
    hot = [x for x in out if x.source == "hot"]
    assert sum(x.taken for x in hot) == int(hot[0].target)


def test_share_above_the_limit_is_refused(spark):
    df = spark.createDataFrame([(1, "a", "s")], SCHEMA)
    with pytest.raises(ValueError):
        mixing.mix(df, "doc_id", "text", "source", share_percent=300)
