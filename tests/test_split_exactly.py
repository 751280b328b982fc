"""Parts of exactly the size that is asked for."""

import hashlib
import math

import pytest
from millrace.operators import sampling


def plain(data, weights):
    """Rows (stratum, key) with their part, by sorting each stratum."""
    out = []
    for stratum in {s for s, _ in data}:
        keys = [k for s, k in data if s == stratum]
        keys.sort(key=lambda k: ("g", 0) if k is None else (hashlib.md5(str(k).encode()).hexdigest(), k))
        ends = [math.floor(len(keys) * (sum(weights[: i + 1]) / sum(weights)) + 0.5) for i in range(len(weights) - 1)]
        out += [(stratum, k, sum(end <= i for end in ends)) for i, k in enumerate(keys)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("weights", [[7, 2, 1], [1], [0, 1, 0], [1, 0, 0], [0.25, 0.75], [1] * 9])
def test_parts_have_their_sizes(rows, values, weights):
    data = [("large", i) for i in range(700)] + [("small", i) for i in range(3)] + [(None, i) for i in range(41)] + [("one", 5)]
    found = sampling.split_exactly(rows(data, "s string, k bigint"), "k", weights, ["s"])
    assert found.columns == ["s", "k", "part"]
    assert values(found) == plain(data, weights)


def test_the_layout_does_not_matter(rows, values):
    df = rows([(i % 3, i) for i in range(500)], "s int, k int")
    parts = [values(sampling.split_exactly(df.repartition(n), "k", [1, 1], ["s"])) for n in (1, 7, 64)]
    assert parts[0] == parts[1] == parts[2]


def test_a_range_that_holds_several_ends(rows, values, monkeypatch):
    # one digit: sixteen ranges, each with several ends
    monkeypatch.setattr(sampling, "_RANGE_DIGITS", 1)
    data = [("a", i) for i in range(300)] + [("b", i) for i in range(11)]
    weights = [1, 2] * 20
    assert values(sampling.split_exactly(rows(data, "s string, k int"), "k", weights, ["s"])) == plain(data, weights)


def test_no_strata_repeated_and_null_keys_and_no_rows(rows):
    data = [(None, "x")] * 50 + [(1, "y")] * 50
    counts = sampling.split_exactly(rows(data, "k int, part string"), "k", [1, 3]).groupBy("part").count()
    assert {r.part: r["count"] for r in counts.collect()} == {0: 25, 1: 75}
    assert sampling.split_exactly(rows([], "k int"), "k", [1, 3]).count() == 0
    with pytest.raises(ValueError):
        sampling.split_exactly(rows([], "k int"), "k", [-1, 2])
