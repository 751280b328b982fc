"""The nearest of many centres, against comparing with all of them."""

import numpy as np
import pytest
from millrace.operators import nearest
from millrace.operators.models import assign_to_nearest
from pyspark.sql import functions as F


def brute(points, centres):
    out = {}
    for i, p in points:
        out[i] = min((sum((a - b) * (a - b) for a, b in zip(p, c)), k) for k, c in centres)
    return out


def found(df):
    return {r.id: (r.distance, r.cluster) for r in df.collect()}


@pytest.mark.parametrize(("n", "d", "pivots"), [(1, 3, None), (50, 1, 7), (300, 2, None), (300, 16, 1), (300, 5, 300)])
def test_against_all_centres(rows, n, d, pivots):
    rng = np.random.default_rng(n + d)
    # groups of centres, some of them equal, and points that stand on centres
    middle = rng.normal(0, 30, (5, d))
    c = (middle[rng.integers(0, 5, n)] + rng.normal(0, 1, (n, d))).round(1)
    c[n // 2 :: 7] = c[0]
    centres = [(int(k), list(map(float, v))) for k, v in zip(rng.permutation(n), c)]
    p = [*c[:40].tolist(), *rng.normal(0, 40, (60, d)).tolist(), *(middle + 0.5).tolist()]
    points = [(i, list(map(float, v))) for i, v in enumerate(p)]
    out = found(nearest.assign_by_cells(rows(points, "id int, v array<double>"), "v", rows(centres, "k int, centre array<double>"), "k", pivots=pivots))
    for i, (distance, key) in brute(points, centres).items():
        assert out[i] == (pytest.approx(distance**0.5, abs=1e-9), key)


def test_far_from_the_origin_and_equal_distances(rows):
    # the shortcut for many distances loses digits here
    centres = [(k, [1e7 + k * 0.001, -1e7]) for k in range(50)] + [(100, [1e7 + 0.0005, -1e7 + 1])]
    points = [(i, [1e7 + i * 0.001 + 0.0001, -1e7]) for i in range(50)] + [(99, [1e7 + 0.0005, -1e7])]
    out = found(nearest.assign_by_cells(rows(points, "id int, v array<double>"), "v", rows(centres, "k int, centre array<double>"), "k"))
    assert {i: k for i, (_, k) in out.items()} == {i: k for i, (_, k) in brute(points, centres).items()}
    ties = [("b", [1.0]), ("a", [-1.0]), ("c", [1.0])]
    out = found(nearest.assign_by_cells(rows([(1, [0.0])], "id int, v array<double>"), "v", rows(ties, "k string, centre array<double>"), "k"))
    assert out == {1: (1.0, "a")}


def test_nulls_and_empty_tables(rows):
    centres = rows([(1, [0.0, 0.0]), (2, None), (3, [None, 1.0]), (None, [9.0, 9.0]), (4, [float("nan"), 0.0])], "k int, centre array<double>")
    points = rows([(1, [9.0, 9.0]), (2, None), (3, [1.0]), (4, [None, 1.0]), (5, [float("nan"), 1.0]), (6, [])], "id int, v array<double>")
    out = found(nearest.assign_by_cells(points, "v", centres, "k"))
    assert out.pop(1) == (pytest.approx(162**0.5), 1) and set(out.values()) == {(None, None)}
    assert set(found(nearest.assign_by_cells(points, "v", centres.limit(0), "k")).values()) == {(None, None)}
    assert nearest.assign_by_cells(points.limit(0), "v", centres, "k").columns == ["id", "v", "cluster", "distance"]
    with pytest.raises(ValueError, match="values"):
        nearest.build_cells(rows([(1, [0.0]), (2, [0.0, 1.0])], "k int, centre array<double>"), "k", "centre")


def test_a_hundred_thousand_centres(spark, rows):
    # a grid of points in the plane: the nearest is known
    centres = spark.range(100_000).select(F.col("id").alias("k"), F.array((F.col("id") % 400).cast("double"), F.floor(F.col("id") / 400).cast("double")).alias("centre"))
    rng = np.random.default_rng(1)
    points = [(i, [float(x), float(y)]) for i, (x, y) in enumerate(rng.uniform(0, 249, (2000, 2)))]
    df = rows(points, "id int, v array<double>")
    out = found(assign_to_nearest(df, "v", centres, "k"))
    for i, (x, y) in points:
        a, b = round(x), round(y)
        assert out[i] == (pytest.approx(((x - a) ** 2 + (y - b) ** 2) ** 0.5), b * 400 + a)
    cells = nearest.build_cells(centres, "k", "centre")
    _, _, opened = cells.nearest(np.array([v for _, v in points]))
    # of 317 cells few are opened for a point
    assert opened < 20 * len(points)


def test_points_are_read_once_and_no_centre_is_in_the_plan(spark, rows, tmp_path):
    rows([(i, [float(i)]) for i in range(20)], "id int, v array<double>").write.parquet(f"{tmp_path}/points")
    centres = rows([(i, [i + 0.25]) for i in range(1200)], "k int, centre array<double>")
    out = assign_to_nearest(spark.read.parquet(f"{tmp_path}/points"), "v", centres, "k")
    plan = out._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert plan.count("Scan parquet") == 1 and "0.25" not in plan and "Join" not in plan
    assert found(out)[19] == (pytest.approx(0.25), 19)
