import random

import pytest
from pyspark.sql import functions as F

from millrace.plans import credit as C
from millrace.sources import write_text


def raw_line(cid, sex, education, marriage, age, delays, bills, payments, defaulted, limit=20000):
    return ",".join(map(str, [cid, limit, sex, education, marriage, age, *delays, *bills, *payments, defaulted]))


LINES = [
    raw_line(1, "M", 1, 1, 24, [2, -1, 0, 0, 0, 0], [600] * 6, [0] * 6, 1),
    raw_line(2, "F", 2, 2, 25, [-1, -1, -1, -1, -1, -1], [100, 200, 300, 400, 500, 600], [350] * 6, 0),
    raw_line(3, "2", 3, 3, 67, [3, 3, 3, 3, 3, 2], [0] * 6, [0] * 6, 1),
    raw_line(4, "1", 9, 1, 40, [0] * 6, [-50] * 6, [25] * 6, 0),
    "aaaaaaa" + ",x" * 24,
    "garbage" + ",x" * 24,
]


@pytest.fixture
def raw(spark, rows, tmp_path):
    path = str(tmp_path / "raw")
    write_text(rows([(",".join(C.RAW_COLUMNS),), *[(line,) for line in LINES]], "value string").coalesce(1), path)
    return C.read_raw(spark, path)


def test_garbage_is_dropped_and_codes_are_numbers(raw, values):
    assert values(C.clean(raw), "CUSTID", "SEX") == [(1.0, 1.0), (2.0, 2.0), (3.0, 2.0), (4.0, 1.0)]


def test_unknown_sex_codes_are_null_or_the_given_one(raw, values):
    odd = raw.withColumn("SEX", F.lit("?"))
    assert {s for (s,) in values(C.clean(odd), "SEX")} == {None}
    assert {s for (s,) in values(C.clean(odd, unknown_sex=2.0), "SEX")} == {2.0}


def test_features(raw):
    result = {int(r.CustId): r for r in C.features(C.clean(raw)).collect()}
    picked = {k: (r.Age, r.AvgPayDur, r.AvgBillAmt, r.AvgPayAmt, r.PerPaid) for k, r in result.items()}
    assert picked == {
        1: (20.0, 1.0, 600.0, 0.0, 0.0),  # 3 / 6 = 0.5 is rounded up
        2: (30.0, 1.0, 350.0, 350.0, 100.0),
        3: (70.0, 3.0, 0.0, 0.0, 0.0),
        4: (40.0, 0.0, 50.0, 25.0, 50.0),
    }
    assert C.features(C.clean(raw)).columns == C.FEATURE_COLUMNS


def test_whole_number_variant(raw):
    result = {r.CUSTID: r for r in C.whole_number_features(C.clean(raw)).collect()}
    picked = {k: (r.AGE, r.AVG_DELAY, r.AVG_BILL, r.AVG_PAYMENT, r.PER_PAID) for k, r in result.items()}
    assert picked == {
        1: (20, 0, 600, 0, 0),
        2: (30, 1, 300, 350, 100),
        3: (70, 3, 0, 0, 100),
        4: (40, 0, 50, 25, 0),
    }


def test_unknown_codes_drop_rows_unless_kept(raw, values):
    rows = C.features(C.clean(raw))
    named = C.with_names(rows)
    assert values(named, "CustId", "sexName", "eduName", "marriageName") == [
        (1.0, "Male", "Graduate", "Single"),
        (2.0, "Female", "University", "Married"),
        (3.0, "Female", "High School", "Others"),
    ]
    assert C.with_names(rows, "left").where(F.col("eduName").isNull()).count() == 1
    assert not {"sexId", "eduId", "marriageId"} & set(named.columns)


def test_rates(raw, values):
    named = C.with_names(C.features(C.clean(raw)))
    assert values(C.default_rates(named, "sexName")) == [("Female", 2, 1, 50.0), ("Male", 1, 1, 100.0)]
    assert values(C.default_rates(named, "AvgPayDur")) == [(1.0, 2, 1, 50.0), (3.0, 1, 1, 100.0)]


@pytest.fixture
def people(rows):
    """Customers whose default follows their payment delay."""
    rnd = random.Random(9)
    data = []
    for cid in range(1, 241):
        late = rnd.random() < 0.4
        group = cid % 4
        data.append(
            (float(cid), 1000.0, 1.0 + group % 2, 1.0 + group, 1.0 + group % 3, 30.0 + 10 * group, 3.0 * late, 10.0, 5.0,
             50.0, 1.0 * late)
        )
    return rows(data, ", ".join(f"{c} double" for c in C.FEATURE_COLUMNS))


def test_correlations(people):
    report = {r["name"]: r["correlation"] for r in C.default_correlations(people).collect()}
    assert report["Defaulted"] == pytest.approx(1) and report["AvgPayDur"] == pytest.approx(1)
    assert abs(report["Sex"]) < 0.3
    assert report["AvgBillAmt"] is None  # never varies


def test_models_beat_the_majority(people):
    result = {r.model: r.accuracy for r in C.compare_models(people).collect()}
    assert result["decision_tree"] == 1.0 and result["random_forest"] > 0.9 and 0 <= result["naive_bayes"] <= 1


def test_groups(people):
    groups = C.customer_groups(people)
    assert sorted(r["count"] for r in groups.groupBy("prediction").count().collect()) == [60, 60, 60, 60]
