"""JSON lines with fields of varying types, against DuckDB's JSON functions."""

import json
import random

import duckdb
import pytest
from millrace.sources.varying import read_varying_json, typed_json, varying_fields

VALUES = [0, 7, -3, 2.5, 1e30, 12345678901, "text", "12", "é\n\"q\"", True, False, None, [], [1, "a", None], {"x": 1}, {}, ""]


@pytest.fixture
def lines(rows):
    return lambda *texts: rows([(t,) for t in texts], "value string").repartition(2)


def test_rows_of_mixed_types_equal_duckdb(lines):
    r = random.Random(1)
    given = [{"id": i, **({"v": r.choice(VALUES)} if r.random() < 0.9 else {})} for i in range(300)]
    texts = [json.dumps(x, ensure_ascii=False) for x in given]
    out = {x.id: x for x in typed_json(lines(*texts), "id bigint, v bigint").collect()}
    duck = duckdb.execute(
        """SELECT CAST(json_extract(t, '$.id') AS BIGINT),
                  CASE WHEN json_type(t, '$.v') IN ('BIGINT', 'UBIGINT') THEN CAST(json_extract(t, '$.v') AS BIGINT) END,
                  CASE WHEN json_type(t, '$.v') NOT IN ('BIGINT', 'UBIGINT', 'NULL') THEN json_extract(t, '$.v')::VARCHAR END
           FROM (SELECT unnest(?) AS t)""",
        [texts],
    ).fetchall()
    same = lambda a, b: (a is None) == (b is None) and (a is None or json.loads(a) == json.loads(b))
    assert len(out) == len(duck)
    for i, v, rest in duck:
        assert out[i].v == v and out[i].bad is None and same(out[i].rest.get("v"), rest)


@pytest.mark.parametrize(
    ("kind", "fitting"),
    [("string", {"text", "12", ""}), ("boolean", {True}), ("double", {7, 2.5}), ("int", {7}), ("array<string>", {"[]"}), ("tinyint", {7})],
)
def test_only_values_of_the_kind_fit(lines, kind, fitting):
    given = ["text", "12", "", True, 7, 2.5, [], {"x": 1}, None] if kind != "tinyint" else [7, 300]
    out = typed_json(lines(*[json.dumps({"v": v}) for v in given]), f"v {kind}").collect()
    got = [x.v for x in out if x.v is not None]
    if kind == "array<string>":
        assert got == [[]]
    else:
        assert sorted(map(repr, got)) == sorted(repr(float(v) if kind == "double" else v) for v in fitting)
    assert sum(len(x.rest) for x in out) == len([v for v in given if v is not None]) - len(got)


def test_undeclared_fields_and_bad_lines(lines):
    out = typed_json(lines('{"a": 1, "b": {"c": [1]}, "d": null}', "no json", "[1]", "", "3"), "a int, v variant").collect()
    found = {x.bad: (x.a, x.rest) for x in out}
    assert found == {None: (1, {"b": '{"c":[1]}', "d": "null"}), "no json": (None, {}), "[1]": (None, {}), "": (None, {}), "3": (None, {})}
    with pytest.raises(ValueError, match="other names"):
        typed_json(lines("{}"), "rest int")
    renamed = typed_json(lines('{"rest": 1, "x": 2}'), "rest int", rest="others", bad="broken").first()
    assert (renamed.rest, renamed.others, renamed.broken) == (1, {"x": "2"}, None)


def test_a_field_of_several_kinds_is_a_variant(spark, lines, tmp_path):
    texts = ['{"a": 1, "b": "x"}', '{"a": "one", "c": [1, 2]}', '{"b": null, "c": [3]}', "no json"]
    found = {f.name: f.dataType.simpleString() for f in varying_fields(lines(*texts)).fields}
    assert found == {"a": "variant", "b": "string", "c": "array<bigint>"}
    lines(*texts).write.text(str(tmp_path / "t"))
    out = read_varying_json(spark, str(tmp_path / "t")).selectExpr("to_json(a) AS a", "b", "c", "rest", "bad").collect()
    assert sorted(((x.a, x.b, x.c, x.bad) for x in out), key=repr) == sorted(
        [("1", "x", None, None), ('"one"', None, [1, 2], None), (None, None, [3], None), (None, None, None, "no json")], key=repr
    )
    assert all(x.rest == {} for x in out)
    assert varying_fields(lines("1", "x")).fields == []
