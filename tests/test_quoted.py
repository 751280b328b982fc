"""Delimited files with line breaks in quoted cells, in byte ranges of any length."""

import csv
import random

import duckdb
import pytest
from millrace.sources.quoted import read_quoted

SCHEMA = "id bigint, text string, n double"


def made(path, seed, n=120, end="\r\n"):
    r = random.Random(seed)
    pieces = ["a", "é", "日本", "\n", "\r\n", '"', '""', ",", ";", " ", "\n\n", 'x"y', "long " * 9]
    rows = [(i, "".join(r.choices(pieces, k=r.randint(0, 12))), r.choice(["", "1.5", "-2", "1e3"])) for i in range(n)]
    with open(path, "w", newline="", encoding="utf-8") as file:
        writer = csv.writer(file, lineterminator=end, quoting=csv.QUOTE_NONNUMERIC)
        writer.writerow(["id", "text", "n"])
        for i, text, x in rows:
            file.write(f'{i},"{text.replace(chr(34), chr(34) * 2)}",{x}{end}')
    return [(i, text, float(x) if x else None) for i, text, x in rows]


@pytest.mark.parametrize("range_bytes", [1 << 20, 4000, 700, 64, 7])
def test_ranges_of_any_length(spark, tmp_path, range_bytes):
    want = made(tmp_path / "a.csv", 1, 60 if range_bytes < 64 else 120)
    got = read_quoted(spark, str(tmp_path / "a.csv"), SCHEMA, range_bytes=range_bytes).collect()
    assert sorted(tuple(r) for r in got) == want


def test_equals_duckdb_in_one_and_eight_splits(spark, tmp_path):
    path = tmp_path / "in" / "a.csv"
    path.parent.mkdir()
    made(path, 2, 400, "\n")
    cells = "{'id': 'BIGINT', 'text': 'VARCHAR', 'n': 'DOUBLE'}"
    duck = duckdb.sql(f"SELECT * FROM read_csv('{path}', header = true, quote = '\"', escape = '\"', delim = ',', columns = {cells}, allow_quoted_nulls = false, parallel = false) ORDER BY id").fetchall()
    size = path.stat().st_size
    for splits in (1, 8):
        df = read_quoted(spark, str(path.parent), SCHEMA, range_bytes=-(-size // splits))
        assert df.rdd.getNumPartitions() == splits
        assert sorted(tuple(r) for r in df.collect()) == duck


def test_several_files_headers_and_separators(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text('1;"x;\ny"\n2;z')
    (folder / "b.csv").write_text("")
    (folder / "_c.csv").write_text("9;no\n")
    (folder / "d.csv").write_text('bad;""\n;\n')
    got = read_quoted(spark, str(folder), "k int, v string", header=False, sep=";", range_bytes=3).collect()
    assert sorted((tuple(r) for r in got), key=repr) == sorted([(1, "x;\ny"), (2, "z"), (None, ""), (None, None)], key=repr)
    (folder / "e.csv").write_text("k;w\n1;2\n")
    with pytest.raises(Exception, match="the header names"):
        read_quoted(spark, str(folder / "e.csv"), "k int, v string", sep=";").collect()
    (tmp_path / "empty").mkdir()
    assert read_quoted(spark, str(tmp_path / "empty"), SCHEMA).count() == 0
    with pytest.raises(Exception, match="nothing"):
        read_quoted(spark, str(tmp_path / "nothing"), SCHEMA)


def test_wrong_number_of_cells_is_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,text,n\n1,a\n")
    with pytest.raises(Exception, match="records from byte"):
        read_quoted(spark, str(tmp_path / "a.csv"), SCHEMA).collect()
