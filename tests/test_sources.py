import pytest
from pyspark.errors import AnalysisException
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from millrace import workspace
from millrace.sources import (
    inline_table,
    read_delimited,
    read_jdbc,
    read_json_lines,
    read_text,
    sql_over,
    write_delimited,
    write_json_lines,
    write_parquet,
    write_text,
)


def test_text_keeps_lines_and_refuses_to_replace(spark, rows, values, tmp_path):
    path = str(tmp_path / "text")
    lines = [("first",), ("",), ("naïve, line",)]
    write_text(rows(lines, "value string"), path)
    assert values(read_text(spark, path)) == sorted(lines)
    with pytest.raises(AnalysisException):
        write_text(rows(lines, "value string"), path)


@pytest.mark.parametrize("header, sep", [(True, ","), (False, ","), (True, ";")])
def test_delimited_round_trip(spark, rows, values, tmp_path, header, sep):
    schema = "id int, name string, amount double"
    data = [(1, "a, b; c", 1.5), (2, 'say "x"', -2.0), (3, None, None)]
    path = str(tmp_path / "csv")
    write_delimited(rows(data, schema), path, header=header, sep=sep)
    assert values(read_delimited(spark, path, schema, header=header, sep=sep)) == sorted(data, key=repr)


def test_delimited_cells_of_the_wrong_type_become_null(spark, rows, values, tmp_path):
    path = str(tmp_path / "csv")
    write_text(rows([("id,hp",), ("1,150",), ("2,?",)], "value string").coalesce(1), path)
    assert values(read_delimited(spark, path, "id int, hp int")) == [(1, 150), (2, None)]


def test_json_lines_are_typed(spark, rows, values, tmp_path):
    path = str(tmp_path / "json")
    write_json_lines(rows([("40", "Jo\n")], "age string, name string"), path)
    assert values(read_json_lines(spark, path, "age string, name string")) == [("40", "Jo\n")]


def test_parquet_partitions(spark, rows, values, tmp_path):
    path = str(tmp_path / "parquet")
    write_parquet(rows([(1, "a"), (2, "b")], "v int, k string"), path, partition_by=("k",))
    assert values(spark.read.parquet(path).where("k = 'b'"), "v") == [(2,)]


def test_inline_table_is_local_and_typed(spark, values):
    schema = StructType([StructField("id", IntegerType(), False), StructField("name", StringType(), False)])
    df = inline_table(spark, [(1, "USA"), (2, "India")], schema)
    assert df.dtypes == [("id", "int"), ("name", "string")]
    assert values(df) == [(1, "USA"), (2, "India")]
    assert inline_table(spark, [(1, "x")], "id double, name string").first()["id"] == 1.0
    assert inline_table(spark, [], "id int").count() == 0
    assert inline_table(spark, [(i,) for i in range(9)], "v int", partitions=3).rdd.getNumPartitions() == 3


def test_sql_over_leaves_no_view(spark, rows, values):
    people = rows([("a", 30), ("b", 50)], "name string, age int")
    assert values(sql_over(spark, "SELECT name FROM {p} WHERE age > 40", p=people)) == [("b",)]
    assert spark.catalog.listTables() == []


def test_jdbc_read_is_partitioned():
    class Reader:
        def jdbc(self, url, table, **options):
            return {"url": url, "table": table, **options}

    class Session:
        read = Reader()

    call = read_jdbc(Session(), "jdbc:x:y", "contact", column="id", lower=1, upper=100, partitions=4)
    assert call == {
        "url": "jdbc:x:y", "table": "contact", "column": "id", "lowerBound": 1, "upperBound": 100,
        "numPartitions": 4, "properties": {},
    }


def test_workspace_uses_the_named_folder_and_refuses_to_guess(spark, rows, values):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert workspace.new_folder(spark, "x").startswith(folder)
    saved = workspace.materialize(rows([(1, "a")], "id int, name string"), "saved")
    assert values(saved) == [(1, "a")]
    assert saved.inputFiles() and all(folder in f for f in saved.inputFiles())

    class Context:
        master, applicationId = "spark://somewhere:7077", "app"

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        workspace.shared_root(Session())


def test_delimited_text_of_any_kind_comes_back(spark, rows, values, tmp_path):
    texts = ["x\ny", "\r\n", "", None, "\\n", "\\", "\\N", 'a "q", b', " lead and trail ", "a\\\nb", "null", "z\0\\0"]
    data = [(i, t, float(i)) for i, t in enumerate(texts)]
    schema = "id int, t string, d double"
    path = str(tmp_path / "csv")
    write_delimited(rows(data, schema), path)
    assert values(read_delimited(spark, path, schema)) == sorted(data, key=repr)
    untyped = read_delimited(spark, path)
    assert untyped.dtypes == [("id", "string"), ("t", "string"), ("d", "string")]
    assert values(untyped, "t") == sorted(((t,) for t in texts), key=repr)


def test_a_reordered_header_is_refused(spark, rows, tmp_path):
    path = str(tmp_path / "csv")
    write_delimited(rows([(1, 2)], "a int, b int"), path)
    with pytest.raises(Exception, match="(?i)header"):
        read_delimited(spark, path, "b int, a int").collect()


def test_files_without_names_and_inferred_json(spark, rows, values, tmp_path):
    write_delimited(rows([("C:\\new", 1)], "a string, b int"), str(tmp_path / "csv"), header=False, escaped=False)
    df = read_delimited(spark, str(tmp_path / "csv"), header=False, escaped=False)
    assert df.columns == ["_c0", "_c1"] and values(df) == [("C:\\new", "1")]
    write_json_lines(rows([("40", 1.5)], "age string, x double"), str(tmp_path / "json"))
    assert read_json_lines(spark, str(tmp_path / "json")).dtypes == [("age", "string"), ("x", "double")]


def test_scratch_tables_can_be_removed(spark, rows, tmp_path, monkeypatch):
    monkeypatch.setattr(workspace, "_WRITTEN", [])
    monkeypatch.setattr(workspace, "shared_root", lambda _: str(tmp_path))
    kept = workspace.materialize(rows([(1,)], "v int"), "kept")
    workspace.new_folder(spark, "never-written")
    assert kept.count() == 1 and len(list((tmp_path / "millrace").iterdir())) == 1
    assert workspace.remove_scratch(spark) == 1
    assert not list((tmp_path / "millrace").iterdir()) and workspace.remove_scratch(spark) == 0
