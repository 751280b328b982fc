"""Every registered query over the smallest tables, against its SQL or a plain version; and the pipeline."""

import hashlib
import math
import re
from collections import Counter
from pathlib import Path

import brute
import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from millrace.llm import queries
from millrace.llm.queries import QUERIES, SQL

FOLDER = Path(entry.SMOKE_FOLDER)
tables = pytest.mark.skipif(not FOLDER.exists(), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in FOLDER.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    yield connection
    connection.close()


def comparable(rows, columns):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    cell = lambda v: (None if math.isnan(v) else round(v, 6)) if isinstance(v, float) else v
    return Counter(tuple(cell(row[i]) for i in order) for row in rows)


def test_registered():
    assert QUERIES.keys() | {"pipeline"} <= entry.queries().keys()
    assert SQL.keys() <= QUERIES.keys() and SQL.keys() <= entry.oracle_sql().keys()
    assert {int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES} == set(range(1, 14))


@tables
@pytest.mark.parametrize("key", sorted(SQL))
def test_against_sql(spark, duck, key):
    out = QUERIES[key](spark, str(FOLDER))
    cursor = duck.execute(SQL[key])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(out.columns)
    assert comparable([tuple(r) for r in out.collect()], out.columns) == comparable(cursor.fetchall(), columns)


@pytest.fixture(scope="module")
def documents(duck):
    return duck.execute("SELECT doc_id, text FROM documents").fetchall()


@tables
def test_fingerprints(spark, documents):
    out = {r.doc_id: r for r in QUERIES["op1_fingerprints"](spark, str(FOLDER)).collect()}
    rows = sorted(documents, reverse=True)
    for i, (doc_id, text) in enumerate(rows):
        half, after = len(text) // 2, rows[(i + 1) % len(rows)][1]
        edited = text[: len(text) - half] + after[:half]
        assert out[doc_id].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        a, b, c = (brute.shingles(t, 5) for t in (text, edited, after))
        assert abs(out[doc_id].near_edited - len(a & b) / max(1, len(a | b))) < 0.15
        assert abs(out[doc_id].near_next - len(a & c) / max(1, len(a | c))) < 0.15
    assert len(out) == len(rows)


@tables
def test_toxicity(spark, duck, documents):
    out = QUERIES["op2_toxicity"](spark, str(FOLDER)).collect()
    assert {r.doc_id: r.held_out for r in out} == {i: brute.held_out(i) for i, _ in documents}
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out)


@tables
def test_decontamination(spark, duck, documents):
    plain = lambda t: " ".join(re.findall(r"\w+", t.lower()))
    items = [(i, plain(t)) for i, t in duck.execute("SELECT item_id, text FROM benchmark").fetchall()]
    want = {(i, j) for i, t in documents for j, item in items if f" {item} " in f" {plain(t)} "}
    out = QUERIES["op3_decontamination"](spark, str(FOLDER)).collect()
    got = {(r.doc_id, r.item_id) for r in out}
    assert want and want <= got
    assert all(r.question_share >= 0.6 and r.answer_share >= 0.6 for r in out)


@tables
def test_suffixes(spark, documents):
    out = QUERIES["op9_suffix_dedup"](spark, str(FOLDER)).collect()
    want = {i: (*x[:3], brute.sha(x[3])) for i, x in brute.cut_bytes(documents).items()}
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out} == want


@tables
def test_pages(spark, duck):
    import html

    pages = duck.execute("SELECT page_id, url, html FROM pages").fetchall()
    out = {r.page_id: r for r in QUERIES["op8_html_text"](spark, str(FOLDER)).collect()}
    assert len(out) == len(pages)
    for page_id, url, page in pages:
        # all pages of the tables are of one form, with the whole text in the article
        body = re.search("<article>(.*)</article>", page, re.DOTALL)[1]
        want = " ".join(html.unescape(re.sub("<[^>]*>", " ", body)).split())
        assert (out[page_id].url, out[page_id].text, out[page_id].n_chars) == (url, want, len(want))


@tables
def test_alignment(spark, documents):
    files = queries.tokenizer_file("byte_bpe_50k.json"), queries.tokenizer_file("piece_bpe_32k.model")
    want = brute.aligned(documents, *files)
    out = QUERIES["op11_token_alignment"](spark, str(FOLDER)).collect()
    assert {r.doc_id: (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in out} == want


@tables
def test_bpe(spark, documents):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(queries.tokenizer_file("byte_bpe_50k.json"))
    out = {r.doc_id: r for r in QUERIES["op13_bpe"](spark, str(FOLDER)).collect()}
    assert len(out) == len(documents)
    for doc_id, text in documents:
        ids = library.encode(text or "", add_special_tokens=False).ids
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        decoded = library.decode(ids, skip_special_tokens=False).encode()
        assert (out[doc_id].n_tokens, out[doc_id].ids_sha256, out[doc_id].decoded_sha256) == (len(ids), brute.sha(packed), brute.sha(decoded))


# ---------------------------------------------------------------- the pipeline


def folder(spark, tmp_path, docs, labels=(), items=()):
    spark.createDataFrame(list(docs), "doc_id bigint, text string, lang string, source string, n_chars bigint, _tie string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(list(labels), "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(list(items), "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def test_stages_are_named_and_ordered():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "jaccard", "substrings", "benchmark", "mixing"]


def test_decisions_of_every_stage(spark, tmp_path):
    text = lambda name, n: " ".join(f"{name}{i}" for i in range(n))
    docs = [(i, f"{text(f'clean{i}x', 12)} {'scum idiot' if i < 15 else ''}", "en", "s", 1, "t") for i in range(60)]
    copy, passage, item = text("c", 60), text("p", 25), text("q", 20) + ". " + text("a", 8) + "."
    docs += [
        (100, copy, "en", "s", 5, None),
        (101, copy.replace("c30", "other"), "en", "s", 5, None),
        (102, copy, "en", "s", 5, None),
        (110, f"{text('d', 30)} {passage}", "en", "s", 5, None),
        (111, f"{passage} {text('e', 30)}", "en", "r", 5, None),
        (120, f"{text('f', 40)} {item} {text('g', 10)}", "en", "s", 5, None),
        (130, None, None, None, None, None),
        (131, "", "", "", 0, None),
        (None, text("h", 30), "en", "s", 5, None),
    ]
    labels = [(i, 1, int(i < 15)) for i in range(60)]
    path = folder(spark, tmp_path, docs, labels, [(1, item)])
    df = spark.read.parquet(f"{path}/documents.parquet")
    columns, seen = df.columns, []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        df = stage(spark, df, path)
        df.write.parquet(f"{tmp_path}/stage{i}")
        df = spark.read.parquet(f"{tmp_path}/stage{i}")
        if i < 4:
            assert df.columns == columns
        seen.append({r.doc_id: r for r in df.collect()})
    clean = set(range(15, 60))
    special = {100, 101, 102, 110, 111, 120, 130, 131, None}
    assert seen[0].keys() == clean | special
    assert seen[1].keys() == seen[0].keys() - {101, 102}
    assert seen[2].keys() == seen[1].keys()
    assert seen[2][111].text == text("e", 30) and seen[2][111].n_chars == len(text("e", 30))
    assert seen[2][110] == seen[1][110] and seen[2][130].text is None
    assert seen[3].keys() == seen[2].keys() - {120}
    assert seen[4].keys() <= seen[3].keys() and all(r.taken > 0 for r in seen[4].values())
    out = corpus_pipeline.run(spark, path)
    assert {tuple(r) for r in out.collect()} == {tuple(r) for r in seen[4].values()}


def test_empty_tables_and_repeated_rows(spark, tmp_path):
    assert corpus_pipeline.run(spark, folder(spark, tmp_path / "a", [])).count() == 0
    rows = [(1, "a b c", "en", "s", 5, None)] * 3 + [(2, "a b c", "en", "s", 5, None), (1, "x y z", "en", "s", 5, None)]
    out = corpus_pipeline.run(spark, folder(spark, tmp_path / "b", rows)).collect()
    assert sorted((r.doc_id, r.size) for r in out) == [(1, 3), (1, 3)]


def test_the_rest_does_not_need_this_package():
    import subprocess
    import sys

    root = Path(entry.__file__).parent
    code = """
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name in ("millrace.llm", "corpus_pipeline"):
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as e
names = e.queries()
assert "rate_report" in names and not any(n.startswith("op") or n == "pipeline" for n in names), names
assert e.oracle_sql().keys() <= names.keys()
"""
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True)
    for file in (root / "millrace").rglob("*.py"):
        if "llm" not in file.parts:
            assert "millrace.llm" not in file.read_text()
