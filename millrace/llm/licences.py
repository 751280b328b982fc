"""Licence scans: canonical digest lookup.

Texts are brought to a canonical form (lower case, no punctuation, no copyright lines, one spelling for
equivalent ones) and hashed; digests are joined with those of known licences. A document can be a licence
as a whole, or hold one as a line of its own. All of it is DataFrame operations; texts are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.llm.licence_texts import LICENCES
from millrace.sources import inline_table

# Spellings that licence matching takes as equivalent; words are delimited by single spaces.
EQUIVALENT = [
    ("licence", "license"),
    ("sub license", "sublicense"),
    ("non commercial", "noncommercial"),
    ("non infringement", "noninfringement"),
    ("acknowledgment", "acknowledgement"),
    ("per cent", "percent"),
    ("copyright owner", "copyright holder"),
    ("favour", "favor"),
    ("organisation", "organization"),
    ("judgement", "judgment"),
    ("fulfil ", "fulfill "),
    ("wilful ", "willful "),
    ("https", "http"),
]
_NO_WORD = r"[^\p{L}\p{N}\n]+"
# a copyright line names a year or the sign, or says nothing else; prose on copyright goes on, and so does a bare holder
_COPYRIGHT_LINE = r"^(copyright( c)?( [0-9]{4}.*)?$|copyright c .*|c [0-9]{4}.*|(copyright .*)?all rights reserved$)"


def canonical_lines(text: Column) -> Column:
    """The canonical form of each line that is neither empty nor a copyright line, in order."""
    plain = F.regexp_replace(F.lower(F.replace(text, F.lit("©"), F.lit(" c "))), _NO_WORD, " ")
    for given, taken in EQUIVALENT:
        plain = F.replace(plain, F.lit(given), F.lit(taken))
    lines = F.transform(F.split(plain, "\n"), lambda x: F.trim(x))
    return F.filter(lines, lambda x: (x != "") & ~x.rlike(_COPYRIGHT_LINE))


def digest(canonical: Column) -> Column:
    return F.sha2(canonical, 256)


def known_licences(spark: SparkSession, texts: Mapping[str, Iterable[str]] = LICENCES) -> DataFrame:
    """``licence`` and ``digest`` of known texts, one row for each canonical form."""
    rows = [(name, text) for name, forms in texts.items() for text in forms]
    given = inline_table(spark, rows, "licence string, text string")
    whole = F.array_join(canonical_lines(F.col("text")), " ")
    return given.select("licence", digest(whole).alias("digest")).groupBy("digest").agg(F.min("licence").alias("licence"))


def scan(docs: DataFrame, id_col: str, text_col: str, known: DataFrame) -> DataFrame:
    """Per document: ``doc_id``, ``whole_licence`` (null if the whole text is none), ``n_lines`` that are licence
    notices on their own, and ``licences``, all that were found, sorted and joined by commas (empty if none).

    ``known`` has ``licence`` and ``digest``. Its join carries no hint: Spark broadcasts a list whose estimated
    size is below its threshold, which that of ``known_licences`` is by far. Whole texts and single lines are looked up in one pass; only lookups that found something
    are gathered by document.

    Defined results: null and empty texts have no licence; rows with the same id are taken together, as one
    row; a null id is an id like any other; an empty table gives an empty result.
    """
    lines = canonical_lines(F.coalesce(F.col(text_col), F.lit("")))
    units = docs.select(F.col(id_col).alias("doc_id"), lines.alias("lines")).select(
        "doc_id",
        F.concat(
            F.array(F.struct(F.lit(True).alias("whole"), digest(F.array_join("lines", " ")).alias("digest"))),
            F.transform(
                F.when(F.size("lines") > 1, F.col("lines")).otherwise(F.array().cast("array<string>")),
                lambda x: F.struct(F.lit(False).alias("whole"), digest(x).alias("digest")),
            ),
        ).alias("units"),
    )
    found = units.select("doc_id", F.inline("units")).join(known, "digest")
    by_doc = found.groupBy("doc_id").agg(
        F.min(F.when(F.col("whole"), F.col("licence"))).alias("whole_licence"),
        F.count("*").alias("hits"),
        F.count_if("whole").alias("whole_hits"),
        F.array_join(F.array_sort(F.collect_set("licence")), ",").alias("licences"),
    )
    all_docs = docs.select(F.col(id_col).alias("doc_id")).distinct()
    hit = by_doc.withColumnRenamed("doc_id", "hit_id")
    joined = all_docs.join(hit, all_docs["doc_id"].eqNullSafe(hit["hit_id"]), "left")
    return joined.select(
        "doc_id",
        "whole_licence",
        F.coalesce(F.col("hits") - F.col("whole_hits"), F.lit(0)).cast("bigint").alias("n_lines"),
        F.coalesce("licences", F.lit("")).alias("licences"),
    )


def scan_sql(table: str = "documents") -> str:
    """The same for DuckDB, with the known forms as text."""
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    rows = ", ".join(f"({quoted(n)}, {quoted(t)})" for n, forms in LICENCES.items() for t in forms)

    def lines(column: str) -> str:
        plain = rf"regexp_replace(lower(replace({column}, '©', ' c ')), '[^\p{{L}}\p{{N}}\n]+', ' ', 'g')"
        for given, taken in EQUIVALENT:
            plain = f"replace({plain}, '{given}', '{taken}')"
        trimmed = f"list_transform(string_split({plain}, chr(10)), lambda x: trim(x, ' '))"
        return f"list_filter({trimmed}, lambda x: x <> '' AND NOT regexp_matches(x, '{_COPYRIGHT_LINE}'))"

    return f"""
    WITH given(licence, text) AS (VALUES {rows}),
    known AS (SELECT min(licence) AS licence, array_to_string({lines("text")}, ' ') AS form FROM given GROUP BY 2),
    split AS (SELECT doc_id, {lines("coalesce(text, '')")} AS lines FROM {table}),
    units AS (
        SELECT doc_id, true AS whole, array_to_string(lines, ' ') AS form FROM split
        UNION ALL
        SELECT doc_id, false, unnest(lines) FROM split WHERE len(lines) > 1
    ),
    hits AS (SELECT doc_id, whole, licence FROM units JOIN known USING (form))
    SELECT d.doc_id, min(licence) FILTER (whole) AS whole_licence,
        count(licence) FILTER (NOT whole) AS n_lines,
        coalesce(array_to_string(list_sort(list_distinct(list(licence) FILTER (licence IS NOT NULL))), ','), '') AS licences
    FROM (SELECT DISTINCT doc_id FROM {table}) d LEFT JOIN hits ON d.doc_id IS NOT DISTINCT FROM hits.doc_id
    GROUP BY d.doc_id
    """
