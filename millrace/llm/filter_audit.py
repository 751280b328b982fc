"""How filters interact: what every order of five filters keeps and removes, and at which step.

Each document becomes a 32-bit word, the truth table of its survival: bit ``s`` is set if the document passes all
filters of the subset ``s``. Adding up the words bit by bit gives the survivors of every subset at once. Carry-save
adders do that in tasks: three words of one weight become one of the same weight and one of twice the weight, until
a few words of each weight are left to be counted. All orders, steps and Shapley values follow from those 32 sums
of a part, so no document is looked at once for each order.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import permutations
from math import factorial
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from millrace.operators.joins import salted_join
from millrace.workspace import materialize

FILTERS = "ABCDE"
SUBSETS = 1 << len(FILTERS)
EVERY = SUBSETS - 1
LEAST_WORDS = 200
MARKS = b"#$%&*|"
KINDS = ("all", "good", "toxic")
# rows of one digest that a task of the join takes
ROWS_PER_TASK = 100_000
# parts that a task adds up before it hands them on
_HELD_PARTS = 4096

_NOT_CAPITALS = bytes(b for b in range(256) if not ord("A") <= b <= ord("Z"))
_NOT_MARKS = bytes(b for b in range(256) if b not in MARKS)


def text_failures(text: Column) -> Column:
    """Which of the filters A to D a text fails, as bits: too few words, repeated words, capitals, marks."""

    @F.pandas_udf("int")
    def failures(texts):
        return texts.map(_failures)

    return failures(F.coalesce(text, F.lit("")))


def _failures(text: str) -> int:
    data = text.encode()
    words = data.split()  # at the same bytes as [\x20\x09-\x0D]
    return (
        (len(words) < LEAST_WORDS)
        + 2 * (100 * len(set(words)) < 50 * len(words))
        + 4 * (100 * len(data.translate(None, _NOT_CAPITALS)) > 3 * len(text))
        + 8 * bool(data.translate(None, _NOT_MARKS))
    )


def survival_word(fails: Column) -> Column:
    """The truth table of a document that fails the filters in ``fails`` (bits): the subsets that keep it."""
    word = F.lit((1 << SUBSETS) - 1).cast("bigint")
    for i in range(len(FILTERS)):
        without = sum(1 << s for s in range(SUBSETS) if not s >> i & 1)
        word = word.bitwiseAND(F.when(fails.bitwiseAND(F.lit(1 << i)) > 0, F.lit(without).cast("bigint")).otherwise(F.lit((1 << SUBSETS) - 1).cast("bigint")))
    return word


def positional_counts(words: np.ndarray) -> np.ndarray:
    """How many of the 32-bit words have each bit set."""
    counts, weight = np.zeros(SUBSETS, np.int64), 1
    while len(words):
        carries = []
        while len(words) > 2:
            third = len(words) // 3
            a, b, c = words[:third], words[third : 2 * third], words[2 * third : 3 * third]
            either = a ^ b
            carries.append((a & b) | (c & either))
            words = np.concatenate([either ^ c, words[3 * third :]])
        counts += weight * (words[:, None] >> np.arange(SUBSETS, dtype=np.uint32) & 1).sum(axis=0, dtype=np.int64)
        words, weight = np.concatenate(carries) if carries else words[:0], 2 * weight
    return counts


def subset_survivors(words: DataFrame) -> DataFrame:
    """One row per ``part``: for each of ``all``, ``good`` and ``toxic`` documents the survivors of the 32 subsets.

    ``words`` has ``part``, ``word`` and the booleans ``good`` and ``toxic``. Each task sends one row for each part it
    has met (a task with very many parts several), whatever the number of documents.
    """

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            coded = batch.column("part").dictionary_encode()
            code = coded.indices.to_numpy(zero_copy_only=False)
            order = np.argsort(code, kind="stable")
            word = batch.column("word").to_numpy(zero_copy_only=False).astype(np.uint32)[order]
            flags = [batch.column(c).to_numpy(zero_copy_only=False).astype(bool)[order] for c in KINDS[1:]]
            ends = np.cumsum(np.bincount(code, minlength=len(coded.dictionary)))
            for part, lo, hi in zip(coded.dictionary.to_pylist(), np.r_[0, ends], ends):
                mine = word[lo:hi]
                found = np.stack([positional_counts(mine), *(positional_counts(mine[f[lo:hi]]) for f in flags)])
                held[part] = held[part] + found if part in held else found
            if len(held) > _HELD_PARTS:
                yield sums(held)
                held = {}
        if held:
            yield sums(held)

    def sums(held: dict[str, np.ndarray]) -> pa.RecordBatch:
        lists = [pa.array([list(x[k]) for x in held.values()], pa.list_(pa.int64())) for k in range(len(KINDS))]
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), *lists], names=["part", *KINDS])

    partial = words.select("part", "word", *KINDS[1:]).mapInArrow(add_up, "part string, " + ", ".join(f"{k} array<bigint>" for k in KINDS))
    totals = [F.array(*[F.sum(F.get(k, F.lit(s))) for s in range(SUBSETS)]).alias(k) for k in KINDS]
    return partial.groupBy("part").agg(*totals)


def order_report(survivors: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, from the survivors of the subsets."""

    def bits(letters: Column) -> Column:
        return reduce(add, [F.when(F.contains(letters, F.lit(x)), 1 << i).otherwise(0) for i, x in enumerate(FILTERS)])

    def removed(kind: str, before: Column, bit: Column) -> Column:
        return F.get(kind, before) - F.get(kind, before + bit)

    def shapley(i: int) -> Column:
        """So many orders put exactly the filters of a subset before this one."""
        terms = []
        for s in (s for s in range(SUBSETS) if not s >> i & 1):
            orders = factorial(s.bit_count()) * factorial(len(FILTERS) - 1 - s.bit_count())
            terms.append(orders * removed("all", F.lit(s), F.lit(1 << i)))
        return reduce(add, terms)

    orders = F.array(*[F.lit("".join(p)) for p in permutations(FILTERS)])
    rows = (
        survivors.withColumn("shapleys", F.array(*[shapley(i) for i in range(len(FILTERS))]))
        .withColumn("filter_order", F.explode(orders))
        .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
        .withColumn("letter", F.substring("filter_order", F.col("step"), F.lit(1)))
        .withColumn("bit", bits(F.col("letter")))
        .withColumn("before", bits(F.substring("filter_order", F.lit(1), F.col("step") - 1)))
    )
    bit, before = F.col("bit"), F.col("before")
    return rows.select(
        "part",
        "filter_order",
        "step",
        F.get("all", before + bit).alias("kept"),
        removed("all", before, bit).alias("removed"),
        (removed("all", F.lit(0), bit) - removed("all", before, bit)).alias("redundant"),
        removed("all", EVERY - bit, bit).alias("unique_fails"),
        removed("good", before, bit).alias("good_lost"),
        removed("toxic", before, bit).alias("toxic_lost"),
        F.get("shapleys", F.instr(F.lit(FILTERS), F.col("letter")) - 1).alias("shapley"),
    )


def words_of(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, part_col: str) -> DataFrame:
    """``doc_id``, ``part``, ``word``, ``good`` and ``toxic`` of every row of ``docs``.

    Defined results: a null text is empty, a null part the empty string. A row fails E if any row with a smaller id has
    the same text, whatever other filters say; equal ids are not smaller, and a null id counts as larger than all others
    and has no labels. Rows that repeat an id are documents of their own. Of several labels of an id, one that says
    1 is enough. Texts are compared by their SHA-256.
    """
    text = F.coalesce(docs[text_col], F.lit(""))
    rows = docs.select(
        docs[id_col].cast("bigint").alias("doc_id"),
        F.coalesce(docs[part_col].cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
        text_failures(text).alias("fails"),
    )
    facts = materialize(rows, "filter-audit")
    firsts = facts.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    marked = salted_join(
        facts, firsts.drop("n"), "digest", ["doc_id"], "left", key_counts=firsts.select("digest", "n"), rows_per_task=ROWS_PER_TASK
    )
    copy = F.coalesce((F.col("first") < F.col("doc_id")) | (F.col("doc_id").isNull() & F.col("first").isNotNull()), F.lit(False))
    marked = marked.withColumn("fails", F.col("fails") + F.when(copy, 16).otherwise(0))
    said = labels.groupBy(F.col("doc_id").cast("bigint").alias("labelled")).agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")
    )
    named = marked.join(said, marked["doc_id"] == said["labelled"], "left")
    return named.select(
        "doc_id",
        "part",
        survival_word(F.col("fails")).alias("word"),
        *[F.coalesce(k, F.lit(False)).alias(k) for k in KINDS[1:]],
    )


def audit(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, part_col: str) -> DataFrame:
    """The report of all 120 orders for each part; an empty table gives an empty report. See ``words_of``."""
    return order_report(subset_survivors(words_of(docs, labels, id_col, text_col, part_col)))


def audit_sql() -> str:
    """The report in DuckDB over ``documents`` and ``labels``, each order and step counted by itself."""
    return r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT doc_id, part, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words,
         min(doc_id) OVER (PARTITION BY t) < doc_id AS e
  FROM d
), l AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id
), f AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         (CASE WHEN len(words) < 200 THEN 'A' ELSE '' END)
      || (CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END)
      || (CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) THEN 'C' ELSE '' END)
      || (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END)
      || (CASE WHEN e THEN 'E' ELSE '' END) AS fails
  FROM w LEFT JOIN l USING (doc_id)
), g AS (
  SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, fails
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), steps AS (
  SELECT filter_order, step, substr(filter_order, step, 1) AS letter, substr(filter_order, 1, step - 1) AS before
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)
), counted AS (
  SELECT part, filter_order, step, letter,
         contains(fails, letter) AS failing,
         fails <> '' AND translate(fails, before, '') <> fails AS gone_before,
         fails = letter AS alone, n, good, toxic
  FROM g, steps
), report AS (
  SELECT part, filter_order, step, letter,
         sum(CASE WHEN NOT gone_before AND NOT failing THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN NOT gone_before AND failing THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN gone_before AND failing THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN alone THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN NOT gone_before AND failing THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN NOT gone_before AND failing THEN toxic ELSE 0 END) AS toxic_lost
  FROM counted GROUP BY ALL
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM report
"""
