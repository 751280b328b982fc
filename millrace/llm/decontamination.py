"""Benchmark decontamination: BM25 inverted index of test items with block-max WAND.

Test items are indexed; every passage of every training text is a query. Item scores are BM25 divided by
the score that the whole item would get, so 1 means that all its terms are there, and one threshold suits
all items. Postings are in blocks of item numbers with the largest score of each block.

1. For all passages of a batch at once, a bound for each block is added up from the block maxima of rare
   terms and the most that the common terms of an item can add. Most passages end here.
2. A passage with a block that reaches the threshold runs block-max WAND: cursors move to the first
   item whose list maxima reach the threshold, blocks whose maxima do not are skipped, and all items at
   or above the threshold are retrieved.
3. A retrieved item is verified: the shares of word triples of its question and of its answer that the
   passage has. The last sentence of an item counts as its answer, what precedes it as the question.

Passages overlap by half and are twice as long as the longest item, so that any item that a text repeats lies
within one passage. The index is built for so many items at a time that it stays below a bound in bytes;
a larger benchmark takes several passes over the documents. Item count, mean length, document frequencies and the
longest item are those of the whole benchmark in each.

Defined results: null and empty texts have no passages, items without words are never found. Repeated
item ids are indexed each, and reported once with their best hit. Rows that repeat a document id count as
one document. Null ids are ids like others.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructField, StructType

from millrace.llm.words import IS_MARK, folded, slices, word_hashes

K1, B = 1.2, 0.75
THRESHOLD = 0.6
OVERLAP = 0.6
BLOCK_ITEMS = 8
# the common terms of an item may add so much to its score at most
COMMON_SHARE = 0.25
INDEX_BYTES = 8 * 1024 * 1024
GRAM = 3

_SENTENCE_END = re.compile(r"(?<=[.!?])\s+")


def words_of(text: str | None) -> list[int]:
    return word_hashes(folded(pa.array([text], pa.large_string())), between=IS_MARK)[0].tolist()


def question_and_answer(text: str) -> tuple[str, str]:
    """The last sentence with a word is the answer; an item of one sentence is cut in two halves."""
    parts = [p for p in _SENTENCE_END.split(text.strip()) if words_of(p)]
    if len(parts) > 1:
        return " ".join(parts[:-1]), parts[-1]
    words = text.split()
    half = (len(words) + 1) // 2
    return " ".join(words[:half]), " ".join(words[half:])


def grams(words: list[int]) -> set[tuple[int, ...]]:
    """Triples of words; of fewer words, all of them together."""
    if not words:
        return set()
    return {tuple(words[i : i + GRAM]) for i in range(max(1, len(words) - GRAM + 1))}


def share_in(part: set, passage: set, passage_words: set) -> float:
    """The share of a part's triples that a passage has; of a part of fewer words, whether it has them."""
    if not part:
        return 1.0
    if any(len(g) < GRAM for g in part):
        return float(all(w in passage_words for g in part for w in g))
    return len(part & passage) / len(part)


@dataclass
class Index:
    """Items by number, and for each term its postings (items ascending, scores) with block maxima."""

    ids: list
    parts: list[tuple[set, set]]
    longest: int
    postings: dict[int, tuple[list[int], list[float], float, dict[int, float]]]
    # rare terms, ascending, as rows of (term, block, block maximum)
    rare: np.ndarray
    rare_first: np.ndarray
    rare_block: np.ndarray
    rare_score: np.ndarray
    # the most that common terms add in each block
    common: np.ndarray

    @property
    def blocks(self) -> int:
        return len(self.common)


def build(items: list[tuple], statistics: tuple[int, float, dict[int, int]] | None = None, longest: int = 0) -> Index:
    """An index of (id, text) pairs. ``statistics`` are item count, mean length and document frequencies over all items.

    ``longest`` is the number of words of the longest item of all, if that may not be among ``items``.
    """
    kept = [(i, t, w) for i, t in items if (w := words_of(t))]
    n, mean, df = statistics or corpus_statistics(t for _, t in items)
    postings: dict[int, tuple[list, list]] = defaultdict(lambda: ([], []))
    common = np.zeros(-(-len(kept) // BLOCK_ITEMS))
    rare: dict[tuple[int, int], float] = {}
    parts = []
    for number, (_, text, words) in enumerate(kept):
        length = 1 - B + B * len(words) / mean
        scores = {
            t: math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * tf * (K1 + 1) / (tf + K1 * length)
            for t, tf in Counter(words).items()
        }
        whole = sum(scores.values())
        added, block = 0.0, number // BLOCK_ITEMS
        # the most common terms first; what they add together stays below the share
        for t in sorted(scores, key=lambda t: (-df[t], t)):
            score = scores[t] / whole
            postings[t][0].append(number)
            postings[t][1].append(score)
            if added + score <= COMMON_SHARE and (block, t) not in rare:
                added += score
            else:
                rare[block, t] = max(rare.get((block, t), 0.0), score)
        common[block] = max(common[block], added)
        question, answer = question_and_answer(text)
        parts.append((grams(words_of(question)), grams(words_of(answer))))
    full = {}
    for t, (numbers, scores) in postings.items():
        best: dict[int, float] = {}
        for number, score in zip(numbers, scores, strict=True):
            best[number // BLOCK_ITEMS] = max(best.get(number // BLOCK_ITEMS, 0.0), score)
        full[t] = (numbers, scores, max(scores), best)
    # a term that is rare for one item of a block counts with its maximum over the block
    cells = sorted((t, block, full[t][3][block]) for block, t in rare)
    terms = np.array([c[0] for c in cells], np.uint64)
    new = np.flatnonzero(np.concatenate([[True], terms[1:] != terms[:-1]])) if len(terms) else np.zeros(0, np.int64)
    return Index(
        [i for i, _, _ in kept],
        parts,
        longest or max((len(w) for _, _, w in kept), default=0),
        full,
        terms[new],
        np.append(new, len(terms)),
        np.array([c[1] for c in cells], np.int64),
        np.array([c[2] for c in cells]),
        common,
    )


def corpus_statistics(texts) -> tuple[int, float, dict[int, int]]:
    n = total = 0
    df: Counter = Counter()
    for text in texts:
        words = words_of(text)
        if words:
            n, total = n + 1, total + len(words)
            df.update(set(words))
    return n, total / max(n, 1), dict(df)


def block_bounds(index: Index, words: np.ndarray, passage: np.ndarray, passages: int) -> np.ndarray:
    """For each passage and block an upper bound of the score of any item in the block.

    ``words`` are the words of all passages and ``passage`` the passage each is in. A repeated word counts
    again, which only loosens the bound.
    """
    bounds = np.tile(index.common, (passages, 1))
    if not len(index.rare) or not len(words):
        return bounds
    at = np.minimum(np.searchsorted(index.rare, words), len(index.rare) - 1)
    hit = np.flatnonzero(index.rare[at] == words)
    first, many = index.rare_first[at[hit]], np.diff(index.rare_first)[at[hit]]
    cell = np.repeat(first - np.cumsum(many) + many, many) + np.arange(many.sum())
    place = np.repeat(passage[hit], many) * index.blocks + index.rare_block[cell]
    return bounds + np.bincount(place, weights=index.rare_score[cell], minlength=bounds.size).reshape(bounds.shape)


def block_max_wand(index: Index, terms: list[int], threshold: float) -> list[tuple[int, float]]:
    """All items with a score of at least ``threshold`` for the distinct ``terms``, as (number, score)."""
    lists = [index.postings[t] for t in terms if t in index.postings]
    # [item, list, place]
    cursors = sorted([numbers[0], i, 0] for i, (numbers, _, _, _) in enumerate(lists))
    end = len(index.ids)
    slack = threshold - 1e-9
    found = []

    def advance(cursor: list, item: int) -> None:
        numbers = lists[cursor[1]][0]
        cursor[2] = bisect_left(numbers, item, cursor[2])
        cursor[0] = numbers[cursor[2]] if cursor[2] < len(numbers) else end

    while True:
        bound, pivot = 0.0, -1
        for i, cursor in enumerate(cursors):
            if cursor[0] == end:
                break
            bound += lists[cursor[1]][2]
            if bound >= slack:
                pivot = i
                break
        if pivot < 0:
            return found
        item = cursors[pivot][0]
        while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
            pivot += 1
        block = item // BLOCK_ITEMS
        block_bound = sum(lists[c[1]][3].get(block, 0.0) for c in cursors[: pivot + 1])
        if block_bound < slack:
            # no item of the block reaches the threshold with these lists, so go on behind it or to the next list
            target = (block + 1) * BLOCK_ITEMS
            if pivot + 1 < len(cursors):
                target = min(target, cursors[pivot + 1][0])
            for cursor in cursors[: pivot + 1]:
                advance(cursor, max(target, item + 1))
        elif cursors[0][0] == item:
            score = sum(lists[c[1]][1][c[2]] for c in cursors[: pivot + 1])
            if score >= slack:
                found.append((item, score))
            for cursor in cursors[: pivot + 1]:
                advance(cursor, item + 1)
        else:
            for cursor in cursors[: pivot + 1]:
                advance(cursor, item)
        cursors.sort(key=lambda c: c[0])


def passages_of(first: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, first and last word of overlapping passages: twice the longest item long, one item apart."""
    counts = np.diff(first)
    many = np.where(counts > 0, np.maximum(1, -(-(counts - longest) // longest)), 0)
    text = np.repeat(np.arange(len(counts)), many)
    place = np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many)
    begin = first[text] + place * longest
    return text, begin, np.minimum(begin + 2 * longest, first[text + 1])


def hits_of(texts: pa.Array, index: Index, threshold: float, overlap: float) -> list[tuple[int, int, float, float, float, int]]:
    """Text number, item number, score, question and answer shares, and first word of the passage of each hit."""
    if not index.ids:
        return []
    words, first = word_hashes(folded(texts), between=IS_MARK)
    text, begin, end = passages_of(first, index.longest)
    size = end - begin
    at = np.repeat(begin - np.cumsum(size) + size, size) + np.arange(size.sum())
    bounds = block_bounds(index, words[at], np.repeat(np.arange(len(text)), size), len(text))
    out = []
    for p in np.flatnonzero((bounds >= threshold - 1e-9).any(axis=1)).tolist():
        own = words[begin[p] : end[p]].tolist()
        seen, own_grams = set(own), None
        for number, score in block_max_wand(index, sorted(seen), threshold):
            own_grams = grams(own) if own_grams is None else own_grams
            question, answer = (share_in(part, own_grams, seen) for part in index.parts[number])
            if question >= overlap and answer >= overlap:
                out.append((int(text[p]), number, score, question, answer, int(begin[p] - first[text[p]])))
    return out


def benchmark_statistics(items: DataFrame, text_col: str) -> tuple[tuple[int, float, dict[int, int]], int]:
    """``corpus_statistics`` and the length of the longest item, over the whole benchmark."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            for lo, hi in slices(texts):
                words, first = word_hashes(folded(texts.slice(lo, hi - lo)), between=IS_MARK)
                length = np.diff(first)
                text = np.repeat(np.arange(len(length)), length)
                order = np.lexsort((words, text))
                words, text = words[order], text[order]
                new = np.ones(len(words), dtype=bool)
                new[1:] = (words[1:] != words[:-1]) | (text[1:] != text[:-1])
                terms, many = np.unique(words[new], return_counts=True)
                # the row without a term is of the items themselves
                columns = {
                    "term": pa.array([None, *terms.view(np.int64).tolist()], pa.int64()),
                    "n": np.append([(length > 0).sum()], many).astype(np.int64),
                    "total": np.append([length.sum()], np.zeros(len(terms))).astype(np.int64),
                    "longest": np.append([length.max(initial=0)], np.zeros(len(terms))).astype(np.int64),
                }
                yield pa.RecordBatch.from_pydict(columns)

    given = items.select(F.coalesce(text_col, F.lit("")).alias("text"))
    rows = given.mapInArrow(count, "term bigint, n bigint, total bigint, longest bigint").groupBy("term")
    found = rows.agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.max("longest").alias("longest")).toArrow()
    n = total = longest = 0
    df = {}
    for term, many, words, most in zip(*(found.column(i).to_pylist() for i in range(4)), strict=True):
        if term is None:
            n, total, longest = many, words, most
        else:
            df[term % (1 << 64)] = many
    return (n, total / max(n, 1), df), longest


def item_shards(items: DataFrame, id_col: str, text_col: str, most_bytes: int) -> Iterator[list[tuple]]:
    """All items in lists of about ``most_bytes`` of text at most, in a repeatable deal."""
    given = items.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    total = given.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = -(-total // most_bytes)
    for shard in range(shards):
        part = given.where(F.pmod(F.xxhash64("id", "text"), F.lit(shards)) == shard)
        yield sorted(((r["id"], r["text"]) for r in part.collect()), key=lambda x: (x[0] is None, x[0], x[1]))


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    id_col: str,
    text_col: str,
    item_id_col: str,
    item_text_col: str,
    *,
    threshold: float = THRESHOLD,
    overlap: float = OVERLAP,
    index_bytes: int = INDEX_BYTES,
) -> DataFrame:
    """``doc_id``, ``item_id``, ``score``, ``question_share``, ``answer_share``, ``first_word``, ``n_passages`` of all verified hits.

    Shares and score are the best over the document's passages, ``first_word`` is the start of the first of them.
    BM25 counts terms and lengths over all items, and passages are as long as the longest of all asks, so the number of
    indexes changes nothing.
    """
    given = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kinds = [docs.schema[id_col].dataType, items.schema[item_id_col].dataType]
    found_schema = StructType([StructField("doc_id", kinds[0]), StructField("item_id", kinds[1])])
    for name, kind in (("score", "double"), ("question_share", "double"), ("answer_share", "double"), ("first_word", "long")):
        found_schema = found_schema.add(name, kind)
    found = docs.sparkSession.createDataFrame([], found_schema)
    statistics, longest = benchmark_statistics(items, item_text_col)
    for shard in item_shards(items, item_id_col, item_text_col, index_bytes):
        index = build(shard, statistics, longest)
        found = found.unionByName(given.mapInArrow(_searcher(index, threshold, overlap, found_schema), found_schema))
    return found.groupBy("doc_id", "item_id").agg(
        F.max("score").alias("score"),
        F.max("question_share").alias("question_share"),
        F.max("answer_share").alias("answer_share"),
        F.min("first_word").alias("first_word"),
        F.count("*").alias("n_passages"),
    )


def _searcher(index: Index, threshold: float, overlap: float, schema: StructType):
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, rows = batch.column("text"), []
            for lo, hi in slices(texts):
                rows += [(h[0] + lo, *h[1:]) for h in hits_of(texts.slice(lo, hi - lo), index, threshold, overlap)]
            doc = batch.column("doc_id").take(pa.array([r[0] for r in rows], pa.int64())).cast(arrow.field("doc_id").type)
            columns = [[index.ids[r[1]] for r in rows], *([r[i] for r in rows] for i in range(2, 6))]
            fields = list(arrow)[1:]
            yield pa.RecordBatch.from_arrays([doc, *(pa.array(c, f.type) for c, f in zip(columns, fields, strict=True))], schema=arrow)

    return search
