"""N-gram Jaccard join: token-group matrix.

A document's set are its distinct word shingles. Two documents link when the overlap of their sets is at
least ``percent`` of their union. The join is exact: every link between different sets is found, and the
result is the connected component of each document.

* Documents with equal sets are one, under the smallest id: within a task at once, over all tasks by digest.
* Documents are partitioned into groups by their smallest shingle hash among the frequent ones if there
  are any, so that near copies come into few groups.
* All sets have their shingles in one order, rare ones first. If two sets link, then their beginnings share
  some
  shingles: with beginnings of ``n - ceil(t * n) + 1 + extra(n)`` shingles about ``extra(n)`` of them, see
  ``least_met``. The token-group matrix has a cell for each shingle and group: whether the shingle is in the
  union of the group's beginnings.
* The number of cells of a group that a query document meets bounds its overlap with any member. Only
  groups that reach the bound are opened: the query's whole set is sent there and compared with members.
* An opened group keeps clusters of linked documents with the union of their beginnings, and bounds a document's
  overlap with a cluster in the same way before it compares it with members. Members of one cluster need
  not be compared with each other, so a group of thousands of near copies does not make all its pairs.

Frequent shingles are those that several documents of one Arrow batch share, added up over all batches. They
only decide the order and the groups, not the result, so the list may be cut at ``frequent`` entries; that
bounds what is sent to the tasks. Chance collisions of the 48 and 32 bits that stand for shingles and groups
cost comparisons, not correctness; sets are compared with 64-bit hashes of shingles.

Defined results: a text with fewer words than a shingle has its whole sequence as one shingle; null and
empty texts have an empty set and link with nothing. Null ids come after all others. Rows that repeat an id
are told apart by a hash of their text. An empty table gives an empty result.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm import repeats
from millrace.llm.components import connected_components
from millrace.llm.ranges import shuffle_partitions
from millrace.llm.repeats import BLOCK, DOC, FACTS, TIE
from millrace.llm.words import U64, counted, mix, shingle_hashes, slices, word_hashes
from millrace.workspace import materialize

SHINGLE_WORDS = 5
PERCENT = 80
# a beginning is longer than one common shingle needs: by two shingles and so many per cent of the set
EXTRA = 2
EXTRA_PERCENT = 7
# a shingle in so many documents of a batch is reported, and frequent with so many in all
BATCH_COUNT = 4
TOTAL_COUNT = 32
FREQUENT = 1 << 18

CROSS, OWN, COPY = 0, 1, 2


def sets_of(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each text, ascending, and where each text's begin (and the last end)."""
    words, first = word_hashes(texts, lower=True)
    hashes, text_of = shingle_hashes(words, first, k)
    order = np.lexsort((hashes, text_of))
    hashes, text_of = hashes[order], text_of[order]
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (text_of[1:] != text_of[:-1])
    return hashes[new], np.searchsorted(text_of[new], np.arange(len(texts) + 1))


def _digests(tokens: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that tell sets apart, as two sums over differently mixed shingles."""

    def total(values: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(values) + 1, U64)
        np.cumsum(values, out=sums[1:])
        return sums[first[1:]] - sums[first[:-1]]

    return total(mix(tokens ^ U64(0xA0761D6478BD642F))), total(mix(tokens + U64(0xE7037ED1A0B428DB)))


def needed(n: np.ndarray | int, percent: int) -> np.ndarray | int:
    """The least overlap of a set of ``n`` with any set it links to."""
    return -(-percent * n // 100)


def beginning(n: np.ndarray | int, percent: int) -> np.ndarray | int:
    return np.minimum(n, n - needed(n, percent) + 1 + EXTRA + EXTRA_PERCENT * n // 100)


def least_met(n: np.ndarray | int, percent: int) -> np.ndarray | int:
    """The least number of shingles that the beginnings of a set of ``n`` and of any set it links to share.

    The common shingles outside of either beginning are the last in the order, so they are as many as the
    longer remainder at most. With ``N`` the larger set that is ``needed(N) - 1 - extra(N)``, or one more where
    rounding lets a smaller set have the longer remainder; the overlap is ``needed(N)`` at least.
    """
    return np.maximum(1, np.minimum(needed(n, percent) - 1, EXTRA + EXTRA_PERCENT * n // 100))


def in_rare_order(tokens: np.ndarray, first: np.ndarray, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each set with its frequent shingles last, and the marks of those."""
    text_of = np.repeat(np.arange(len(first) - 1), np.diff(first))
    marked = np.zeros(len(tokens), dtype=bool)
    if len(frequent):
        at = np.searchsorted(frequent, tokens)
        at[at == len(frequent)] = 0
        marked = frequent[at] == tokens
    # sets are ascending already, so a stable sort on the two marks keeps that order within each part
    order = np.argsort(text_of * 2 + marked, kind="stable")
    return tokens[order], marked[order]


def group_of(ordered: np.ndarray, marked: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The smallest frequent shingle of a set, or the smallest of all if none is frequent; 32 bits of it."""
    n_rare = np.add.reduceat(np.append(~marked, False), np.minimum(first[:-1], len(marked))).astype(np.int64)
    n = np.diff(first)
    n_rare[n == 0] = 0
    at = first[:-1] + np.where((n_rare < n) & (n > 0), n_rare, 0)
    at = np.minimum(at, max(len(ordered) - 1, 0))
    picked = ordered[at] if len(ordered) else np.zeros(len(n), U64)
    return (mix(picked) >> U64(32)).astype(np.uint32)


def _sets_by_slice(batch: pa.RecordBatch, text_col: str, k: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """The sets of a batch, a range of rows at a time."""
    texts = batch.column(text_col)
    for lo, hi in slices(texts):
        yield lo, hi, *sets_of(texts.slice(lo, hi - lo), k)


# ---------------------------------------------------------------- statistics over all documents


def signatures(docs: DataFrame, text_col: str, k: int) -> DataFrame:
    """Document key, size of the set and its digest."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, tie = repeats.key_of(batch)
            for lo, hi, tokens, first in _sets_by_slice(batch, text_col, k):
                a, b = _digests(tokens, first)
                columns = {"doc": doc[lo:hi], "tie": tie[lo:hi], "n": np.diff(first), "a": a.view(np.int64), "b": b.view(np.int64)}
                yield pa.RecordBatch.from_pydict(columns)

    return docs.mapInArrow(sign, "doc bigint, tie bigint, n bigint, a bigint, b bigint")


def frequent_shingles(docs: DataFrame, text_col: str, k: int, most: int) -> np.ndarray:
    """The shingles of many documents, ascending; the ``most`` frequent of them if there are more."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            ordered = np.concatenate([tokens for _, _, tokens, _ in _sets_by_slice(batch, text_col, k)])
            ordered.sort()
            start = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))[: len(ordered)]
            many = np.diff(np.append(start, len(ordered)))
            seen = many >= BATCH_COUNT
            yield pa.RecordBatch.from_pydict({"token": ordered[start[seen]].view(np.int64), "many": many[seen]})

    counted = docs.mapInArrow(count, "token bigint, many bigint").groupBy("token").agg(F.sum("many").alias("many"))
    top = counted.where(F.col("many") >= TOTAL_COUNT).orderBy(F.col("many").desc(), "token").limit(most)
    listed = top.select("token").toArrow().column("token").to_numpy()
    return np.sort(listed.view(U64))


# ---------------------------------------------------------------- the matrix


def _cell_blocks(docs: DataFrame, text_col: str, k: int, percent: int, frequent: np.ndarray, buckets: int) -> DataFrame:
    """The shingles of each document's beginning, with its group, dealt by shingle."""

    def settle(rows: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray, int]]:
        # of equal sets the first document is enough
        a, b, doc, tie = (rows.column(c).to_numpy() for c in ("a", "b", "doc", "tie"))
        order = np.lexsort((tie, doc, b, a))
        new = np.ones(len(order), dtype=bool)
        new[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
        picked = rows.take(pa.array(np.sort(order[new])))
        cells = picked.column("cells")
        row = pa.compute.list_parent_indices(cells)
        token = cells.flatten().to_numpy()
        many = {c: picked.column(c).take(row) for c in ("doc", "tie", "group", "n")}
        high, low = (token >> U64(32)).astype(np.uint32), ((token >> U64(16)) & U64(0xFFFF)).astype(np.uint16)
        yield pa.RecordBatch.from_pydict({**many, "high": high, "low": low}), repeats.bucket_of_hash(token, buckets), FACTS

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = repeats.Outbox(settle)
        for batch in batches:
            doc, tie = repeats.key_of(batch)
            for lo, hi, tokens, first in _sets_by_slice(batch, text_col, k):
                n = np.diff(first)
                a, b = _digests(tokens, first)
                ordered, marked = in_rare_order(tokens, first, frequent)
                many = beginning(n, percent)
                offsets = np.concatenate([[0], np.cumsum(many)])
                token = ordered[np.repeat(first[:-1] - offsets[:-1], many) + np.arange(offsets[-1])]
                columns = {
                    "doc": doc[lo:hi],
                    "tie": tie[lo:hi],
                    "group": group_of(ordered, marked, first),
                    "n": n.astype(np.uint32),
                    "a": a,
                    "b": b,
                    "cells": pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), pa.array(token, pa.uint64())),
                }
                yield from out.add(pa.RecordBatch.from_pydict(columns))
        yield from out.flush()

    return docs.mapInArrow(send, BLOCK)


def _met_groups(cells: DataFrame, percent: int, buckets: int) -> DataFrame:
    """For each document and shingle the groups, its own included, that have another document with the shingle."""

    def settle(rows: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray, int]]:
        yield repeats.send_runs(rows, buckets, FACTS)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = repeats.Outbox(settle)
        for facts, _ in repeats.grouped_facts(batches):
            x = repeats.joined(facts)
            token = x["high"].astype(U64) << U64(16) | x["low"].astype(U64)
            order = np.lexsort((x["group"], token))
            token, group, n = token[order], x["group"][order], x["n"][order].astype(np.int64)
            new_token = np.ones(len(order), dtype=bool)
            new_token[1:] = token[1:] != token[:-1]
            new_cell = new_token.copy()
            new_cell[1:] |= group[1:] != group[:-1]
            cell_at = np.flatnonzero(new_cell)
            cell_of = np.cumsum(new_cell) - 1
            token_of = np.cumsum(new_token) - 1
            members = np.diff(np.append(cell_at, len(order)))
            smallest = np.minimum.reduceat(n, cell_at)
            largest = np.maximum.reduceat(n, cell_at)
            cells_of_token = np.bincount(token_of[cell_at])
            first_cell = np.concatenate([[0], np.cumsum(cells_of_token)[:-1]])
            # every document of a shingle with every cell of the shingle
            many = cells_of_token[token_of]
            many[(many == 1) & (members[cell_of] == 1)] = 0
            row_all = np.arange(len(order))
            for part in _parts_of(many, 4_000_000):
                row = np.repeat(row_all[part], many[part])
                cell = counted(many[part]) + first_cell[token_of[row]]
                own = cell == cell_of[row]
                fits = (100 * largest[cell] >= percent * n[row]) & (100 * n[row] >= percent * smallest[cell])
                kept = np.flatnonzero(fits & (~own | (members[cell] > 1)))
                if not len(kept):
                    continue
                at = order[row[kept]]
                doc, tie = x["doc"][at], x["tie"][at]
                met = pa.RecordBatch.from_pydict(
                    {"doc": doc, "tie": tie, "group": group[cell_at[cell[kept]]], "flag": np.where(own[kept], OWN, CROSS).astype(np.uint8)}
                )
                yield from out.add(met)
        yield from out.flush()

    return cells.mapInArrow(meet, BLOCK)


def _parts_of(many: np.ndarray, limit: int) -> Iterator[slice]:
    total = np.cumsum(many)
    begin = 0
    while begin < len(many):
        done = total[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(total, done + limit, "right")))
        yield slice(begin, end)
        begin = end


def _copy_blocks(members: DataFrame, buckets: int) -> DataFrame:
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                doc, tie = (batch.column(c).to_numpy() for c in ("doc", "tie"))
                none = np.zeros(len(doc), np.uint32)
                facts = pa.RecordBatch.from_pydict({"doc": doc, "tie": tie, "group": none, "flag": np.full(len(doc), COPY, np.uint8)})
                yield from repeats.block_batches(repeats.deal(facts, repeats.bucket_of_doc(doc, tie, buckets), FACTS))

    return members.mapInArrow(send, BLOCK)


# ---------------------------------------------------------------- opened groups


def _open_groups(texts: DataFrame, text_col: str, k: int, percent: int, frequent: np.ndarray, buckets: int) -> DataFrame:
    """The sets of documents that reach the bound of a group, dealt by group."""

    def settle(rows: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray, int]]:
        group = rows.column("group").to_numpy()
        yield rows, (mix(group.astype(U64)) % U64(buckets)).astype(np.int32), FACTS

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = repeats.Outbox(settle)
        for batch, facts in repeats.texts_with_facts(batches):
            doc, tie, at_row = repeats.distinct_documents(batch)
            row, x = facts.of(doc, tie)
            if not len(row):
                continue
            copies = np.zeros(len(doc), dtype=bool)
            copies[row[x["flag"] == COPY]] = True
            here = np.flatnonzero((x["flag"] != COPY) & ~copies[row])
            if not len(here):
                continue
            # how many cells of each group a document meets
            pair = row[here].astype(U64) << U64(33) | x["flag"][here].astype(U64) << U64(32) | x["group"][here].astype(U64)
            pair, met = np.unique(pair, return_counts=True)
            rows, own = (pair >> U64(33)).astype(np.int64), (pair >> U64(32)) & U64(1) == OWN
            group = (pair & U64(0xFFFFFFFF)).astype(np.uint32)
            used = np.unique(rows)
            tokens, first = sets_of(batch.column(text_col).take(pa.array(at_row[used])), k)
            ordered, marked = in_rare_order(tokens, first, frequent)
            mine, n = group_of(ordered, marked, first), np.diff(first)
            at = np.searchsorted(used, rows)
            enough = met >= least_met(n[at], percent)
            # a pair of groups meets in the one with the smaller number; there the other side are members
            active = np.unique(at[enough])
            cross = np.flatnonzero(enough & ~own & (group < mine[at]))
            to = np.concatenate([mine[active], group[cross]])
            of = np.concatenate([active, at[cross]])
            member = np.concatenate([np.ones(len(active), bool), np.zeros(len(cross), bool)])
            if not len(of):
                continue
            offsets = np.concatenate([[0], np.cumsum(n[of])])
            joined = ordered[np.repeat(first[:-1][of], n[of]) + counted(n[of])]
            sets = pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), pa.array(joined, pa.uint64()))
            rows_out = pa.RecordBatch.from_pydict(
                {"group": to, "doc": doc[used][of], "tie": tie[used][of], "member": member, "set": sets}
            )
            yield from out.add(rows_out)
        yield from out.flush()

    return texts.mapInArrow(send, BLOCK)


class Clusters:
    """The documents of one opened group, clustered by the links found so far."""

    def __init__(self, percent: int) -> None:
        self.percent = percent
        self.sets: list[np.ndarray] = []
        self.parent: list[int] = []
        self.members: dict[int, list[int]] = {}
        # shingle of a beginning -> clusters whose union of beginnings has it
        self.clusters_of: dict[int, set[int]] = defaultdict(set)

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def linked(self, a: np.ndarray, b: np.ndarray) -> bool:
        if 100 * min(len(a), len(b)) < self.percent * max(len(a), len(b)):
            return False
        at = np.searchsorted(b, a)
        at[at == len(b)] = 0
        both = int((b[at] == a).sum())
        return 100 * both >= self.percent * (len(a) + len(b) - both)

    def add(self, ordered: np.ndarray, compare: bool = True) -> int:
        """Add a set, given in rare order, and link it to every cluster that has a document it links to."""
        i, n = len(self.sets), len(ordered)
        own = np.sort(ordered)
        self.sets.append(own)
        self.parent.append(i)
        self.members[i] = [i]
        tokens = ordered[: int(beginning(n, self.percent))].tolist()
        met: dict[int, int] = defaultdict(int)
        for token in tokens:
            known = self.clusters_of.get(token)
            if known:
                # clusters that were joined since count once
                roots = {self.root(c) for c in known}
                if len(roots) < len(known):
                    self.clusters_of[token] = roots
                for c in roots:
                    met[c] += 1
        bound = int(least_met(n, self.percent))
        for c, many in sorted(met.items(), key=lambda x: -x[1]):
            if many < bound:
                break
            if any(self.linked(own, self.sets[j]) for j in self.members[c]):
                self._join(c, self.root(i))
        root = self.root(i)
        for token in tokens:
            self.clusters_of[token].add(root)
        return i

    def _join(self, a: int, b: int) -> None:
        if len(self.members[a]) < len(self.members[b]):
            a, b = b, a
        self.parent[b] = a
        self.members[a] += self.members.pop(b)


def _links(opened: DataFrame, percent: int) -> DataFrame:
    """Edges between each document and the smallest one of its cluster in a group."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for facts, _ in repeats.grouped_facts(batches):
            table = pa.Table.from_batches([repeats.from_block(b) for b in facts])
            group, doc, tie = (table.column(c).to_numpy() for c in ("group", "doc", "tie"))
            sets = table.column("set").combine_chunks()
            begin, values = sets.offsets.to_numpy(), sets.values.to_numpy()
            order = np.lexsort((tie, doc, np.diff(begin), group))
            edges: list[tuple[int, int, int, int]] = []
            for part in np.split(order, np.flatnonzero(np.diff(group[order])) + 1):
                if len(part) < 2:
                    continue
                clusters = Clusters(percent)
                for i in part.tolist():
                    clusters.add(values[begin[i] : begin[i + 1]])
                for members in clusters.members.values():
                    rows = sorted((int(doc[part[j]]), int(tie[part[j]])) for j in members)
                    edges += [(*row, *rows[0]) for row in rows[1:]]
            if edges:
                yield pa.RecordBatch.from_pydict(dict(zip(("doc", "tie", "to_doc", "to_tie"), map(list, zip(*edges, strict=True)), strict=True)))

    return opened.mapInArrow(compare, "doc bigint, tie bigint, to_doc bigint, to_tie bigint")


def key_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    given = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return repeats.keyed(given, "id", "text").select("id", DOC, TIE, "text")


def similar_components(
    docs: DataFrame,
    id_col: str,
    text_col: str,
    *,
    k: int = SHINGLE_WORDS,
    percent: int = PERCENT,
    frequent: int = FREQUENT,
) -> DataFrame:
    """Per document its working key, ``n_shingles`` and the key of the smallest document of its component.

    Columns: ``doc``, ``tie``, ``n_shingles``, ``root_doc``, ``root_tie``, see ``repeats.keyed`` for the key.
    """
    keyed, text_col = key_and_text(docs, id_col, text_col), "text"
    parts = shuffle_partitions(docs)
    buckets = parts * repeats.BUCKETS_PER_PARTITION
    signed = materialize(signatures(keyed, text_col, k).distinct(), "signatures")
    first = signed.where("n > 0").groupBy("a", "b", "n").agg(F.min(F.struct("doc", "tie")).alias("first"))
    first = materialize(first, "first")
    members = materialize(
        signed.join(first, ["a", "b", "n"], "left").select(
            "doc", "tie", "n", F.coalesce("first", F.struct("doc", "tie")).alias("first")
        ),
        "members",
    )
    common = frequent_shingles(keyed, text_col, k, frequent)
    cells = repeats.by_bucket(_cell_blocks(keyed, text_col, k, percent, common, buckets), parts)
    met = _met_groups(cells, percent, buckets)
    copies = members.where(F.struct("doc", "tie") != F.col("first")).select("doc", "tie")
    keyed = keyed.drop("id")
    facts = met.unionByName(_copy_blocks(copies, buckets))
    texts = repeats.by_bucket(facts.unionByName(repeats.text_blocks(keyed, buckets)), parts)
    opened = repeats.by_bucket(_open_groups(texts, text_col, k, percent, common, buckets), parts)
    links = _links(opened, percent)
    edges = links.select(F.struct("doc", "tie").alias("u"), F.struct(F.col("to_doc").alias("doc"), F.col("to_tie").alias("tie")).alias("v"))
    roots = materialize(connected_components(edges), "components")
    return members.join(roots, members["first"] == roots["node"], "left").select(
        "doc",
        "tie",
        F.col("n").alias("n_shingles"),
        F.coalesce(F.col("root.doc"), F.col("first.doc")).alias("root_doc"),
        F.coalesce(F.col("root.tie"), F.col("first.tie")).alias("root_tie"),
    )


def components_by_id(docs: DataFrame, id_col: str, text_col: str, **options) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of every row of ``docs``, repeated rows included."""
    found = similar_components(docs, id_col, text_col, **options)
    keys = key_and_text(docs, id_col, text_col).select(F.col("id").alias("doc_id"), DOC, TIE)
    joined = keys.join(found, (F.col(DOC) == F.col("doc")) & (F.col(TIE) == F.col("tie")))
    # the working id of a null id is the largest number
    least = F.when(F.col("root_doc") != F.lit((1 << 63) - 1), F.col("root_doc"))
    return joined.select("doc_id", "n_shingles", least.alias("component_id"))


def components_sql(k: int, percent: int, table: str = "documents") -> str:
    """The result of ``components_by_id`` for DuckDB."""
    return rf"""
    WITH RECURSIVE words AS (
        SELECT doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
        FROM {table}
    ),
    shingles AS (
        SELECT DISTINCT doc_id, array_to_string(w[i : i + {k - 1}], ' ') AS s
        FROM (SELECT doc_id, w, unnest(range(1, 1 + greatest(len(w) - {k - 1}, CASE WHEN len(w) > 0 THEN 1 ELSE 0 END))) AS i FROM words)
    ),
    sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    common AS (
        SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n_both
        FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2
    ),
    links AS (
        SELECT a, b FROM common JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
        WHERE 100 * n_both >= {percent} * (x.n + y.n - n_both)
    ),
    reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
    SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(min(b), d.doc_id)) AS component_id
    FROM {table} d LEFT JOIN sizes s USING (doc_id) LEFT JOIN reach r ON r.a = d.doc_id
    GROUP BY d.doc_id, n
    """
