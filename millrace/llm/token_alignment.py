"""Alignment of two tokenizers over the same bytes, by products of sparse incidence matrices.

The tokens of a text by tokenizer A and by B cover the same bytes. Matrix A has a row for each A token and a column for
each byte, with a one where the token covers the byte; B alike. Row i of A times B transposed gives the B tokens that
overlap with token i, and the bytes they share. The places where a token of A and one of B end cut the text into
groups. With one row for each A id of a text and one column for each group (and B alike), the product gives the pairs of
ids that share a group and how often. The matrices are rows of pointers, columns and values built here, and products
go row by row (Gustavson): the rows of the second matrix that a row of the first one names are added up.

Id pairs are then counted over all documents. A task works on slices of documents, each with a list of the pairs that its
documents hold; only these lists are shuffled to be counted, and the counts come back to each slice. What is stored of a
slice is a row for each document and one for its list: rows as large as a slice would be held together by the hundred
where files are written and read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from millrace.llm.bpe import vocabulary
from millrace.llm.words import counted, slices
from millrace.operators.joins import salted_join
from millrace.workspace import materialize

# text of one stored slice, and of what is multiplied at a time; terms of a product held at a time
STORED_BYTES = 4_000_000
WORK_BYTES = 500_000
TERMS = 2_000_000
# what a task holds of the stored rows as it writes or reads them, even where documents are long
STORED_GROUP = {"parquet.block.size": 8_000_000, "parquet.block.size.row.check.min": 1, "parquet.page.size.row.check.min": 1}
ROWS_PER_TASK = 1_000_000
_SLICE_BITS = 33

# ---------------------------------------------------------------- sparse matrices


class Sparse:
    """A matrix by rows: where each row begins, the columns of its entries, and their values."""

    def __init__(self, first: np.ndarray, columns: np.ndarray, values: np.ndarray, width: int) -> None:
        self.first, self.columns, self.values, self.width = first, columns, values, width

    @classmethod
    def of_runs(cls, starts: np.ndarray, ends: np.ndarray, width: int) -> Sparse:
        """Row i has ones in the columns from ``starts[i]`` to ``ends[i]``."""
        lengths = ends - starts
        columns = np.repeat(starts, lengths) + counted(lengths)
        return cls(np.r_[0, np.cumsum(lengths)], columns, np.ones(len(columns), np.int64), width)

    @classmethod
    def of_counts(cls, rows: np.ndarray, columns: np.ndarray, height: int, width: int) -> Sparse:
        """How often each pair of row and column is given."""
        cells, values = np.unique(rows * width + columns, return_counts=True)
        rows, columns = np.divmod(cells, max(width, 1))
        return cls(np.searchsorted(rows, np.arange(height + 1)), columns, values, width)

    def transposed(self) -> Sparse:
        rows = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))
        order = np.argsort(self.columns, kind="stable")
        first = np.r_[0, np.cumsum(np.bincount(self.columns, minlength=self.width))]
        return Sparse(first, rows[order], self.values[order], len(self.first) - 1)

    def times(self, other: Sparse, terms: int = TERMS) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """The product in blocks of whole rows: rows, columns and values of its entries, in order.

        A block has about ``terms`` terms before they are added up; a row with more is a block of its own.
        """
        lengths = np.diff(other.first)[self.columns]
        before = np.r_[0, np.cumsum(lengths)]
        of_rows = before[self.first]
        row, height = 0, len(self.first) - 1
        while row < height:
            end = max(row + 1, int(np.searchsorted(of_rows, of_rows[row] + terms, "right")) - 1)
            lo, hi = self.first[row], self.first[end]
            n = lengths[lo:hi]
            at = np.repeat(other.first[self.columns[lo:hi]], n) + counted(n)
            rows = np.repeat(np.repeat(np.arange(row, end), np.diff(self.first[row : end + 1])), n)
            cells = rows * other.width + other.columns[at]
            values = np.repeat(self.values[lo:hi], n) * other.values[at]
            order = np.argsort(cells, kind="stable")
            cells = cells[order]
            heads = np.flatnonzero(np.r_[True, cells[1:] != cells[:-1]]) if len(cells) else np.zeros(0, np.int64)
            if len(cells):
                yield *np.divmod(cells[heads], other.width), np.add.reduceat(values[order], heads)
            row = end


# ---------------------------------------------------------------- tokenizers


class Tokenizers:
    """Tokenizer A, a byte-level BPE file, and B, a sentencepiece model; and the bytes of their tokens."""

    def __init__(self, a_path: str, b_path: str) -> None:
        import sentencepiece

        self._a = vocabulary(a_path, False)
        self._b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.b_size = self._b.get_piece_size()
        pieces = [self._b_bytes(i) for i in range(self.b_size)]
        self.a_lengths, self.b_lengths = self._a.lengths, np.array([len(p) for p in pieces], np.int64)
        self._b_offsets, self._b_data = np.cumsum(self.b_lengths) - self.b_lengths, np.frombuffer(b"".join(pieces), np.uint8)
        # an id and what stands after it, see ``Aligned``
        numbers = [str(i) for i in range(max(len(self.a_lengths), self.b_size))]
        self.written = np.array([[x + after for x in numbers] for after in (",", "|", ";", "")], dtype=object)

    def _b_bytes(self, i: int) -> bytes:
        piece = self._b.id_to_piece(i)
        return bytes([int(piece[3:-1], 16)]) if self._b.is_byte(i) else piece.replace("▁", " ").encode()

    def encoded(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For A and for B the number of tokens of each text, and all tokens in order.

        A text has no tokens if those of either do not have the bytes of a blank and the text.
        """
        given = [f" {t}" if t else "" for t in texts]
        parts, _, sizes, a_ids = self._a.encoded(given)
        a = np.diff(np.r_[0, np.cumsum(sizes)][np.r_[0, np.cumsum(parts)]]), a_ids
        pieces = self._b.encode([t or "" for t in texts], num_threads=1)
        b_counts = np.array([len(x) for x in pieces], np.int64)
        b = b_counts, np.fromiter(chain.from_iterable(pieces), np.int64, int(b_counts.sum()))
        encoded = [g.encode() for g in given]
        whole = self._whole(encoded, *a, self.a_lengths, self._a.offsets, self._a.data)
        whole &= self._whole(encoded, *b, self.b_lengths, self._b_offsets, self._b_data)
        return [(np.where(whole, n, 0), ids[np.repeat(whole, n)]) for n, ids in (a, b)]

    @staticmethod
    def _whole(texts: list[bytes], counts: np.ndarray, ids: np.ndarray, lengths: np.ndarray, offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
        """Whether the tokens of each text have its bytes."""
        n = lengths[ids]
        ends = np.r_[0, np.cumsum(n)][np.r_[0, np.cumsum(counts)]]
        found = data[np.repeat(offsets[ids], n) + counted(n)].tobytes()
        if found == b"".join(texts) and (np.diff(ends) == [len(t) for t in texts]).all():
            return np.ones(len(texts), bool)
        return np.array([found[lo:hi] == t for lo, hi, t in zip(ends.tolist(), ends[1:].tolist(), texts)], bool)


@lru_cache(maxsize=2)
def tokenizers(a_path: str, b_path: str) -> Tokenizers:
    return Tokenizers(a_path, b_path)


class Aligned:
    """Some texts: for each text its counts, the digest of its groups, and its linked pairs of ids."""

    def __init__(self, texts: list[str | None], both: Tokenizers) -> None:
        (self.n_a, a_ids), (self.n_b, b_ids) = both.encoded(texts)
        n = len(texts)
        a_text = np.repeat(np.arange(n), self.n_a)
        # as if all texts followed one another
        a_end, b_end = np.cumsum(both.a_lengths[a_ids]), np.cumsum(both.b_lengths[b_ids])
        width = int(a_end[-1]) if len(a_end) else 0
        # overlap links
        of_a = Sparse.of_runs(a_end - both.a_lengths[a_ids], a_end, width)
        of_b = Sparse.of_runs(b_end - both.b_lengths[b_ids], b_end, width)
        self.n_overlaps = np.zeros(n, np.int64)
        for rows, _, _ in of_a.times(of_b.transposed()):
            self.n_overlaps += np.bincount(a_text[rows], minlength=n)
        # groups end where both end; all texts stand one after the other, so each text's end is one
        ends = np.intersect1d(a_end, b_end, assume_unique=True)
        a_group, b_group = np.searchsorted(ends, a_end), np.searchsorted(ends, b_end)
        group_text = a_text[np.searchsorted(a_end, ends)]
        self.n_groups = np.bincount(group_text, minlength=n)
        # a row for each A id of a text, and a column for each B id
        row_keys, rows = np.unique(a_text * len(both.a_lengths) + a_ids, return_inverse=True)
        groups_of_a = Sparse.of_counts(rows, a_group, len(row_keys), len(ends))
        groups_of_b = Sparse.of_counts(b_group, b_ids, len(ends), both.b_size)
        found = list(groups_of_a.times(groups_of_b))
        rows, columns, self.times = (np.concatenate([x[k] for x in found]) if found else np.zeros(0, np.int64) for k in range(3))
        self.text_of, a_of = np.divmod(row_keys[rows], len(both.a_lengths))
        self.pair = a_of * both.b_size + columns
        self.n_links = np.bincount(self.text_of, weights=self.times, minlength=n).astype(np.int64)
        self.digests = self._digests(both, (a_group, a_ids, self.n_a), (b_group, b_ids, self.n_b), group_text)

    def _digests(self, both: Tokenizers, a: tuple, b: tuple, group_text: np.ndarray) -> list[str]:
        """SHA-256 of each text's ids by group: A before B, groups in order."""
        place = np.r_[2 * a[0], 2 * b[0] + 1]
        order = np.argsort(place, kind="stable")
        place, ids = place[order], np.r_[a[1], b[1]][order]
        text = group_text[place // 2]
        after = np.full(len(ids), 3)  # nothing
        same, here = place[1:] == place[:-1], text[1:] == text[:-1]
        after[:-1] = np.where(same, 0, np.where(place[:-1] % 2 == 0, 1, np.where(here, 2, 3)))
        cells = both.written[after, ids].tolist()
        ends = np.cumsum(a[2] + b[2]).tolist()
        return [hashlib.sha256("".join(cells[lo:hi]).encode()).hexdigest() if hi > lo else "" for lo, hi in zip([0, *ends], ends)]


# ---------------------------------------------------------------- over all documents

_COUNTS = ("n_a", "n_b", "n_groups", "n_links", "n_overlaps")
# a document's row, and the row of a slice's list; what one has the other has not
_DOCUMENT = "doc_id bigint, " + ", ".join(f"{c} bigint" for c in _COUNTS) + ", groups_sha256 string, at binary, times binary"
_LIST = "pairs binary, docs binary"
_STORED = f"slice bigint, {_DOCUMENT}, {_LIST}"
_RESULT = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string, n_overlaps bigint"


def align(docs: DataFrame, id_col: str, text_col: str, a_path: str, b_path: str) -> DataFrame:
    """Tokens, groups and links of every document, and how common its links are in all documents.

    ``n_links`` counts the pairs of an A and a B token that share a group, ``n_overlaps`` those that share bytes. The count
    of a pair of ids is the number of documents that hold it linked; ``count_sum`` adds it up over the links, and
    ``n_best`` counts the links whose pair has the highest count of all pairs of its A id, ties included. ``groups_sha256``
    is the digest of all groups, ``a1,a2|b1;a3|b2,b3``. The files of the tokenizers must be on every executor.

    Defined results: a text that is null or empty, or whose tokens do not have the bytes of a blank and the text, has no
    tokens, zeros and an empty digest. Rows that repeat an id are documents of their own; null ids stay. Other
    columns do not matter. An empty table gives an empty result.
    """

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = tokenizers(a_path, b_path)
        number = TaskContext.get().partitionId() << _SLICE_BITS
        for batch in batches:
            for lo, hi in slices(batch.column("text"), STORED_BYTES):
                yield from _stored(number, batch.slice(lo, hi - lo), both)
                number += 1

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = tokenizers(a_path, b_path).b_size
        for batch in batches:
            for i in range(len(batch)):
                pairs, held = (np.frombuffer(batch.column(c)[i].as_py(), "<i8") for c in ("pairs", "docs"))
                a, b = np.divmod(pairs, width)
                number = np.full(len(pairs), batch.column("slice")[i].as_py())
                columns = [number, np.arange(len(pairs)), a, b, held]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["slice", "place", "a", "b", "docs"])

    rows = docs.select(docs[id_col].cast("bigint").alias("doc_id"), docs[text_col].alias("text"))
    stored = materialize(rows.mapInArrow(store, _STORED), "alignment", STORED_GROUP)
    lists = stored.where("pairs is not null").select("slice", "pairs", "docs")
    listed = lists.mapInArrow(entries, "slice bigint, place bigint, a bigint, b bigint, docs bigint")
    # at most one row for each pair and slice; there are no more pairs than A ids times B ids
    counts = materialize(listed.groupBy("a", "b").agg(F.sum("docs").alias("count"), F.count("*").alias("n")), "alignment-pairs")
    highest = counts.groupBy(F.col("a").alias("of")).agg(F.max("count").alias("highest"))
    rated = counts.join(highest, counts["a"] == highest["of"]).select("a", "b", "count", (F.col("count") == F.col("highest")).alias("best"))
    answers = salted_join(
        listed.drop("docs"), rated, ["a", "b"], ["slice"], key_counts=counts.select("a", "b", "n"), rows_per_task=ROWS_PER_TASK
    ).select("slice", "place", "count", "best")
    held = stored.where("pairs is null").drop("pairs", "docs")
    return held.groupBy("slice").cogroup(answers.groupBy("slice")).applyInArrow(_answered, _RESULT)


def _names(ddl: str) -> list[str]:
    return [c.split()[0] for c in ddl.split(", ")]


def _stored(number: int, batch: pa.RecordBatch, both: Tokenizers) -> Iterator[pa.RecordBatch]:
    """What is stored of a slice: a row for each document with its counts and its pairs by their place in the list; the list."""
    texts, done, base = batch.column("text"), [], 0
    text_of, pair = [], []
    for lo, hi in slices(texts, WORK_BYTES):
        part = Aligned(texts.slice(lo, hi - lo).to_pylist(), both)
        text_of.append(part.text_of + base)
        pair.append(part.pair)
        # what is added up is no longer needed
        del part.text_of, part.pair
        done.append(part)
        base += hi - lo
    known, at = np.unique(np.concatenate(pair), return_inverse=True)
    first = np.r_[0, np.cumsum(np.bincount(np.concatenate(text_of), minlength=len(batch)))].tolist()
    n, counted_pairs = len(batch), np.bincount(at, minlength=len(known))
    parts = [(x.tobytes(), x.itemsize) for x in (at.astype("<u4"), np.concatenate([p.times for p in done]).astype("<i8"))]
    document = [
        batch.column("doc_id"),
        *(pa.array(np.concatenate([getattr(p, c) for p in done]), pa.int64()) for c in _COUNTS),
        pa.array([d for p in done for d in p.digests], pa.string()),
        *(pa.array([x[lo * size : hi * size] for lo, hi in zip(first, first[1:])], pa.binary()) for x, size in parts),
    ]
    listed = [pa.array([x.astype("<i8").tobytes()], pa.binary()) for x in (known, counted_pairs)]
    names = _names(_STORED)
    yield pa.RecordBatch.from_arrays([pa.array([number] * n, pa.int64()), *document, *(pa.nulls(n, c.type) for c in listed)], names=names)
    yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *(pa.nulls(1, c.type) for c in document), *listed], names=names)


def _answered(held: pa.Table, answers: pa.Table) -> pa.Table:
    """The rows of the documents of one slice."""
    places = answers.column("place").to_numpy()
    count, best = np.zeros(len(places), np.int64), np.zeros(len(places), np.int64)
    count[places] = answers.column("count").to_numpy()
    best[places] = answers.column("best").to_numpy()
    at, times = (np.frombuffer(b"".join(held.column(c).to_pylist()), kind) for c, kind in (("at", "<u4"), ("times", "<i8")))
    first = np.r_[0, np.cumsum(pc.binary_length(held.column("at")).to_numpy() // at.itemsize)]
    sums = [np.diff(np.r_[0, np.cumsum(times * value[at])][first]) for value in (best, count)]
    out = {c: held.column(c) for c in ("doc_id", *_COUNTS, "groups_sha256")} | {"n_best": pa.array(sums[0]), "count_sum": pa.array(sums[1])}
    return pa.table({c: out[c] for c in _names(_RESULT)})
