"""Substring dedup of words: seed and extend.

Winnowed anchors are the seeds (see ``repeats``): anchors of six words that occur more than once. Documents are joined
on the grams around a seed: a seed that is frequent in different surroundings, say in a line that a third of all
documents have, would bring them all into one task, so it is widened by its own neighbours first. The windows around a seed
are parted by where the seed stands in them; those of a part share ``window - spread`` words (16 of 20), which are its gram.
Rows that share a gram are extended from it word by word, to the left and to the right, by sorting their contexts on
either side; neighbours in the sorted orders give the common extensions. A window is repeated if both extensions
together reach its length, and neighbouring repeated windows join to maximal repeats, none shorter than a window.

Of equal windows the first one stays: the smallest document id, and within a document the smallest start.
A word is removed if any repeated window covers it, so a removed stretch is a maximal repeat or several
that overlap. Windows are judged on the texts as given, not on what is left of them.

Grams are dealt and grouped by 96 bits of hash; after that words are compared as they are, those of the gram too.

Defined results: null text has no words. Texts shorter than a window lose nothing. Null ids come after all
others. Rows that repeat an id are told apart by a hash of their text; rows that repeat the text as well are
one document and lose the same words. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from millrace.llm import repeats
from millrace.llm.repeats import BLOCK, FACTS, PASSED, Windows
from millrace.llm.suffix_dedup import as_binary
from millrace.llm.words import (
    IS_SPACE,
    SLICE_BYTES,
    U64,
    as_bytes,
    counted,
    hash_ranges,
    mix,
    powers,
    prefix_sums,
    word_bounds,
    word_hashes,
)

WORDS = 20
SEED_WORDS = 6

REMOVED = "n_words bigint, n_removed bigint, spans array<struct<begin:bigint,end:bigint>>, kept_text string"


# the windows around a seed are joined in so many parts, by where the seed stands in them
PARTS = 3

_WINDOW = pa.schema(
    [
        ("doc", pa.int64()), ("tie", pa.int64()), ("start", pa.uint32()), ("left", pa.uint32()), ("right", pa.uint32()),
        ("h1", pa.uint64()), ("h2", pa.uint32()), ("segment", pa.large_binary()),
    ]
)


def seed_places(windows: Windows) -> list[tuple[int, int]]:
    """The places of a seed in its window, first and last of each part."""
    many = windows.length - windows.seed + 1
    step = -(-many // PARTS)
    return [(at, min(at + step, many) - 1) for at in range(0, many, step)]


def _windows(batch: pa.RecordBatch, facts: repeats.Facts, text_col: str, windows: Windows) -> pa.RecordBatch:
    """The words around the candidate anchors of a text block, one row for each part of an anchor's windows.

    A row has the bytes of its words (``segment``), the number of the first of them, how many stand to the left and to
    the right of the gram, and two hashes of the gram.
    """
    doc, tie, rows = repeats.distinct_documents(batch)
    number, x = facts.of(doc, tie)
    if not len(number):
        return pa.RecordBatch.from_pylist([], _WINDOW)
    used, text = np.unique(number, return_inverse=True)
    data, offsets = as_bytes(batch.column(text_col).take(pa.array(rows[used])))
    starts, ends, first = word_bounds(data, offsets)
    values = hash_ranges(data, starts, ends)
    found = windows.anchors(values, first)
    # an anchor is a candidate if the document and place are among the facts
    keep = np.isin(found.at, np.unique(first[text] + x["place"].astype(np.int64)))
    of, at, low, high = found.text[keep], found.at[keep], found.low[keep], found.high[keep]
    parts = []
    for nearest, farthest in seed_places(windows):
        # places of the seed in the windows that it answers for
        least, most = np.maximum(nearest, at - high), np.minimum(farthest, at - low)
        some = np.flatnonzero(least <= most)
        gram, size = (at - nearest)[some], np.full(len(some), windows.length - (farthest - nearest))
        parts.append((of[some], (at - most)[some], gram, size, (at - least)[some] + windows.length))
    of, begin, gram, size, end = (np.concatenate(column) for column in zip(*parts, strict=True))
    if not len(of):
        return pa.RecordBatch.from_pylist([], _WINDOW)
    inverse = powers(len(values) + 1)[1]
    sums, other = prefix_sums(values), prefix_sums(mix(values ^ U64(0x5851F42D4C957F2D)))
    columns = {
        "doc": doc[used][of],
        "tie": tie[used][of],
        "start": (begin - first[of]).astype(np.uint32),
        "left": (gram - begin).astype(np.uint32),
        "right": (end - gram - size).astype(np.uint32),
        "h1": mix((sums[gram + size] - sums[gram]) * inverse[gram]),
        "h2": (mix((other[gram + size] - other[gram]) * inverse[gram]) >> U64(32)).astype(np.uint32),
        "segment": byte_ranges(data, starts[begin], ends[end - 1]),
    }
    return pa.RecordBatch.from_pydict(columns, schema=_WINDOW)


def byte_ranges(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> pa.Array:
    """The bytes of each range; ranges may overlap."""
    size = end - begin
    offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    joined = data[np.repeat(begin - offsets[:-1], size) + np.arange(offsets[-1])]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(joined)])


def _buckets(rows: pa.RecordBatch, buckets: int) -> np.ndarray:
    return repeats.bucket_of_hash(rows.column("h1").to_numpy(), buckets)


# ---------------------------------------------------------------- extension


def word_codes(segments: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A number for every word, equal for equal words only, and the number of each segment's first word (and of the end)."""
    data, begin = as_binary(segments)
    starts, ends, first = word_bounds(data, begin)
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    joined = data[~IS_SPACE[data]]
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(joined)])
    return words.dictionary_encode().indices.to_numpy().astype(np.int64), first


def gram_groups(codes: np.ndarray, gram: np.ndarray, size: np.ndarray, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """For each row the number of its gram: those with one hash are equal word by word, or they are told apart."""
    order = np.lexsort((size, h2, h1))
    a, b = order[:-1], order[1:]
    same = (h1[a] == h1[b]) & (h2[a] == h2[b]) & (size[a] == size[b])
    a, b = a[same], b[same]
    place = counted(size[a])
    if (codes[np.repeat(gram[a], size[a]) + place] != codes[np.repeat(gram[b], size[b]) + place]).any():
        # hashes collided
        grams = [codes[at : at + n].tobytes() for at, n in zip(gram.tolist(), size.tolist(), strict=True)]
        known: dict[bytes, int] = {}
        return np.array([known.setdefault(g, len(known)) for g in grams])
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(np.concatenate([[True], ~same])) - 1 if len(order) else 0
    return out


def extended(codes: np.ndarray, group: np.ndarray, at: np.ndarray, step: int, room: np.ndarray, reach: int) -> list[np.ndarray]:
    """For each length up to ``reach`` the number of each row's run: rows of a group that share so many words beyond ``at``.

    Rows are sorted by the words on that side (``step`` 1 or -1), and neighbours compared word by word. Rows with less
    ``room`` than that are of no use in a run.
    """
    beyond = [np.where(j < room, codes[np.where(j < room, at + step * j, 0)], -1) for j in range(reach)]
    order = np.lexsort((*reversed(beyond), group))
    a, b = order[:-1], order[1:]
    alike = group[a] == group[b]
    runs = []
    for j in range(reach + 1):
        out = np.empty(len(order), np.int64)
        out[order] = np.cumsum(np.concatenate([[True], ~alike])) - 1
        runs.append(out)
        if j < reach:
            alike = alike & (beyond[j][a] == beyond[j][b])
    return runs


def repeated_windows(rows: pa.RecordBatch, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The windows of all rows that also start earlier: the row, and the place of the window's first word in it."""
    x = {c: rows.column(c).to_numpy() for c in ("doc", "tie", "start", "left", "right", "h1", "h2")}
    codes, first = word_codes(rows.column("segment"))
    left, right = x["left"].astype(np.int64), x["right"].astype(np.int64)
    gram, size = first[:-1] + left, np.diff(first) - left - right
    group = gram_groups(codes, gram, size, x["h1"], x["h2"])
    # a row alone at its gram has nothing to be compared with
    shared = np.flatnonzero(np.bincount(group)[group] > 1) if len(group) else np.zeros(0, np.int64)
    if not len(shared):
        return shared, shared
    left, right, gram, size, group = (c[shared] for c in (left, right, gram, size, group))
    order = np.lexsort((x["start"][shared].astype(np.int64) + left, x["tie"][shared], x["doc"][shared]))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    spread = length - size
    most = int(spread.max())
    backward = extended(codes, group, gram - 1, -1, left, most)
    onward = extended(codes, group, gram + size, 1, right, most)
    found_row, found_place = [], []
    # rows of one gram have one spread; a window takes some words before the gram and the rest behind it
    for total in np.unique(spread).tolist():
        for before in range(total + 1):
            here = np.flatnonzero((spread == total) & (left >= before) & (right >= total - before))
            key = backward[before][here] * (len(shared) + 1) + onward[total - before][here]
            by = np.lexsort((rank[here], key))
            again = np.flatnonzero(np.diff(key[by]) == 0) + 1
            hit = here[by[again]]
            found_row.append(shared[hit])
            found_place.append(left[hit] - before)
    return np.concatenate(found_row), np.concatenate(found_place)


def by_gram(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows in parts of about ``SLICE_BYTES`` of text that keep equal grams together."""
    h1 = rows.column("h1").to_numpy()
    order = np.argsort(h1, kind="stable")
    size = np.cumsum(pc.binary_length(rows.column("segment")).to_numpy()[order])
    edges = np.append(np.flatnonzero(np.diff(h1[order])) + 1, len(order))
    first = 0
    while first < len(order):
        done = size[first - 1] if first else 0
        last = edges[min(len(edges) - 1, np.searchsorted(edges, max(first + 1, np.searchsorted(size, done + SLICE_BYTES))))]
        yield rows.take(pa.array(order[first:last]))
        first = int(last)


def _runs(rows: pa.RecordBatch, row: np.ndarray, place: np.ndarray) -> pa.RecordBatch:
    doc, tie, start = (rows.column(c).to_numpy()[row] for c in ("doc", "tie", "start"))
    return repeats.runs_of(doc, tie, start.astype(np.int64) + place)


def _settled(rows: pa.RecordBatch, length: int) -> tuple[pa.RecordBatch, pa.RecordBatch]:
    """The first of equal rows, and the runs of windows of all later ones."""
    x = {c: rows.column(c).to_numpy() for c in ("doc", "tie", "start", "left", "right")}
    name = rows.column("segment").dictionary_encode().indices.to_numpy().astype(np.int64)
    order = np.lexsort((x["start"], x["tie"], x["doc"], x["right"], x["left"], name))
    again = np.zeros(len(order), dtype=bool)
    again[1:] = (np.diff(name[order]) == 0) & (x["left"][order][1:] == x["left"][order][:-1]) & (x["right"][order][1:] == x["right"][order][:-1])
    later = np.sort(order[again])
    # each later row loses all its windows
    n_words = np.diff(word_codes(rows.column("segment").take(pa.array(later)))[1]) if len(later) else later
    many = n_words - length + 1
    return rows.take(pa.array(np.sort(order[~again]))), _runs(rows, np.repeat(later, many), counted(many))


def _compare(text_col: str, windows: Windows):
    def compare(texts: DataFrame, buckets: int) -> DataFrame:
        def gathered(rows: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray, int]]:
            # settle what is equal within the task, and send on the first of each
            sent, runs = _settled(rows, windows.length)
            yield repeats.send_runs(runs, buckets, PASSED)
            yield sent, _buckets(sent, buckets), FACTS

        def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = repeats.Outbox(gathered)
            for batch, facts in repeats.texts_with_facts(batches):
                yield from out.add(_windows(batch, facts, text_col, windows))
            yield from out.flush()

        def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = repeats.Outbox(lambda rows: iter([repeats.send_runs(rows, buckets, FACTS)]))
            for facts, passed in repeats.grouped_facts(batches):
                if passed:
                    yield from repeats.block_batches([(passed[1], FACTS, passed[0])])
                    continue
                rows = pa.concat_batches([repeats.from_block(b) for b in facts])
                for part in by_gram(rows):
                    yield from out.add(_runs(part, *repeated_windows(part, windows.length)))
            yield from out.flush()

        parts = buckets // repeats.BUCKETS_PER_PARTITION
        return repeats.by_bucket(texts.mapInArrow(extend, BLOCK), parts).mapInArrow(settle, BLOCK)

    return compare


def remove_repeats(docs: DataFrame, id_col: str, text_col: str, *, words: int = WORDS, seed: int = SEED_WORDS) -> DataFrame:
    """``docs`` with ``n_words``, ``n_removed``, ``spans`` (removed words, as [begin, end) word numbers) and ``kept_text``.

    Columns of ``docs`` that have one of these names are replaced.
    """
    added = [c.split()[0] for c in REMOVED.split(", ")]
    docs = docs.drop(*[c for c in docs.columns if c.lower() in added])
    given = repeats.numbered(docs)
    at = {name: given.columns[i] for i, name in enumerate(docs.columns)}
    windows = Windows(words, seed, word_hashes)
    columns, text = given.columns, at[text_col]
    result = f"{given.schema.toDDL()}, {REMOVED}"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, facts in repeats.texts_with_facts(batches):
            spans = repeats.removals_by_row(batch, facts, words)
            n_words, n_removed, listed, kept = [], [], [], []
            for i, own in enumerate(batch.column(text).to_pylist()):
                parts = (own or "").encode().split()
                n_words.append(len(parts))
                gone = spans.get(i, [])
                n_removed.append(sum(end - begin for begin, end in gone))
                listed.append([{"begin": begin, "end": end} for begin, end in gone])
                if gone:
                    mask = np.ones(len(parts), dtype=bool)
                    for begin, end in gone:
                        mask[begin:end] = False
                    parts = compress(parts, mask.tolist())
                kept.append(b" ".join(parts).decode())
            spans_type = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in columns),
                    pa.array(n_words, pa.int64()),
                    pa.array(n_removed, pa.int64()),
                    pa.array(listed, spans_type),
                    pa.array(kept, pa.string()),
                ],
                names=[*columns, *added],
            )

    keyed = repeats.keyed(given, at[id_col], text)
    return repeats.plan(keyed, text, windows, _compare(text, windows), cut, result).toDF(*docs.columns, *added)


def removed_sql(table: str = "documents", words: int = WORDS) -> str:
    """The digest of the query over ``remove_repeats`` for DuckDB."""
    return rf"""
    WITH split AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM {table}),
    placed AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS pos FROM split),
    runs AS (
        SELECT doc_id, pos, string_agg(word, ' ') OVER f AS run, count(*) OVER f AS n
        FROM placed WINDOW f AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND {words - 1} FOLLOWING)
    ),
    ranked AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY run ORDER BY doc_id, pos) AS r FROM runs WHERE n = {words}),
    marked AS (
        SELECT doc_id, word, p.pos, max(CASE WHEN r > 1 THEN 1 ELSE 0 END) OVER (
            PARTITION BY doc_id ORDER BY p.pos ROWS BETWEEN {words - 1} PRECEDING AND CURRENT ROW) AS gone
        FROM placed p LEFT JOIN ranked USING (doc_id, pos)
    ),
    kept AS (
        SELECT doc_id, count(*) AS n_words, sum(gone) AS n_removed,
            coalesce(string_agg(word, ' ' ORDER BY pos) FILTER (gone = 0), '') AS text
        FROM marked GROUP BY doc_id
    )
    SELECT d.doc_id, coalesce(n_words, 0) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
        sha256(coalesce(k.text, '')) AS kept_sha256
    FROM {table} d LEFT JOIN kept k USING (doc_id)
    """
