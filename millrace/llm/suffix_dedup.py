"""Suffix-array dedup of bytes: hash-compared suffix sort.

Suffixes are sorted where it matters: at winnowed anchors that occur more than once (see ``repeats``), dealt
by the anchor's hash, so that equal strings meet in one bucket. Each bucket builds prefix polynomial hashes
over the text around its anchors. Two suffixes are compared by a binary search for their longest
common extension, so a comparison inside a mergesort takes a logarithmic number of hash comparisons; the
same sort backwards gives the common extensions to the left. Common extensions of neighbours are then
verified byte by byte. A mismatch, which means that hashes collided, repeats the bucket with another hash.

From the sorted order, strings of ``length`` bytes are equal if their parts to the right of the anchor share a
run of the suffix order, and those to its left a run of the backward order.

A byte is removed if a string of ``length`` bytes that covers it also starts in a document with a smaller
id. Strings do not cross documents; overlaps count; strings are judged on the texts as given.

Defined results: null text is empty. Texts shorter than ``length`` lose nothing. Null ids come after all
others. Rows that repeat an id are ordered by a hash of their text; rows that repeat the text as well are
one document and lose the same bytes. What is left of a text need not be valid UTF-8, so it stays binary.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.llm import repeats
from millrace.llm.repeats import BLOCK, FACTS, PASSED, Windows
from millrace.llm.words import SLICE_BYTES, U64, as_bytes, byte_values, counted, mix, powers, prefix_sums

LENGTH = 50
SEED_BYTES = 16

REMOVED = "n_bytes bigint, n_removed bigint, n_spans bigint, spans array<struct<begin:bigint,end:bigint>>, kept binary"


def byte_units(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, first = as_bytes(texts)
    return byte_values(data), first


# ---------------------------------------------------------------- the sort


def salted_sums(data: np.ndarray, salt: int) -> np.ndarray:
    """Prefix polynomial hashes of the bytes; each salt makes another hash."""
    return prefix_sums(byte_values(data) ^ mix(np.array([salt], U64))) if salt else prefix_sums(byte_values(data))


class Suffixes:
    """Suffixes of one buffer of bytes, each from an anchor up to a limit, to the right or to the left."""

    def __init__(self, data: np.ndarray, sums: np.ndarray, anchor: np.ndarray, reach: np.ndarray, leftwards: bool) -> None:
        self.data, self.sums, self.anchor, self.reach, self.leftwards = data, sums, anchor, reach, leftwards
        self.inverse = powers(len(self.sums))[1]

    def _hash(self, i: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Hash of the first ``n`` bytes of the suffixes ``i``."""
        begin = self.anchor[i] - n if self.leftwards else self.anchor[i]
        return (self.sums[begin + n] - self.sums[begin]) * self.inverse[begin]

    def _byte(self, i: np.ndarray, n: np.ndarray) -> np.ndarray:
        return self.data[self.anchor[i] - 1 - n if self.leftwards else self.anchor[i] + n]

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """The lengths of the common extensions, by binary search over prefix hashes."""
        low, high = np.zeros(len(i), np.int64), np.minimum(self.reach[i], self.reach[j])
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                return low
            middle = (low[open_] + high[open_] + 1) // 2
            same = self._hash(i[open_], middle) == self._hash(j[open_], middle)
            low[open_] = np.where(same, middle, low[open_])
            high[open_] = np.where(same, high[open_], middle - 1)

    def less(self, i: np.ndarray, j: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        """Whether suffix ``i`` comes before ``j``; equal ones count where ``or_equal`` says so."""
        n = self.common(i, j)
        ends_i, ends_j = n == self.reach[i], n == self.reach[j]
        out = ends_i & (~ends_j | or_equal)
        inner = np.flatnonzero(~ends_i & ~ends_j)
        out[inner] = self._byte(i[inner], n[inner]) < self._byte(j[inner], n[inner])
        return out

    def sort(self, group: np.ndarray) -> np.ndarray:
        """The suffixes in order within each group (ascending numbers): a mergesort of all groups side by side.

        A round merges neighbouring runs of a group. An element's place in the merged run is its place in
        its own run plus its rank in the other, found by binary search; no round loops over elements.
        """
        order = np.argsort(group, kind="stable")
        begin = np.flatnonzero(np.concatenate([[True], np.diff(group[order]) != 0]))
        size = np.diff(np.append(begin, len(order)))
        of = np.repeat(np.arange(len(begin)), size)
        first, total = begin[of], size[of]
        width = 1
        while len(size) and width < size.max():
            moving = np.flatnonzero(total > width)
            place = moving - first[moving]
            run = place // width
            right = run % 2 == 1
            other = np.where(right, run - 1, run + 1) * width
            low = np.minimum(other, total[moving])
            high = np.minimum(other + width, total[moving])
            base, mine = low.copy(), order[moving]
            while True:
                open_ = np.flatnonzero(low < high)
                if not len(open_):
                    break
                middle = (low[open_] + high[open_]) // 2
                theirs = order[first[moving][open_] + middle]
                # equal elements keep their order: those of the left run first
                before = self.less(theirs, mine[open_], right[open_])
                low[open_] = np.where(before, middle + 1, low[open_])
                high[open_] = np.where(before, high[open_], middle)
            pair = run // 2 * 2 * width
            target = first[moving] + pair + (place - run * width) + (low - base)
            merged = order.copy()
            merged[target] = mine
            order = merged
            width *= 2
        return order

    def verified(self, i: np.ndarray, j: np.ndarray, n: np.ndarray) -> bool:
        """Whether the first ``n`` bytes of each pair are equal indeed."""
        if not n.sum():
            return True
        pair = np.repeat(np.arange(len(n)), n)
        at = np.arange(len(pair)) - np.repeat(np.cumsum(n) - n, n)
        return bool((self._byte(i[pair], at) == self._byte(j[pair], at)).all())


def extension_order(suffixes: Suffixes, group: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """The sorted suffixes, and each one's common extension with the one before it (0 for the first of a group).

    None if bytes and hashes disagree.
    """
    order = suffixes.sort(group)
    common = np.zeros(len(order), np.int64)
    inner = np.flatnonzero(np.diff(group[order]) == 0) + 1
    common[inner] = suffixes.common(order[inner - 1], order[inner])
    return (order, common) if suffixes.verified(order[inner - 1], order[inner], common[inner]) else None


def _run_numbers(order: np.ndarray, common: np.ndarray, depth: int) -> np.ndarray:
    """For each suffix the number of its run of the order in which neighbours share ``depth`` bytes."""
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(common < depth)
    return out


# ---------------------------------------------------------------- one bucket


def earlier_strings(x: dict[str, np.ndarray], segments: pa.Array, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The strings of ``length`` bytes that also start in an earlier document: segment and start within it.

    ``x`` has for each segment of text around an anchor its document (``doc``, ``tie``), the offset ``off`` of the
    anchor in it, and the anchor's ``seed``. All strings of a segment contain the anchor's first byte.
    """
    rank = np.unique(repeats.paired(x["doc"], x["tie"]), return_inverse=True)[1].astype(np.int64)
    data, begin = as_binary(segments)
    off = x["off"].astype(np.int64)
    whole = np.diff(begin)
    salt = 0
    while True:
        # equal segments are one class; its first document speaks for it
        sums = salted_sums(data, salt)
        digest = mix((sums[begin[1:]] - sums[begin[:-1]]) * powers(len(sums))[1][begin[:-1]]) + whole.astype(U64)
        order = np.lexsort((rank, off, digest, x["seed"]))
        new = np.ones(len(order), dtype=bool)
        a, b = order[1:], order[:-1]
        new[1:] = (x["seed"][a] != x["seed"][b]) | (digest[a] != digest[b]) | (off[a] != off[b]) | (whole[a] != whole[b])
        head = order[new]
        class_of = np.empty(len(order), np.int64)
        class_of[order] = np.cumsum(new) - 1
        same = np.flatnonzero(~new)
        spans = Suffixes(data, sums, begin[:-1], whole, False)
        fine = spans.verified(order[same], head[class_of[order[same]]], whole[order[same]])
        anchor = (begin[:-1] + off)[head]
        left, right = off[head], (whole - off)[head]
        group = np.unique(x["seed"][head], return_inverse=True)[1]
        # a class alone at its anchor has nothing to be compared with
        shared = np.flatnonzero(np.bincount(group)[group] > 1) if len(group) else np.zeros(0, np.int64)
        group, anchor, left, right = group[shared], anchor[shared], left[shared], right[shared]
        if fine:
            onward = extension_order(Suffixes(data, sums, anchor, right, False), group)
            backward = extension_order(Suffixes(data, sums, anchor, left, True), group)
            if onward and backward:
                break
        salt += 1
    first = rank[head]
    # all strings of a segment are earlier ones if its class has an earlier document
    late = np.flatnonzero(rank > first[class_of])
    found_segment, found_start = [np.repeat(late, (whole - length + 1)[late])], [counted((whole - length + 1)[late])]
    # the other members: those that stand for their class
    member = np.flatnonzero(rank == first[class_of])
    slot = np.full(len(head), -1, np.int64)
    slot[shared] = np.arange(len(shared))
    mine = first[shared]
    members = member[slot[class_of[member]] >= 0]
    member_slot = slot[class_of[members]]
    for reach in range(int(left.max(initial=-1)) + 1):
        depth = length - reach
        here = np.flatnonzero((left >= reach) & (right >= depth))
        if len(here) < 2:
            continue
        # runs of both orders lie within an anchor's group, so the pair of numbers is one string
        key = _run_numbers(*onward, depth)[here] * (len(shared) + 1) + _run_numbers(*backward, reach)[here]
        by = np.lexsort((mine[here], key))
        start = np.flatnonzero(np.concatenate([[True], np.diff(key[by]) != 0]))
        least = np.empty(len(by), np.int64)
        least[by] = np.repeat(mine[here][by][start], np.diff(np.append(start, len(by))))
        earlier = np.zeros(len(shared), dtype=bool)
        earlier[here] = least < mine[here]
        hit = members[earlier[member_slot]]
        found_segment.append(hit)
        found_start.append(off[hit] - reach)
    return np.concatenate(found_segment), np.concatenate(found_start)


def as_binary(segments: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    array = segments.cast(pa.large_binary())
    begin = np.frombuffer(array.buffers()[1], np.int64)[array.offset : array.offset + len(array) + 1]
    data = np.frombuffer(array.buffers()[2], np.uint8)[begin[0] : begin[-1]]
    return data, begin - begin[0]


_SEGMENT = pa.schema(
    [("doc", pa.int64()), ("tie", pa.int64()), ("start", pa.uint32()), ("off", pa.uint32()), ("seed", pa.uint64()), ("segment", pa.large_binary())]
)


def _segments(batch: pa.RecordBatch, facts: repeats.Facts, text_col: str, windows: Windows) -> pa.RecordBatch:
    """The text around the candidate anchors of a block: all the strings that an anchor answers for."""
    doc, tie, rows = repeats.distinct_documents(batch)
    number, x = facts.of(doc, tie)
    if not len(number):
        return pa.RecordBatch.from_pylist([], _SEGMENT)
    used, text = np.unique(number, return_inverse=True)
    data, first = as_bytes(batch.column(text_col).take(pa.array(rows[used])))
    found = windows.anchors(byte_values(data), first)
    keep = np.isin(found.at, np.unique(first[text] + x["place"].astype(np.int64)))
    low, end = found.low[keep], found.high[keep] + windows.length
    size = end - low
    offsets = np.concatenate([[0], np.cumsum(size)])
    joined = data[np.repeat(low - offsets[:-1], size) + np.arange(offsets[-1])]
    segments = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(size), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(joined)]
    )
    of = found.text[keep]
    columns = {
        "doc": doc[used][of],
        "tie": tie[used][of],
        "start": (low - first[of]).astype(np.uint32),
        "off": (found.at[keep] - low).astype(np.uint32),
        "seed": found.hash[keep],
        "segment": segments,
    }
    return pa.RecordBatch.from_pydict(columns, schema=_SEGMENT)


def _columns(rows: pa.RecordBatch) -> dict[str, np.ndarray]:
    return {c: rows.column(c).to_numpy() for c in ("doc", "tie", "start", "off", "seed")}


def _by_seed(rows: pa.RecordBatch, seed: int) -> Iterator[pa.RecordBatch]:
    """The rows with their ``seed`` again, in parts of about ``SLICE_BYTES`` of text that keep equal seeds together."""
    data, begin = as_binary(rows.column("segment"))
    at = begin[:-1] + rows.column("off").to_numpy()
    key = np.zeros(len(at), U64)
    for i in range(0, seed, 8):
        word = np.zeros(len(at), U64)
        for j in range(i, min(i + 8, seed)):
            word = word << U64(8) | data[at + j].astype(U64)
        key = mix(key ^ word)
    order = np.argsort(key, kind="stable")
    size = np.cumsum(np.diff(begin)[order])
    edges = np.append(np.flatnonzero(np.diff(key[order])) + 1, len(order))
    rows = rows.append_column("seed", pa.array(key))
    first = 0
    while first < len(order):
        done = size[first - 1] if first else 0
        last = edges[min(len(edges) - 1, np.searchsorted(edges, max(first + 1, np.searchsorted(size, done + SLICE_BYTES))))]
        yield rows.take(pa.array(order[first:last]))
        first = int(last)


def _runs(x: dict, segment: np.ndarray, start: np.ndarray) -> pa.RecordBatch:
    return repeats.runs_of(x["doc"][segment], x["tie"][segment], x["start"][segment].astype(np.int64) + start)


def _compare(text_col: str, windows: Windows):
    def compare(texts: DataFrame, buckets: int) -> DataFrame:
        def gathered(rows: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray, int]]:
            # equal segments within the task: the later documents' strings are removed, the first is sent on
            x, segments = _columns(rows), rows.column("segment")
            names = segments.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
            rank = np.unique(repeats.paired(x["doc"], x["tie"]), return_inverse=True)[1]
            order = np.lexsort((rank, x["off"], names))
            new = np.ones(len(order), dtype=bool)
            new[1:] = (np.diff(names[order]) != 0) | (np.diff(x["off"][order].astype(np.int64)) != 0)
            least = np.repeat(rank[order][new], np.diff(np.append(np.flatnonzero(new), len(order))))
            later = np.sort(order[rank[order] > least])
            strings = pa.compute.binary_length(segments).to_numpy()[later] - windows.length + 1
            yield repeats.send_runs(_runs(x, np.repeat(later, strings), counted(strings)), buckets, PASSED)
            sent = rows.take(pa.array(np.sort(order[rank[order] == least])))
            yield sent.drop_columns(["seed"]), repeats.bucket_of_hash(sent.column("seed").to_numpy(), buckets), FACTS

        def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = repeats.Outbox(gathered)
            for batch, facts in repeats.texts_with_facts(batches):
                yield from out.add(_segments(batch, facts, text_col, windows))
            yield from out.flush()

        def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = repeats.Outbox(lambda rows: iter([repeats.send_runs(rows, buckets, FACTS)]))
            for facts, passed in repeats.grouped_facts(batches):
                if passed:
                    yield from repeats.block_batches([(passed[1], FACTS, passed[0])])
                    continue
                rows = pa.concat_batches([repeats.from_block(b) for b in facts])
                for part in _by_seed(rows, windows.seed):
                    x = _columns(part)
                    yield from out.add(_runs(x, *earlier_strings(x, part.column("segment"), windows.length)))
            yield from out.flush()

        parts = buckets // repeats.BUCKETS_PER_PARTITION
        return repeats.by_bucket(texts.mapInArrow(extend, BLOCK), parts).mapInArrow(settle, BLOCK)

    return compare


def remove_repeats(docs: DataFrame, id_col: str, text_col: str, *, length: int = LENGTH, seed: int = SEED_BYTES) -> DataFrame:
    """``docs`` with ``n_bytes``, ``n_removed``, ``n_spans``, ``spans`` (removed bytes, as [begin, end)) and ``kept``.

    Columns of ``docs`` that have one of these names are replaced.
    """
    added = [c.split()[0] for c in REMOVED.split(", ")]
    docs = docs.drop(*[c for c in docs.columns if c.lower() in added])
    given = repeats.numbered(docs)
    at = {name: given.columns[i] for i, name in enumerate(docs.columns)}
    windows = Windows(length, seed, byte_units)
    columns, text = given.columns, at[text_col]
    result = f"{given.schema.toDDL()}, {REMOVED}"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, facts in repeats.texts_with_facts(batches):
            spans = repeats.removals_by_row(batch, facts, length)
            n_bytes, n_removed, listed, kept = [], [], [], []
            for i, own in enumerate(batch.column(text).to_pylist()):
                data, gone, at, parts = (own or "").encode(), spans.get(i, []), 0, []
                for begin, end in gone:
                    parts.append(data[at:begin])
                    at = end
                n_bytes.append(len(data))
                n_removed.append(sum(end - begin for begin, end in gone))
                listed.append([{"begin": begin, "end": end} for begin, end in gone])
                kept.append(b"".join([*parts, data[at:]]))
            spans_type = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in columns),
                    pa.array(n_bytes, pa.int64()),
                    pa.array(n_removed, pa.int64()),
                    pa.array([len(g) for g in listed], pa.int64()),
                    pa.array(listed, spans_type),
                    pa.array(kept, pa.binary()),
                ],
                names=[*columns, *added],
            )

    keyed = repeats.keyed(given, at[id_col], text)
    return repeats.plan(keyed, text, windows, _compare(text, windows), cut, result).toDF(*docs.columns, *added)
