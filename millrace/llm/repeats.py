"""What finding repeats in words and in bytes has in common: seeds, candidates, and texts dealt by document.

A text is a sequence of units (words or bytes). A window is ``length`` consecutive units of one document. Of
all ``seed``-unit grams in a window the one with the smallest hash is the window's anchor, so equal windows
have equal anchors at equal places, and each anchor answers for a run of neighbouring windows
(winnowing). Only anchors that occur more than once can have repeated windows.

The work is four shuffles of one plan, with nothing collected and no table written:

1. anchors are dealt by hash; those that occur twice become candidates;
2. candidates and texts are dealt by document; the candidates' windows are taken from the texts;
3. windows are dealt by anchor and compared; repeated ones become removals;
4. removals and texts are dealt by document, and the texts are cut.

Rows travel as blocks: what one Arrow batch has for one bucket, as a compressed Arrow table. Before a block
is sent, equal anchors or windows of its batch are settled among themselves and one of them is sent on, so
a passage in any share of all documents is at most one row for each batch in any task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm.ranges import shuffle_partitions
from millrace.llm.words import U64, mix, powers, prefix_sums, slices

BUCKETS_PER_PARTITION = 2
# a task gathers so many bytes for all buckets before it sends them as blocks
GATHERED_BYTES = 16_000_000
BLOCK = "bucket int, kind int, block binary"
BLOCK_SCHEMA = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("block", pa.binary())])
# kinds of blocks; within a bucket they come in this order
FACTS, TEXTS, PASSED = 0, 1, 2
_IPC = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 1))
# working columns
DOC, TIE = "_doc", "_tie"


def to_block(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=_IPC) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def from_block(block: bytes) -> pa.RecordBatch:
    with pa.ipc.open_stream(block) as reader:
        return reader.read_next_batch()


def deal(batch: pa.RecordBatch, buckets: np.ndarray, kind: int) -> list[tuple[int, int, bytes]]:
    """One block for each bucket that has rows; rows keep their order."""
    order = np.argsort(buckets, kind="stable")
    sorted_buckets = buckets[order]
    rows = batch.take(pa.array(order))
    cuts = np.flatnonzero(np.diff(sorted_buckets)) + 1
    return [
        (int(sorted_buckets[lo]), kind, to_block(rows.slice(lo, hi - lo)))
        for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(order)], strict=True)
        if hi > lo
    ]


def block_batches(blocks: list[tuple[int, int, bytes]], most_bytes: int = 8_000_000) -> Iterator[pa.RecordBatch]:
    first = size = 0
    for i, (_, _, data) in enumerate(blocks):
        size += len(data)
        if size >= most_bytes or i == len(blocks) - 1:
            bucket, kind, block = zip(*blocks[first : i + 1], strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket, pa.int32()), pa.array(kind, pa.int32()), pa.array(block, pa.binary())], schema=BLOCK_SCHEMA
            )
            first, size = i + 1, 0


class Outbox:
    """Gathers rows over many inputs of a task, so that blocks are few and large.

    ``settle`` turns the gathered rows into what is to be sent: tuples of rows, their buckets and their kind.
    """

    def __init__(self, settle: Callable[[pa.RecordBatch], Iterator[tuple[pa.RecordBatch, np.ndarray, int]]]) -> None:
        self.settle, self.rows, self.size = settle, [], 0

    def add(self, rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if len(rows):
            self.rows.append(rows)
            self.size += rows.nbytes
        if self.size >= GATHERED_BYTES:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            whole = pa.concat_batches(self.rows)
            self.rows, self.size = [], 0
            for rows, buckets, kind in self.settle(whole):
                if len(rows):
                    yield from block_batches(deal(rows, buckets, kind))


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, bytes]]:
    for batch in batches:
        buckets, kinds, blocks = (batch.column(i) for i in range(3))
        for i in range(len(batch)):
            yield buckets[i].as_py(), kinds[i].as_py(), blocks[i].as_py()


def by_bucket(df: DataFrame, parts: int) -> DataFrame:
    """Blocks by bucket, in an order that does not depend on when they arrive.

    What is settled in a task is settled over the blocks gathered there, so a repeated task must see them in the same order.
    """
    return df.repartitionById(parts, "bucket").sortWithinPartitions("bucket", "kind", F.xxhash64("block"))


def bucket_of_doc(doc: np.ndarray, tie: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(doc.view(U64) ^ mix(tie.view(U64))) % U64(buckets)).astype(np.int32)


def bucket_of_hash(hashes: np.ndarray, buckets: int) -> np.ndarray:
    # other bits than those that are sent when hashes are shortened
    return ((hashes >> U64(16)) % U64(buckets)).astype(np.int32)


# ---------------------------------------------------------------- documents


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with its columns renamed by number, so that no name clashes with a working column."""
    return docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` with a working key: the id (null after all others), and if ids repeat a hash of the text.

    Rows that repeat both id and text are one document that stands in several rows. Other columns must not
    have the names of the key.
    """
    ident = F.coalesce(F.col(id_col).cast("bigint"), F.lit((1 << 63) - 1))
    # one column of ids decides
    repeated = docs.groupBy(ident.alias("i")).count().where("count > 1").limit(1).count()
    tie = F.xxhash64(text_col) if repeated else F.lit(0).cast("bigint")
    return docs.select(*docs.columns, ident.alias(DOC), tie.alias(TIE))


def key_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return batch.column(DOC).to_numpy(zero_copy_only=False), batch.column(TIE).to_numpy(zero_copy_only=False)


def in_order(batch: pa.RecordBatch) -> pa.RecordBatch:
    doc, tie = key_of(batch)
    return batch.take(pa.array(np.lexsort((tie, doc))))


def text_blocks(docs: DataFrame, buckets: int) -> DataFrame:
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                yield from block_batches(deal(batch, bucket_of_doc(*key_of(batch), buckets), TEXTS))

    return docs.mapInArrow(send, BLOCK)


# ---------------------------------------------------------------- seeds


@dataclass(frozen=True)
class Windows:
    """``length`` units make a window, ``seed`` units an anchor; ``units`` turns texts into hashed units."""

    length: int
    seed: int
    units: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]

    def __post_init__(self) -> None:
        if not 0 < self.seed <= self.length:
            raise ValueError("a seed is not longer than a window")

    def anchors(self, values: np.ndarray, first: np.ndarray) -> Anchors:
        """The anchors of texts whose units are ``values``, text ``i`` from ``first[i]`` to ``first[i + 1]``."""
        n, k, w = len(values), self.seed, self.length - self.seed + 1
        if n < self.length:
            nothing = np.zeros(0, np.int64)
            return Anchors(nothing, nothing, nothing, nothing, np.zeros(0, U64))
        sums = prefix_sums(values)
        grams = mix((sums[k:] - sums[:-k]) * powers(n)[1][: n - k + 1])
        # the smallest hash of each w neighbours, the first of equals: half hash, half place
        least = (grams & U64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=U64)
        width = 1
        while width * 2 <= w:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < w:
            least = np.minimum(least[: len(least) - (w - width)], least[w - width :])
        # a window must not run on into the next text
        room = np.repeat(first[1:], np.diff(first))[: len(least)] - np.arange(len(least))
        starts = np.flatnonzero(room >= self.length)
        places = (least[starts] & U64(0xFFFFFFFF)).astype(np.int64)
        # places ascend, and neighbours of different texts have different places
        new = np.flatnonzero(np.diff(places, prepend=-1))
        last = np.append(new[1:], len(places)) - 1
        at = places[new]
        text = np.searchsorted(first, at, "right") - 1
        return Anchors(text, at, starts[new], starts[last] if len(new) else starts[:0], grams[at])


@dataclass
class Anchors:
    """Text, place, first and last window start (in the joint array of units), and the hash of each anchor."""

    text: np.ndarray
    at: np.ndarray
    low: np.ndarray
    high: np.ndarray
    hash: np.ndarray


def seed_blocks(docs: DataFrame, text_col: str, windows: Windows, buckets: int) -> DataFrame:
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            doc, tie = key_of(batch)
            texts = batch.column(text_col)
            rows, places, hashes = [], [], []
            for lo, hi in slices(texts):
                values, first = windows.units(texts.slice(lo, hi - lo))
                found = windows.anchors(values, first)
                rows.append(found.text + lo)
                places.append((found.at - first[found.text]).astype(np.uint32))
                hashes.append(found.hash)
            row, place, seed = np.concatenate(rows), np.concatenate(places), np.concatenate(hashes)
            if not len(row):
                continue
            order = np.argsort(seed, kind="stable")
            ordered = seed[order]
            starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
            count = np.diff(np.append(starts, len(ordered)))
            one = np.sort(order[starts])
            yield from block_batches(deal(_seeds(doc[row[one]], tie[row[one]], place[one], seed[one]), bucket_of_hash(seed[one], buckets), FACTS))
            # equal ones within the batch are candidates already
            many = np.sort(order[np.repeat(count > 1, count)])
            if len(many):
                d, t = doc[row[many]], tie[row[many]]
                yield from block_batches(deal(_candidates(d, t, place[many]), bucket_of_doc(d, t, buckets), PASSED))

    return docs.mapInArrow(send, BLOCK)


def _candidates(doc: np.ndarray, tie: np.ndarray, place: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"doc": doc, "tie": tie, "place": place})


def _seeds(doc: np.ndarray, tie: np.ndarray, place: np.ndarray, seed: np.ndarray) -> pa.RecordBatch:
    # 48 bits of the hash besides those of the bucket: a chance hit costs a comparison, not a wrong result
    high, low = (seed >> U64(32)).astype(np.uint32), ((seed >> U64(16)) & U64(0xFFFF)).astype(np.uint16)
    return pa.RecordBatch.from_pydict({"doc": doc, "tie": tie, "place": place, "high": high, "low": low})


def joined(blocks: list[bytes]) -> dict[str, np.ndarray]:
    table = pa.Table.from_batches([from_block(b) for b in blocks])
    return {name: table.column(name).to_numpy() for name in table.column_names}


def grouped_facts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[bytes], bytes | None]]:
    """The fact blocks of a bucket together, and passed blocks one by one."""
    bucket, facts = None, []
    for at, kind, block in rows_of(batches):
        if at != bucket and facts:
            yield facts, None
            facts = []
        bucket = at
        if kind == FACTS:
            facts.append(block)
        else:
            yield [], (block, at)
    if facts:
        yield facts, None


def candidate_blocks(seeds: DataFrame, buckets: int) -> DataFrame:
    """The anchors that more than one batch has, dealt by document."""

    def settle(rows: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray, int]]:
        yield rows, bucket_of_doc(rows.column("doc").to_numpy(), rows.column("tie").to_numpy(), buckets), FACTS

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Outbox(settle)
        for facts, passed in grouped_facts(batches):
            if passed:
                yield from block_batches([(passed[1], FACTS, passed[0])])
                continue
            x = joined(facts)
            seed = x["high"].astype(U64) << U64(16) | x["low"].astype(U64)
            order = np.argsort(seed)
            same = seed[order][1:] == seed[order][:-1]
            twice = np.zeros(len(order), dtype=bool)
            twice[1:] |= same
            twice[:-1] |= same
            picked = np.sort(order[twice])
            yield from out.add(_candidates(x["doc"][picked], x["tie"][picked], x["place"][picked]))
        yield from out.flush()

    return seeds.mapInArrow(find, BLOCK)


class Facts:
    """The facts of a bucket in the order of their documents."""

    def __init__(self, blocks: list[bytes]) -> None:
        self.columns = joined(blocks) if blocks else {}
        if blocks:
            keys = paired(self.columns["doc"], self.columns["tie"])
            order = np.argsort(keys, kind="stable")
            self.keys = keys[order]
            self.columns = {name: column[order] for name, column in self.columns.items()}

    def of(self, doc: np.ndarray, tie: np.ndarray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        """The facts of some documents, given once each and in order: the document's number, and the columns."""
        if not self.columns:
            return np.zeros(0, np.int64), {}
        wanted = paired(doc, tie)
        begin, end = np.searchsorted(self.keys, wanted, "left"), np.searchsorted(self.keys, wanted, "right")
        many = end - begin
        number = np.repeat(np.arange(len(doc)), many)
        at = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(begin, many)
        return number, {name: column[at] for name, column in self.columns.items()}


def texts_with_facts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Facts]]:
    """Every text block, in key order, with the facts of its bucket: those come first, then the texts one block at a time."""
    bucket, blocks, ready = None, [], None
    for at, kind, block in rows_of(batches):
        if at != bucket:
            bucket, blocks, ready = at, [], None
        if kind == FACTS:
            blocks.append(block)
            continue
        if ready is None:
            ready = Facts(blocks)
        yield in_order(from_block(block)), ready


def distinct_documents(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Id and tie of the documents of a block in key order, and the first row of each."""
    doc, tie = key_of(batch)
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (tie[1:] != tie[:-1])
    rows = np.flatnonzero(new)
    return doc[rows], tie[rows], rows


def paired(doc: np.ndarray, tie: np.ndarray) -> np.ndarray:
    """Keys as one sortable value each: big-endian bytes of the id and the tie, with the signs turned."""
    top = U64(1 << 63)
    both = np.empty((len(doc), 2), dtype=">u8")
    both[:, 0], both[:, 1] = doc.view(U64) ^ top, tie.view(U64) ^ top
    return np.ascontiguousarray(both).view("S16").ravel() if len(doc) else np.zeros(0, "S16")


def runs_of(doc: np.ndarray, tie: np.ndarray, start: np.ndarray) -> pa.RecordBatch:
    """Removed window starts as runs: neighbouring starts of a document become one row."""
    order = np.lexsort((start, tie, doc))
    doc, tie, start = doc[order], tie[order], start[order].astype(np.int64)
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (tie[1:] != tie[:-1]) | (start[1:] > start[:-1] + 1)
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(doc)) - 1
    return pa.RecordBatch.from_pydict({"doc": doc[at], "tie": tie[at], "start": start[at], "stop": start[last] if len(at) else start[:0]})


def send_runs(rows: pa.RecordBatch, buckets: int, kind: int) -> tuple[pa.RecordBatch, np.ndarray, int]:
    return rows, bucket_of_doc(rows.column("doc").to_numpy(), rows.column("tie").to_numpy(), buckets), kind


def covered_spans(starts: np.ndarray, stops: np.ndarray, length: int) -> list[tuple[int, int]]:
    """The units that windows from ``starts`` to ``stops`` cover, as ascending disjoint [begin, end) spans."""
    spans: list[list[int]] = []
    for i in np.argsort(starts, kind="stable").tolist():
        begin, end = int(starts[i]), int(stops[i]) + length
        if spans and begin <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], end)
        else:
            spans.append([begin, end])
    return [tuple(s) for s in spans]


def removals_by_row(batch: pa.RecordBatch, facts: Facts, length: int) -> dict[int, list[tuple[int, int]]]:
    """Row number of ``batch`` (in key order) to the spans to be removed; rows that repeat a document share them."""
    doc, tie, rows = distinct_documents(batch)
    number, x = facts.of(doc, tie)
    ends = np.append(rows[1:], len(batch))
    out = {}
    for part in np.split(np.arange(len(number)), np.flatnonzero(np.diff(number)) + 1):
        if len(part):
            spans = covered_spans(x["start"][part], x["stop"][part], length)
            of = number[part[0]]
            out |= dict.fromkeys(range(int(rows[of]), int(ends[of])), spans)
    return out


def plan(
    docs: DataFrame,
    text_col: str,
    windows: Windows,
    compare: Callable[[DataFrame, int], DataFrame],
    cut: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    result: str,
) -> DataFrame:
    """Seeds, candidates, ``compare`` (texts with candidates to blocks of runs), and ``cut`` (texts with runs)."""
    parts = shuffle_partitions(docs)
    buckets = parts * BUCKETS_PER_PARTITION
    only = docs.select(DOC, TIE, text_col)
    candidates = candidate_blocks(by_bucket(seed_blocks(only, text_col, windows, buckets), parts), buckets)
    runs = compare(by_bucket(candidates.unionByName(text_blocks(only, buckets)), parts), buckets)
    return by_bucket(runs.unionByName(text_blocks(docs, buckets)), parts).mapInArrow(cut, result)
