"""Byte-level BPE: encoding by tree concatenation, and decoding.

A text is first split by character classes (letters, numbers, other marks, white space), and the bytes of each
part are merged by rank. A part that nothing splits may be as long as the text. It is cut into halves, and these into
halves, down to leaves that are merged side by side. Neighbours are then put together level by level: the tokens
around a join are encoded again in a window that grows on the sides where its outermost token is not the one
already there. Where both agree, every pair of neighbouring tokens stands in some encoding as it is, and a
sequence of which that holds is the encoding of its bytes.

Long texts are cut in the same way into pieces for different tasks. Their joins settle the split first: what
follows a place where two splits agree is split alike, since a part never depends on what stands before it.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType, StructField, StructType
from tokenizers import pre_tokenizers

from millrace.llm.ranges import shuffle_partitions
from millrace.llm.words import counted, slices

# longest bytes merged as one, tokens on each side of a join to begin with, and the parts a worker remembers
LEAF_BYTES = 64
WINDOW = 4
REMEMBERED = 1 << 17
# texts beyond so many code points are encoded in pieces; bytes of short texts and tokens worked on at a time
PIECE_CHARS = 1 << 16
WORK_BYTES = 500_000

LETTER, NUMBER, OTHER, SPACE, UNASSIGNED = range(5)
# fixed values: white space, and what follows an apostrophe that begins a part
_SPACES = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
_AFTER_APOSTROPHE = ["s", "t", "re", "ve", "m", "ll", "d"]


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """The class of every code point, as far as this Python's Unicode has it."""
    kinds = {"L": LETTER, "N": NUMBER}
    found = (unicodedata.category(chr(c)) for c in range(0x110000))
    table = np.fromiter((UNASSIGNED if x == "Cn" else kinds.get(x[0], OTHER) for x in found), np.uint8, 0x110000)
    table[_SPACES] = SPACE
    return table


def _classes_of(points: np.ndarray) -> np.ndarray:
    """The class of each code point. The library may know a later Unicode, so it is asked for those not assigned here."""
    table = _classes()
    kind = table[points]
    new = points[kind == UNASSIGNED]
    if not len(new):
        return kind
    joins = pre_tokenizers.ByteLevel(add_prefix_space=False).pre_tokenize_str
    for point in np.unique(new).tolist():
        table[point] = LETTER if len(joins("a" + chr(point))) == 1 else NUMBER if len(joins("1" + chr(point))) == 1 else OTHER
    return table[points]


def part_starts(points: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Where the parts of texts begin; ``points`` are the code points of all texts, ``cuts`` the texts' first places.

    Letters, numbers and other marks each go together, with one blank before them. Of several white spaces the last
    one is left over for what follows them. An apostrophe and certain letters are a part of their own.
    """
    n = len(points)
    if not n:
        return np.zeros(0, np.int64)
    kind = _classes_of(points)
    edge = np.zeros(n + 1, bool)
    edge[cuts] = edge[0] = edge[n] = True
    start = edge.copy()
    start[1:n] |= kind[1:] != kind[:-1]
    space, blank = kind == SPACE, points == 0x20
    # a white space that is followed by something else in its text: a blank belongs to that
    last = np.flatnonzero(space[:-1] & ~space[1:] & ~edge[1:n])
    start[last] = True
    start[last[blank[last]] + 1] = False
    marks = np.flatnonzero(points == ord("'"))
    marks = marks[start[marks]]
    for tail in _AFTER_APOSTROPHE:
        m = len(tail)
        at = marks[marks + m < n]
        fits = np.ones(len(at), bool)
        for i, letter in enumerate(tail, 1):
            fits &= (points[at + i] == ord(letter)) & ~edge[at + i]
        at = at[fits]
        start[at + 1] = False
        start[at + m + 1] = True
    return np.flatnonzero(start[:n])


class Vocabulary:
    """Tokens, ranks of merges and special tokens of a byte-level BPE file of the ``tokenizers`` library."""

    def __init__(self, path: str, specials: bool = True) -> None:
        with open(path, encoding="utf-8") as file:
            given = json.load(file)
        model, splitter = given["model"], given["pre_tokenizer"]
        options = ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
        if model["type"] != "BPE" or splitter["type"] != "ByteLevel" or given["normalizer"] or any(model.get(x) for x in options):
            raise ValueError(f"{path} is not a plain byte-level BPE file")
        if splitter["add_prefix_space"] or not splitter["use_regex"]:
            raise ValueError(f"{path} splits texts in another way")
        added = given["added_tokens"]
        if any(x["single_word"] or x["lstrip"] or x["rstrip"] for x in added):
            raise ValueError(f"{path} has special tokens that take in their surroundings")
        # every byte is written as a character: the visible ones as they are, the others in order from 256 on
        seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        hidden = [b for b in range(256) if b not in set(seen)]
        byte_of = {chr(b): b for b in seen} | {chr(256 + i): b for i, b in enumerate(hidden)}
        vocab = model["vocab"]
        self.bytes_of: dict[int, bytes] = {i: bytes(byte_of[c] for c in token) for token, i in vocab.items()}
        self.specials = {x["content"]: x["id"] for x in added if specials}
        self.bytes_of |= {x["id"]: x["content"].encode() for x in added}
        self.first = np.zeros(256, np.int64)
        for char, b in byte_of.items():
            self.first[b] = vocab[char]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.size = max(self.bytes_of) + 1
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order
        self.product = np.array([vocab[a + b] for a, b in pairs], np.int64)
        lengths = np.array([len(self.bytes_of.get(i, b"")) for i in range(self.size)], np.int64)
        self.lengths = lengths
        self.offsets = np.cumsum(lengths) - lengths
        self.data = np.frombuffer(b"".join(self.bytes_of.get(i, b"") for i in range(self.size)), np.uint8)
        self.margin = max([0, *map(len, self.specials)]) + 3
        self._forget()

    def _forget(self) -> None:
        self._known: dict[bytes, int] = {}
        self._lengths, self._ids = np.zeros(0, np.int64), np.zeros(0, np.int64)

    # ------------------------------------------------------------ merging

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        want = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
        return np.where(self.keys[at] == want, self.ranks[at], len(self.keys))

    def merged(self, pieces: list[bytes]) -> list[np.ndarray]:
        """The tokens of each piece."""
        counts, ids = self._merge(pieces)
        return np.split(ids, np.cumsum(counts)[:-1])

    def _merge(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The number of tokens of each piece, and all tokens; all pieces merge at a time, each by its lowest rank."""
        symbols = self.first[np.frombuffer(b"".join(pieces), np.uint8)]
        owner = np.repeat(np.arange(len(pieces)), [len(p) for p in pieces])
        done = [(owner[:0], symbols[:0])]
        none = len(self.keys)

        def ranks(at: np.ndarray) -> np.ndarray:
            """The rank of each symbol in ``at`` with the one after it."""
            after = np.minimum(at + 1, len(symbols) - 1)
            inner = (after > at) & (owner[after] == owner[at])
            out = np.full(len(at), none)
            out[inner] = self._rank(symbols[at[inner]], symbols[after[inner]])
            return out

        rank = ranks(np.arange(len(symbols)))
        while len(symbols):
            heads = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            lowest = np.repeat(np.minimum.reduceat(rank, heads), np.diff(np.r_[heads, len(symbols)]))
            ended = lowest == none
            if ended.any():
                done.append((owner[ended], symbols[ended]))
                symbols, owner, rank, lowest = (x[~ended] for x in (symbols, owner, rank, lowest))
            hits = np.flatnonzero(rank == lowest)
            if not len(hits):
                break
            # in a run of hits (a a a ...) every other one counts, from the left
            runs = np.flatnonzero(np.r_[True, np.diff(hits) > 1])
            hits = hits[counted(np.diff(np.r_[runs, len(hits)])) % 2 == 0]
            symbols[hits] = self.product[rank[hits]]
            kept = np.ones(len(symbols), bool)
            kept[hits + 1] = False
            symbols, owner, rank = symbols[kept], owner[kept], rank[kept]
            # only the new symbols have new neighbours
            new = hits - np.arange(len(hits))
            changed = np.r_[new, new[new > 0] - 1]
            rank[changed] = ranks(changed)
        owners, ids = (np.concatenate(x) for x in zip(*done))
        return np.bincount(owners, minlength=len(pieces)), ids[np.argsort(owners, kind="stable")]

    def joined(self, pairs: list[tuple[np.ndarray, np.ndarray]]) -> list[np.ndarray]:
        """The encoding of each two neighbours, whose own encodings are given."""
        out: list[np.ndarray] = [pair[0] for pair in pairs]
        reach = {i: (WINDOW, WINDOW) for i in range(len(pairs))}
        while reach:
            windows = {i: (pairs[i][0][-a:], pairs[i][1][:b]) for i, (a, b) in reach.items()}
            coded = self.merged([self.text_of(np.concatenate(w)) for w in windows.values()])
            for (i, (left, right)), middle in zip(windows.items(), coded, strict=True):
                (whole_left, whole_right), (a, b) = pairs[i], reach[i]
                left_agrees = len(left) == len(whole_left) or middle[0] == left[0]
                right_agrees = len(right) == len(whole_right) or middle[-1] == right[-1]
                if left_agrees and right_agrees:
                    out[i] = np.concatenate([whole_left[: len(whole_left) - len(left)], middle, whole_right[len(right) :]])
                    del reach[i]
                else:
                    reach[i] = (a if left_agrees else 2 * a, b if right_agrees else 2 * b)
        return out

    def tree(self, data: bytes) -> np.ndarray:
        """The tokens of bytes that are one part, of any length."""
        leaves = 1
        while len(data) > leaves * LEAF_BYTES:
            leaves *= 2
        cuts = [len(data) * i // leaves for i in range(leaves + 1)]
        parts = self.merged([data[a:b] for a, b in zip(cuts, cuts[1:])])
        while len(parts) > 1:
            parts = self.joined(list(zip(parts[::2], parts[1::2])))
        return parts[0]

    # ------------------------------------------------------------ texts

    def text_of(self, ids: np.ndarray) -> bytes:
        """The bytes of tokens; numbers that are no token have none."""
        ids = np.asarray(ids, np.int64)
        ids = ids[(ids >= 0) & (ids < self.size)]
        lengths = self.lengths[ids]
        return self.data[np.repeat(self.offsets[ids], lengths) + counted(lengths)].tobytes()

    def _tokens_of(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The number of tokens of each part, and all tokens in order."""
        if len(self._known) > REMEMBERED:
            self._forget()
        new = list({p for p in parts if p not in self._known})
        short = [p for p in new if len(p) <= LEAF_BYTES]
        long = [p for p in new if len(p) > LEAF_BYTES]
        counts, short_ids = self._merge(short)
        coded = [self.tree(p) for p in long]
        known = len(self._lengths)
        self._known |= {p: known + i for i, p in enumerate(short)}
        passing = {p: known + len(short) + i for i, p in enumerate(long)}
        lengths = np.concatenate([self._lengths, counts, np.array([len(c) for c in coded], np.int64)])
        ids = np.concatenate([self._ids, short_ids, *coded])
        # what is remembered are the short parts only
        kept = known + len(short)
        self._lengths, self._ids = lengths[:kept], ids[: int(lengths[:kept].sum())]
        if long:
            at = np.array([passing[p] if len(p) > LEAF_BYTES else self._known[p] for p in parts], np.int64)
        else:
            at = np.fromiter(map(self._known.__getitem__, parts), np.int64, len(parts))
        counts, first = lengths[at], (np.cumsum(lengths) - lengths)[at]
        return counts, ids[np.repeat(first, counts) + counted(counts)]

    def split(self, texts: list[str]) -> tuple[list[int], np.ndarray, np.ndarray, np.ndarray]:
        """All texts in parts: the parts of each text, each part's first code point, its first byte, its special id or -1.

        The two arrays of places run over all texts together and have the end as their last entry.
        """
        whole = "".join(texts)
        points = np.frombuffer(whole.encode("utf-32-le"), np.uint32).astype(np.int64)
        ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
        firsts = np.r_[0, ends[:-1]].astype(np.int64)
        found = []
        for token, number in self.specials.items():
            for i, text in enumerate(texts):
                at = text.find(token)
                while at >= 0:
                    found.append((int(firsts[i]) + at, len(token), number))
                    at = text.find(token, at + len(token))
        edges = [x for at, m, _ in found for x in (at, at + m)]
        cuts = np.array(sorted({*firsts.tolist(), *edges} - {len(points)}), np.int64)
        starts = part_starts(points, cuts)
        special = np.full(len(starts), -1)
        if found:
            # a special token is one part, whatever stands in it
            inside = np.zeros(len(starts), bool)
            for at, m, number in found:
                lo, hi = np.searchsorted(starts, [at, at + m])
                inside[lo + 1 : hi] = True
                special[lo] = number
            starts, special = starts[~inside], special[~inside]
        width = 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)
        places = np.r_[starts, len(points)]
        counts = np.diff(np.searchsorted(starts, np.r_[firsts, len(points)])).tolist()
        return counts, places, np.r_[0, np.cumsum(width)][places], special

    def encoded(self, texts: list[str]) -> tuple[list[int], np.ndarray, np.ndarray, np.ndarray]:
        """Parts of each text, first code point of each part (and the end), tokens of each part, all tokens."""
        counts, places, byte_places, special = self.split(texts)
        data = "".join(texts).encode()
        bounds = byte_places.tolist()
        parts = [data[a:b] for a, b in zip(bounds, bounds[1:])]
        plain = special < 0
        if plain.all():
            sizes, ids = self._tokens_of(parts)
            return counts, places, sizes, ids
        sizes = np.ones(len(parts), np.int64)
        sizes[plain], coded = self._tokens_of([p for p, ok in zip(parts, plain) if ok])
        ids = np.empty(int(sizes.sum()), np.int64)
        of_special = np.repeat(~plain, sizes)
        ids[of_special], ids[~of_special] = special[~plain], coded
        return counts, places, sizes, ids


@lru_cache(maxsize=4)
def vocabulary(path: str, specials: bool = True) -> Vocabulary:
    return Vocabulary(path, specials)


class Piece:
    """A piece of a text: its parts, the tokens of each part, and all tokens."""

    def __init__(self, text: str, starts: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> None:
        self.text, self.starts, self.sizes, self.ids = text, starts, sizes, ids
        self.ends = np.r_[starts[1:], len(text)]
        self.tokens = np.r_[0, np.cumsum(sizes)]

    def beside(self, other: Piece, words: Vocabulary) -> Piece:
        """This piece and the one after it as one piece."""
        cut = len(self.text)
        kept = int(np.searchsorted(self.ends, cut - words.margin, "right"))
        begin = int(self.starts[kept]) if kept < len(self.starts) else cut
        here, reach = cut - begin, 8
        while True:
            end = int(other.starts[reach]) if reach < len(other.starts) else len(other.text)
            window = self.text[begin:] + other.text[:end]
            places = words.split([window])[1]
            if end == len(other.text):
                agreed = len(window)
                break
            sure = places[(places >= here) & (places <= len(window) - words.margin)]
            common = sure[np.isin(sure - here, other.starts)]
            if len(common):
                agreed = int(common[0])
                break
            reach *= 2
        starts = places[places < agreed]
        bounds = [*starts.tolist(), agreed]
        sizes, ids = [], []
        for a, b in zip(bounds, bounds[1:]):
            if a < here < b and b - a > LEAF_BYTES and a + begin == self.starts[-1] and b - here == other.ends[0]:
                # nothing splits the text at the join: put both encodings together
                coded = words.joined([(self.ids[self.tokens[-2] :], other.ids[: other.tokens[1]])])[0]
            else:
                coded = words.encoded([window[a:b]])[3]
            sizes.append(len(coded))
            ids.append(coded)
        later = int(np.searchsorted(other.starts, agreed - here))
        return Piece(
            self.text + other.text,
            np.concatenate([self.starts[:kept], starts + begin, other.starts[later:] + cut]),
            np.concatenate([self.sizes[:kept], np.array(sizes, np.int64), other.sizes[later:]]),
            np.concatenate([self.ids[: self.tokens[kept]], *ids, other.ids[other.tokens[later] :]]),
        )


def _binary(offsets: np.ndarray, values: np.ndarray) -> pa.Array:
    """Values from offset to offset as binary cells."""
    ends = offsets.astype(np.int64) * values.itemsize
    return pa.Array.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(values.tobytes())])


def encode(
    docs: DataFrame, id_col: str, text_col: str, path: str, *, specials: bool = True, piece_chars: int = PIECE_CHARS
) -> DataFrame:
    """``doc_id`` and ``ids`` (binary: the tokens as little-endian unsigned 32-bit numbers) of every row.

    The tokens are those of the ``tokenizers`` library without added special tokens; the strings of special tokens in a
    text are encoded as these if ``specials``. ``path`` names the vocabulary's file on every executor.

    Defined results: a null or empty text has no tokens; null and repeated ids and repeated rows stay, one row each;
    other columns of ``docs`` do not matter. Texts beyond ``piece_chars`` code points are encoded in pieces that are
    dealt over tasks; only those texts are shuffled. The result does not depend on ``piece_chars``.
    """
    parts = shuffle_partitions(docs)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    long = F.char_length("text") > piece_chars

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path, specials)
        for batch in batches:
            for lo, hi in slices(batch.column("text"), WORK_BYTES):
                part = batch.slice(lo, hi - lo)
                counts, _, sizes, ids = words.encoded(part.column("text").to_pylist())
                tokens = np.r_[0, np.cumsum(sizes)][np.r_[0, np.cumsum(counts)]]
                cells = _binary(tokens, ids.astype("<u4")).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), cells], names=["doc_id", "ids"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                text, n = batch.column("text")[i].as_py(), 2
                while len(text) > n * piece_chars:
                    n *= 2
                cuts = [len(text) * j // n for j in range(n + 1)]
                keys = [batch.column(c).slice(i, 1).take(pa.array([0] * n)) for c in ("doc_id", "key")]
                pieces = [text[a:b] for a, b in zip(cuts, cuts[1:])]
                yield pa.RecordBatch.from_arrays([*keys, pa.array(range(n), pa.int32()), pa.array(pieces)], names=["doc_id", "key", "piece", "text"])

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path, specials)
        for batch in batches:
            for lo, hi in slices(batch.column("text"), WORK_BYTES):
                part = batch.slice(lo, hi - lo)
                texts = part.column("text").to_pylist()
                counts, places, sizes, ids = words.encoded(texts)
                first = np.r_[0, np.cumsum(counts)]
                begin = np.repeat(np.r_[0, np.cumsum([len(t) for t in texts])][:-1], counts)
                tokens = np.r_[0, np.cumsum(sizes)][first]
                cells = [_binary(first, (places[:-1] - begin).astype("<i8")), _binary(first, sizes.astype("<i8")), _binary(tokens, ids.astype("<u4"))]
                yield pa.RecordBatch.from_arrays([*part.columns, *(c.cast(pa.binary()) for c in cells)], names=[*part.schema.names, "starts", "sizes", "ids"])

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path, specials)
        ordered = (row for batch in batches for row in _rows(batch))
        for (key, doc_id), group in groupby(ordered, lambda r: (r["key"], r["doc_id"])):
            pieces: list[Piece] = []
            copies, last = 0, -1
            for row in group:
                copies += row["piece"] == 0
                if row["piece"] != last:
                    last = row["piece"]
                    starts, sizes, ids = (np.frombuffer(row[c], t).astype(np.int64) for c, t in (("starts", "<i8"), ("sizes", "<i8"), ("ids", "<u4")))
                    pieces.append(Piece(row["text"], starts, sizes, ids))
            while len(pieces) > 1:
                pieces = [a.beside(b, words) for a, b in zip(pieces[::2], pieces[1::2], strict=True)]
            cell = pieces[0].ids.astype("<u4").tobytes()
            for _ in range(copies):
                yield pa.RecordBatch.from_arrays([pa.array([doc_id], batch_type), pa.array([cell], pa.binary())], names=["doc_id", "ids"])

    batch_type = _arrow_type(id_type)
    short_ids = rows.where(~long).mapInArrow(whole, f"doc_id {id_type}, ids binary")
    pieces = rows.where(long).withColumn("key", F.sha2("text", 256)).mapInArrow(cut, f"doc_id {id_type}, key string, piece int, text string")
    # every piece goes to a task of its own choice, then all pieces of a text meet
    coded = pieces.repartition(parts, "key", "piece").mapInArrow(leaves, f"{_ddl(pieces)}, starts binary, sizes binary, ids binary")
    met = coded.repartition(parts, "key", "doc_id").sortWithinPartitions("key", "doc_id", "piece")
    return short_ids.unionByName(met.mapInArrow(together, f"doc_id {id_type}, ids binary"))


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)


def _arrow_type(name: str) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[name]


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    for i in range(len(batch)):
        yield {name: batch.column(name)[i].as_py() for name in batch.schema.names}


def decode(encoded: DataFrame, path: str, ids_col: str = "ids", name: str = "decoded") -> DataFrame:
    """``encoded`` with the text of its tokens in the new column ``name``; null tokens give a null text.

    Numbers that are no token are left out. Bytes that are not UTF-8 become U+FFFD, as in the library.
    """

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        for batch in batches:
            # cells of any sizes: as many rows as hold about so many bytes
            rows = max(1, len(batch) * WORK_BYTES // (batch.column(ids_col).nbytes + 1))
            for lo in range(0, len(batch), rows):
                part = batch.slice(lo, rows)
                cells = (c.as_py() for c in part.column(ids_col))
                text = [None if c is None else words.text_of(np.frombuffer(c, "<u4")).decode("utf-8", "replace") for c in cells]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(text, pa.string())], names=[*part.schema.names, name])

    return encoded.mapInArrow(texts, StructType([*encoded.schema.fields, StructField(name, StringType())]))
