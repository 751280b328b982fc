"""Document fingerprints: one-permutation MinHash.

All shingles of a text are hashed once. The upper part of a hash picks one of ``bins`` bins, the rest
is the value, and each bin keeps its smallest value. An empty bin takes over the value of the first
non-empty bin in a probe order of its own that is the same for all texts (optimal densification). Of
every bin the lowest ``bits`` bits are stored, packed and written in hexadecimal.

Two bins of unlike texts agree by accident once in ``2**bits``; ``likeness`` corrects for that.

Defined results: null text counts as empty. A text with fewer words than a shingle is one shingle of
all its words. Texts without words have a fingerprint of zeros; they are wholly alike among each other
and not at all like any other text. Equal texts have equal fingerprints. Repeated rows and repeated
ids are kept, each row with its own result. Input columns other than those named are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm.ranges import range_of, range_starts, shuffle_partitions
from millrace.llm.words import U64, mix, shingle_hashes, slices, word_hashes

SHINGLE_WORDS = 5
BINS = 512
BITS = 4

_EMPTY = np.iinfo(np.uint64).max


@cache
def _probe_order(bins: int) -> np.ndarray:
    """For each bin a pseudo-random order of all bins, row by row; a bin's own place does no harm."""
    cells = np.arange(bins * bins, dtype=U64).reshape(bins, bins)
    return np.argsort(mix(cells + U64(0x632BE59BD9B4E019)), axis=1).astype(np.int32)


def _minima(texts: pa.Array, k: int, bins: int) -> tuple[np.ndarray, np.ndarray]:
    words, first = word_hashes(texts, lower=True)
    hashes, text_of = shingle_hashes(words, first, k)
    table = np.full(len(texts) * bins, _EMPTY, dtype=U64)
    shift = U64(64 - (bins.bit_length() - 1))
    cell = text_of * bins + (hashes >> shift).astype(np.int64)
    np.minimum.at(table, cell, hashes & U64((1 << int(shift)) - 1))
    return table.reshape(len(texts), bins), np.diff(first) > 0


def _densify(table: np.ndarray, has_words: np.ndarray) -> np.ndarray:
    bins = table.shape[1]
    order = _probe_order(bins)
    full = table != _EMPTY
    rows, empty = np.nonzero(~full & has_words[:, None])
    out = table.copy()
    for attempt in range(bins):
        if not len(rows):
            break
        found = order[empty, attempt]
        hit = full[rows, found]
        out[rows[hit], empty[hit]] = table[rows[hit], found[hit]]
        rows, empty = rows[~hit], empty[~hit]
    return out


def codes(texts: pa.Array, k: int = SHINGLE_WORDS, bins: int = BINS, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """The stored bits of each text, one row of ``bins`` small numbers, and whether the text has words."""
    if bins & (bins - 1) or bits not in (1, 2, 4, 8):
        raise ValueError("bins is a power of two and bits one of 1, 2, 4, 8")
    table, has_words = _minima(texts, k, bins)
    # mixed with the bin, so that a value that fills many bins agrees by chance in each of them on its own
    salt = mix(np.arange(1, bins + 1, dtype=U64))
    low = (mix(_densify(table, has_words) ^ salt) & U64((1 << bits) - 1)).astype(np.uint8)
    low[~has_words] = 0
    return low, has_words


def packed(low: np.ndarray, bits: int = BITS) -> list[str]:
    per_byte = 8 // bits
    parts = low.reshape(len(low), -1, per_byte)
    weights = np.array([1 << (bits * (per_byte - 1 - i)) for i in range(per_byte)], dtype=np.uint16)
    joined = (parts.astype(np.uint16) * weights).sum(axis=2).astype(np.uint8)
    return [row.tobytes().hex() for row in joined]


def likeness(a: np.ndarray, b: np.ndarray, a_words: np.ndarray, b_words: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Estimated Jaccard similarity of each pair of rows, without the agreements that chance makes."""
    chance = 2.0**-bits
    agree = (a == b).mean(axis=1)
    out = np.clip((agree - chance) / (1 - chance), 0, 1)
    return np.where(a_words != b_words, 0.0, out)


def with_fingerprint(
    df: DataFrame, text_col: str, name: str = "fingerprint", *, k: int = SHINGLE_WORDS, bins: int = BINS, bits: int = BITS
) -> DataFrame:
    """``df`` with the fingerprint of ``text_col`` in the new column ``name``."""

    @F.pandas_udf("string")
    def fingerprint(texts):
        array, out = pa.Array.from_pandas(texts, type=pa.string()), []
        for lo, hi in slices(array):
            out += packed(codes(array.slice(lo, hi - lo), k, bins, bits)[0], bits)
        return type(texts)(out, index=texts.index, dtype=object)

    return df.withColumn(name, fingerprint(F.col(text_col)))


_DEALT = "bucket int, tail boolean, missing int, down bigint, tie bigint, id bigint, text string"
_RESULT = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def edited_pairs(
    docs: DataFrame, id_col: str, text_col: str, *, k: int = SHINGLE_WORDS, bins: int = BINS, bits: int = BITS
) -> DataFrame:
    """Fingerprints of every text and of its edited form, and their likeness.

    Documents stand in descending order of id (null ids last, equal ids by a hash of the text), and after
    the last comes the first. A text's edited form has its last half, rounded down, replaced by as many
    first characters of the next document's text, or by all it has.

    The order is cut into key ranges; each task walks its ranges and sees the first row of the next one.
    Texts are shuffled once. An empty table gives an empty result; a single document follows itself.
    """
    ident, text = docs[id_col].cast("bigint"), F.coalesce(docs[text_col], F.lit(""))
    keys = ["missing", "down", "tie"]
    keyed = docs.select(
        ident.isNull().cast("int").alias("missing"),
        F.bitwise_not(F.coalesce(ident, F.lit(0).cast("bigint"))).alias("down"),
        F.xxhash64(text).alias("tie"),
        ident.alias("id"),
        text.alias("text"),
    )
    parts = shuffle_partitions(docs)
    starts = range_starts(keyed, keys, parts)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head_of = {key: i for i, key in enumerate(starts)}
        for batch in batches:
            rows = list(zip(*(batch.column(c).to_pylist() for c in keys), strict=True))
            heads = [i for i, key in enumerate(rows) if key in head_of]
            buckets = [range_of(starts, key) for key in rows]
            # the first row of a range also ends the range before it, the very first one the last
            again = [(head_of[rows[i]] - 1) % len(starts) for i in heads]
            picked = batch.take(pa.array([*range(len(rows)), *heads], type=pa.int64()))
            tail = pa.array([False] * len(rows) + [True] * len(heads))
            yield pa.RecordBatch.from_arrays(
                [pa.array(buckets + again, type=pa.int32()), tail, *picked.columns],
                names=["bucket", "tail", *picked.schema.names],
            )

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried: pa.RecordBatch | None = None
        for batch in batches:
            first = 0
            for lo, hi in slices(batch.column("text")):
                part = batch.slice(lo, hi - lo)
                rows = pa.concat_batches([carried, part]) if carried is not None else part
                carried = rows.slice(len(rows) - 1)
                if len(rows) > 1:
                    yield from compare(rows)
                first = hi
            assert first == len(batch)

    def compare(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts, tail, buckets = (rows.column(c).to_pylist() for c in ("text", "tail", "bucket"))
        emit = [i for i in range(len(texts) - 1) if not tail[i]]
        if not emit:
            return
        assert all(buckets[i] == buckets[i + 1] for i in emit)
        edited, own = [], rows.column("text")
        for i in emit:
            half = len(texts[i]) // 2
            edited.append(texts[i][: len(texts[i]) - half] + texts[i + 1][:half])
        at = np.array(emit)
        low, words = codes(own, k, bins, bits)
        changed, changed_words = codes(pa.array(edited, type=pa.large_string()), k, bins, bits)
        yield pa.RecordBatch.from_arrays(
            [
                rows.column("id").take(pa.array(emit)),
                pa.array([len(texts[i]) for i in emit], type=pa.int64()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited]),
                pa.array(packed(low[at], bits)),
                pa.array(packed(changed, bits)),
                pa.array(likeness(low[at], changed, words[at], changed_words, bits)),
                pa.array(likeness(low[at], low[at + 1], words[at], words[at + 1], bits)),
            ],
            names=[c.split()[0] for c in _RESULT.split(", ")],
        )

    dealt = keyed.mapInArrow(deal, _DEALT).repartitionById(parts, "bucket")
    ordered = dealt.sortWithinPartitions("bucket", "tail", *keys)
    return ordered.select("bucket", "tail", "id", "text").mapInArrow(walk, _RESULT)
