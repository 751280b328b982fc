"""Words, shingles and their hashes for whole Arrow batches, as numpy arrays.

A word is a run of bytes other than space and ``\\t \\n \\v \\f \\r`` (``[^\\x20\\x09-\\x0D]+``), taken from the UTF-8
form of a text. Hashes are 64-bit polynomials over a table of mixed byte values, finished by a
bijective mix; two hashes of independent keys are used wherever a single one could be too few bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
# rows are worked on in slices of about so many bytes, whatever the size of the Arrow batch
SLICE_BYTES = 2_000_000
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_STEP = U64(0xD1342543DE82EF95)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit over all output bits."""
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    return x ^ (x >> U64(32))


def _is_space() -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[[0x20, *range(0x09, 0x0E)]] = True
    return table


def _is_mark() -> np.ndarray:
    """All of ASCII but letters and digits; the bytes of other characters count as letters."""
    table = np.zeros(256, dtype=bool)
    table[:128] = [not chr(b).isalnum() for b in range(128)]
    return table


IS_SPACE = _is_space()
IS_MARK = _is_mark()
_VALUES = mix(np.arange(1, 257, dtype=U64) * _STEP)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


# the powers of the base and of its inverse for the positions asked for so far
_POWERS = [np.ones(1, dtype=U64), np.ones(1, dtype=U64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers 0, 1, ... of the base and of its inverse for ``n`` positions at least."""
    for i, base in enumerate((_BASE, _BASE_INVERSE)):
        while len(_POWERS[i]) < n:
            known = _POWERS[i]
            _POWERS[i] = np.concatenate([known, known * U64(pow(base, len(known), 1 << 64))])
    return _POWERS[0], _POWERS[1]


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Polynomial prefix hashes of ``values``; entry ``i`` covers the values before ``i``."""
    out = np.zeros(len(values) + 1, dtype=U64)
    np.cumsum(values * powers(len(values) + 1)[0][: len(values)], out=out[1:])
    return out


def range_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the values from ``start`` to ``end``; equal sequences have equal hashes wherever they stand."""
    return mix((sums[end] - sums[start]) * powers(len(sums))[1][start] + (end - start).astype(U64) * _STEP)


def byte_values(data: np.ndarray) -> np.ndarray:
    return _VALUES[data]


def as_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in one array, and where each text begins (and the last ends). Null is empty."""
    binary = texts.cast(pa.large_string()).fill_null("").cast(pa.large_binary())
    offsets = np.frombuffer(binary.buffers()[1], dtype=np.int64)[binary.offset : binary.offset + len(binary) + 1]
    if not len(offsets):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    data = binary.buffers()[2]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def counted(counts: np.ndarray) -> np.ndarray:
    """The numbers from zero up to each count, one after the other."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def folded(texts: pa.Array) -> pa.Array:
    """Texts in lower case, so that a text and its upper-case form are the same (whose ``SS`` may stand for ``ß``)."""
    return pc.replace_substring(pc.utf8_lower(texts.cast(pa.large_string())), "ß", "ss")


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts have about ``limit`` bytes; a longer text is a range of its own."""
    _, offsets = as_bytes(texts)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        yield first, min(last, len(texts))
        first = last
    # an idle worker need not keep what a batch took
    pa.default_memory_pool().release_unused()


def word_bounds(data: np.ndarray, offsets: np.ndarray, between: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the number of the first word of each text (and of the end).

    ``between`` marks the bytes that stand between words.
    """
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = ~between[data]
    body = inside[1:-1]
    first = body & ~inside[:-2]
    last = body & ~inside[2:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    # a word never runs on into the next text
    first[cuts] = body[cuts]
    last[cuts - 1] = body[cuts - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def hash_ranges(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """A hash for each of the ascending, disjoint byte ranges."""
    out = np.empty(len(starts), dtype=U64)
    first = 0
    while first < len(starts):
        last = max(first + 1, int(np.searchsorted(ends, starts[first] + SLICE_BYTES, "right")))
        base = starts[first]
        part = data[base : ends[last - 1]]
        sums = prefix_sums(_VALUES[_LOWER[part] if lower else part])
        out[first:last] = range_hash(sums, starts[first:last] - base, ends[first:last] - base)
        first = last
    return out


def word_hashes(
    texts: pa.Array, lower: bool = False, between: np.ndarray = IS_SPACE
) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word of all texts in order, and the number of each text's first word (and of the end)."""
    data, offsets = as_bytes(texts)
    starts, ends, first = word_bounds(data, offsets, between)
    return hash_ranges(data, starts, ends, lower), first


def shingle_hashes(words: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each run of ``k`` words and the text it is from, in order.

    A text with fewer words has its whole sequence as one shingle; a text without words has none.
    """
    counts = np.diff(first)
    n = len(words)
    text_of = np.repeat(np.arange(len(counts)), counts)
    left = np.repeat(first[1:], counts) - np.arange(n)
    total = np.zeros(n, dtype=U64)
    factor = 1
    for j in range(min(k, n)):
        here = words[j:] * U64(factor)
        # words past the end of the text do not count; this also makes the short sequences
        total[: n - j] += np.where(left[: n - j] > j, here, U64(0))
        factor = factor * _BASE % (1 << 64)
    kept = (left >= k) | (np.arange(n) == np.repeat(first[:-1], counts))
    length = np.minimum(left, k).astype(U64)
    return mix(total + length * _STEP)[kept], text_of[kept]
