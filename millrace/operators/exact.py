"""Sums of doubles that are exact, and statistics that come from them: the same bits for any layout of the rows.

Adding doubles rounds at each step, so a plain sum depends on how rows are dealt over tasks. Here each value is cut into
four whole numbers of 20 bits, at places of a fixed grid of powers of two that its exponent gives. Whole numbers of one
place add up exactly and in any order, on the map side too, so a group is at most 104 rows whatever its size. Their total
is one exact number, and results are rounded once, from it: by Python's integers, for one small row of a group.

Nulls are no values. A NaN, or infinities of both signs, make a total NaN; infinities of one sign make it infinite. A group
without values has nulls, and without keys an empty table has one row of them. Products are kept with their rounding error,
so squares and products are exact too, as long as factors stay below 2^996 and products above 2^-969. A sum ends with an
error above 2^43 rows of one group.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Mapping, Sequence
from itertools import pairwise

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

_BITS = 20
# places of the grid that a finite double can begin at; 2^(20 * 51) and its inverse are both normal doubles
_TOP, _BOTTOM = 51, -51
_PIECES = 4
# totals are whole multiples of 2^-_SCALE
_SCALE = _BITS * (_PIECES - 1 - _BOTTOM)
_NAN, _PLUS, _MINUS = 1000, 1001, 1002
# splits a double into halves of 26 bits
_HALVES = 134217729.0


def _place(x: Column) -> Column:
    """Where the pieces of a double begin on the grid; a number of its own for each value that is not finite."""
    place = F.floor(F.log2(F.abs(x)) / _BITS).cast("int")
    place = F.greatest(F.lit(_BOTTOM), F.least(F.lit(_TOP), F.coalesce(place, F.lit(0))))
    infinity = F.lit(math.inf)
    odd = F.when(F.isnan(x), F.lit(_NAN)).when(x == infinity, F.lit(_PLUS)).when(x == -infinity, F.lit(_MINUS))
    return F.coalesce(odd, place)


def _pieces(x: Column, place: Column) -> list[Column]:
    """The whole-number pieces of a double, of which each counts 2^20 times the next one."""
    # powers of two and products with them are exact
    scaled = F.when(place < _NAN, x * F.pow(F.lit(2.0), (place * -_BITS).cast("double"))).otherwise(F.lit(0.0))
    # rounded at each place of the grid, the last time without loss; neighbours differ by 2^19 at most, exactly
    rounded = [F.rint(scaled * float(1 << _BITS * k)) for k in range(_PIECES)]
    whole = [rounded[0], *[b - a * float(1 << _BITS) for a, b in pairwise(rounded)]]
    return [w.cast("bigint") for w in whole]


def _halves(x: Column) -> tuple[Column, Column]:
    high = x * _HALVES - (x * _HALVES - x)
    return high, x - high


def with_error(product: Column, a: Column, b: Column) -> Column:
    """The rounding error of the product of two doubles: together they are the exact product."""
    (a1, a2), (b1, b2) = _halves(a), _halves(b)
    error = ((a1 * b1 - product) + a1 * b2 + a2 * b1) + a2 * b2
    return F.when(F.abs(error) < math.inf, error).otherwise(F.lit(0.0))


def grid_sums(df: DataFrame, keys: Sequence[str], terms: Sequence[tuple[Column, Column | None]]) -> DataFrame:
    """The keys and ``_sums``: for each term and place of the grid the number of values and the sums of pieces.

    A term is a column, with None, or the product of two.
    """
    given = [
        F.struct(F.lit(i).alias("i"), a.cast("double").alias("a"), (F.lit(1.0) if b is None else b.cast("double")).alias("b"))
        for i, (a, b) in enumerate(terms)
    ]
    term = df.select(*keys, F.explode(F.array(*given)).alias("_t")).select(*keys, F.col("_t.i").alias("_term"), F.col("_t.a").alias("_a"), F.col("_t.b").alias("_b"))
    product = term.where("_a is not null and _b is not null").withColumn("_x", F.col("_a") * F.col("_b"))
    both = product.select(*keys, "_term", "_x", with_error(F.col("_x"), F.col("_a"), F.col("_b")).alias("_error"))
    addends = both.select(*keys, "_term", F.posexplode(F.array("_x", "_error")).alias("_rank", "_x")).where("_rank = 0 or _x <> 0")
    placed = addends.withColumn("_place", _place(F.col("_x")))
    cut = placed.select(*keys, "_term", "_rank", "_place", *[p.alias(f"_p{k}") for k, p in enumerate(_pieces(F.col("_x"), F.col("_place")))])
    # null instead of a sum that does not fit
    sums = [F.try_sum(f"_p{k}").alias(f"_p{k}") for k in range(_PIECES)]
    summed = cut.groupBy(*keys, "_term", "_place").agg(F.count_if(F.col("_rank") == 0).alias("_n"), *sums)
    row = F.struct("_term", "_place", "_n", F.array(*[F.col(f"_p{k}") for k in range(_PIECES)]).alias("_pieces"))
    return summed.groupBy(*keys).agg(F.collect_list(row).alias("_sums"))


class Total:
    """An exact total: ``whole`` times 2^-_SCALE, of ``n`` values; ``odd`` is its value where it is not finite."""

    def __init__(self) -> None:
        self.whole, self.n, self.odd = 0, 0, None

    def add(self, place: int, n: int, pieces: list[int | None]) -> None:
        self.n += n
        if place >= _NAN:
            value = {_NAN: math.nan, _PLUS: math.inf, _MINUS: -math.inf}[place]
            # infinities of both signs add up to NaN
            self.odd = value if self.odd is None else self.odd + value
            return
        for k, piece in enumerate(pieces):
            if piece is None:
                raise OverflowError("an exact sum has more rows than its pieces can count")
            self.whole += piece << (_SCALE + _BITS * (place - k))


def divided(a: int, b: int) -> float:
    """The double next to a quotient of whole numbers, infinite where none is near."""
    try:
        return a / b
    except OverflowError:
        return math.copysign(math.inf, a) * (1 if b > 0 else -1)


def from_totals(sums: DataFrame, terms: int, names: Mapping[str, type], compute: Callable[[list[Total]], list[tuple]]) -> DataFrame:
    """The keys and ``names`` for each row that ``compute`` makes of the totals of a group."""
    kept = [f for f in sums.schema.fields if f.name != "_sums"]
    kinds = {str: (StringType(), pa.string()), int: (LongType(), pa.int64()), float: (DoubleType(), pa.float64())}
    schema = StructType([*kept, *[StructField(name, kinds[kind][0]) for name, kind in names.items()]])
    keys = [f.name for f in kept]

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            group, rows = [], []
            for i, entries in enumerate(batch.column("_sums").to_pylist()):
                totals = [Total() for _ in range(terms)]
                for entry in entries:
                    totals[entry["_term"]].add(entry["_place"], entry["_n"], entry["_pieces"])
                found = compute(totals)
                group += [i] * len(found)
                rows += found
            columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
            at = pa.array(group, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(k).take(at) for k in keys], *[pa.array(c, kinds[kind][1]) for c, kind in zip(columns, names.values(), strict=True)]],
                names=[*keys, *names],
            )

    return sums.mapInArrow(finish, schema)


def _sum(total: Total) -> float | None:
    return None if not total.n else divided(total.whole, 1 << _SCALE) if total.odd is None else total.odd


def _scatter(n: int, product: Total, x: Total, y: Total) -> int:
    """n * sum of products - product of sums, in units of 2^(-2 * _SCALE)."""
    return (n * product.whole << _SCALE) - x.whole * y.whole


def exact_sums(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Number of values, their exact sum rounded once, and their mean rounded once, per key (no keys: of all rows)."""

    def compute(totals: list[Total]) -> list[tuple]:
        (t,) = totals
        mean = None if not t.n else t.odd if t.odd is not None else divided(t.whole, t.n << _SCALE)
        return [(t.n, _sum(t), mean)]

    return from_totals(grid_sums(df, keys, [(F.col(value), None)]), 1, {"n": int, "total": float, "mean": float}, compute)


def exact_mean_and_deviation(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """One row per column: its mean and sample standard deviation (null below two values)."""
    terms = [term for c in cols for term in ((F.col(c), None), (F.col(c), F.col(c)))]

    def compute(totals: list[Total]) -> list[tuple]:
        out = []
        for name, x, xx in zip(cols, totals[::2], totals[1::2], strict=True):
            if not x.n or x.odd is not None or xx.odd is not None:
                odd = math.nan if x.n else None
                out.append((name, odd if x.odd is None else x.odd, odd if x.n > 1 else None))
                continue
            variance = divided(_scatter(x.n, xx, x, x), x.n * (x.n - 1) << 2 * _SCALE) if x.n > 1 else None
            out.append((name, divided(x.whole, x.n << _SCALE), None if variance is None else math.sqrt(max(variance, 0.0))))
        return out

    return from_totals(grid_sums(df, keys, terms), len(terms), {"name": str, "mean": float, "deviation": float}, compute)


def _paired(left: str, right: str) -> list[tuple[Column, Column | None]]:
    """Both columns and their products, over the rows that have both."""
    x = F.when(F.col(right).isNotNull(), F.col(left))
    y = F.when(F.col(left).isNotNull(), F.col(right))
    return [(x, None), (y, None), (x, y), (x, x), (y, y)]


def exact_correlations(df: DataFrame, target: str, cols: Sequence[str]) -> DataFrame:
    """Correlation of ``target`` with each column; null where either never varies, NaN where a value is not finite."""
    terms = [term for c in cols for term in _paired(target, c)]

    def compute(totals: list[Total]) -> list[tuple]:
        out = []
        for i, name in enumerate(cols):
            x, y, xy, xx, yy = own = totals[5 * i : 5 * i + 5]
            if any(t.odd is not None for t in own):
                out.append((name, math.nan))
                continue
            both = math.isqrt(max(_scatter(x.n, xx, x, x), 0) * max(_scatter(x.n, yy, y, y), 0))
            out.append((name, divided(_scatter(x.n, xy, x, y), both) if both else None))
        return out

    return from_totals(grid_sums(df, [], terms), len(terms), {"name": str, "correlation": float}, compute)


def exact_covariances(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Sample covariance of each pair of columns, the upper triangle with the diagonal."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    terms = [term for a, b in pairs for term in _paired(a, b)[:3]]

    def compute(totals: list[Total]) -> list[tuple]:
        out = []
        for i, (a, b) in enumerate(pairs):
            x, y, xy = own = totals[3 * i : 3 * i + 3]
            odd = any(t.odd is not None for t in own)
            value = None if x.n < 2 else math.nan if odd else divided(_scatter(x.n, xy, x, y), x.n * (x.n - 1) << 2 * _SCALE)
            out.append((a, b, value))
        return out

    return from_totals(grid_sums(df, [], terms), len(terms), {"left": str, "right": str, "covariance": float}, compute)
