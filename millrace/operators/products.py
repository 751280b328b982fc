"""The largest inner products of very many vectors with very many others, exactly.

The others are written down in order of their length, the longest first. The product of two vectors is at most that of
their lengths, so a vector reads the others only as far as one of them may still be among its best. Vectors stay where
they are dealt; a task reads the files of the others in the shared folder, a part at a time. Nothing of either side goes
through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import inf

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import FloatType, IntegerType, StructField, StructType

from millrace.workspace import new_folder

# products held at a time, others read at a time, and products of a task
PRODUCTS = 2_000_000
OTHERS_AT_A_TIME = 2048
PRODUCTS_PER_TASK = 20_000_000_000
# rounding of a product, relative to both lengths
SLACK = 1e-9


def _matrix(vectors: pa.Array) -> np.ndarray:
    """The rows of a list column without nulls, all of one length."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(vectors), -1)


def _exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products row by row, added up in the order of the values."""
    total = np.zeros(len(a))
    for i in range(a.shape[1]):
        total += a[:, i] * b[:, i]
    return total


def _lengths(vectors: np.ndarray) -> np.ndarray:
    return np.sqrt(_exact(vectors, vectors))


def _parts(uri: str) -> Iterator[tuple[float, Iterator[pa.RecordBatch]]]:
    """The files of the others, those with the longest first: the length of the longest, and the file in parts."""
    fs, folder = pafs.FileSystem.from_uri(uri)
    found = []
    for info in fs.get_file_info(pafs.FileSelector(folder)):
        if info.path.endswith(".parquet"):
            with fs.open_input_file(info.path) as file:
                about = pq.ParquetFile(file).metadata
            at = next(i for i in range(about.num_columns) if about.schema.column(i).path == "length")
            known = [about.row_group(i).column(at).statistics for i in range(about.num_row_groups)]
            found.append((max((s.max if s and s.has_min_max else inf for s in known), default=-inf), info.path))

    def read(path: str) -> Iterator[pa.RecordBatch]:
        with fs.open_input_file(path) as file:
            yield from pq.ParquetFile(file).iter_batches(OTHERS_AT_A_TIME)

    for longest, path in sorted(found, reverse=True):
        yield longest, read(path)


class Best:
    """The largest products of some vectors so far: for each vector up to ``k``, equal ones by the smaller number."""

    def __init__(self, vectors: np.ndarray, k: int) -> None:
        self.vectors, self.k = vectors, k
        self.lengths = _lengths(vectors)
        self.worst = np.full(len(vectors), -inf)
        # of all that is kept: the vector, the product, the other's number, and where its key is
        self.row, self.number, self.key = (np.zeros(0, np.int64) for _ in range(3))
        self.product = np.zeros(0)
        self.keys: list[pa.Array] = []

    def open(self, longest: float) -> np.ndarray:
        """The vectors for which an other of this length may count. A bound that is no number rules out nothing."""
        return np.flatnonzero(~(self.lengths * longest * (1 + SLACK) < self.worst))

    def add(self, rows: np.ndarray, others: np.ndarray, numbers: np.ndarray, keys: pa.Array) -> None:
        if not len(rows) or not len(others):
            return
        found = []
        lengths = _lengths(others)
        step = max(1, PRODUCTS // max(1, len(others)))
        for lo in range(0, len(rows), step):
            mine = rows[lo : lo + step]
            rough = self.vectors[mine] @ others.T
            off = SLACK * self.lengths[mine] * lengths.max()
            least = self.worst[mine]
            if len(others) > self.k and (least == -inf).any():
                least = np.maximum(least, np.partition(rough, -self.k, axis=1)[:, -self.k])
            at, of = np.nonzero(rough >= (least - 2 * off)[:, None])
            found.append((mine[at], of, _exact(self.vectors[mine[at]], others[of])))
        row, of, product = (np.concatenate(x) for x in zip(*found))
        if not len(row):
            return
        used, place = np.unique(of, return_inverse=True)
        base = sum(map(len, self.keys))
        self.keys.append(keys.take(pa.array(used)))
        self.row, self.product = np.r_[self.row, row], np.r_[self.product, product]
        self.number, self.key = np.r_[self.number, numbers[of]], np.r_[self.key, base + place]
        self._cut()

    def _cut(self) -> None:
        """Keep the first ``k`` of each vector, in order."""
        order = np.lexsort((self.number, -self.product, self.row))
        order = order[self._places(self.row[order]) < self.k]
        self.row, self.product, self.number, self.key = (x[order] for x in (self.row, self.product, self.number, self.key))
        places = self._places(self.row)
        last = places == self.k - 1
        self.worst[self.row[last]] = self.product[last]
        used, self.key = np.unique(self.key, return_inverse=True)
        self.keys = [pa.concat_arrays(self.keys).take(pa.array(used))]

    @staticmethod
    def _places(row: np.ndarray) -> np.ndarray:
        heads = np.flatnonzero(np.r_[True, row[1:] != row[:-1]]) if len(row) else np.zeros(0, np.int64)
        return np.arange(len(row)) - np.repeat(heads, np.diff(np.r_[heads, len(row)]))

    def listed(self) -> tuple[np.ndarray, pa.Array | None, np.ndarray, np.ndarray]:
        """Of each vector in order: the vector, the other's key, the product and its place from 1 on."""
        keys = self.keys[0].take(pa.array(self.key)) if self.keys else None
        return self.row, keys, self.product, self._places(self.row) + 1


def largest_products(df: DataFrame, vector: str, others: DataFrame, key: str, other_vector: str, number: str, k: int) -> DataFrame:
    """The rows of ``df`` without ``vector``, once for each of the ``k`` others with the largest product.

    They have the other's ``key``, the ``product`` as a float and its ``place`` from 1 on. ``number`` is a whole number of
    the others; equal products go to the smaller one. All vectors are lists of one length without nulls. Where there
    are fewer than ``k`` others all of them count.
    """
    ranked = others.select(F.col(key).alias("key"), F.col(number).cast("bigint").alias("number"), F.col(other_vector).alias("other"))
    square = F.aggregate("other", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    ranked = ranked.withColumn("length", F.sqrt(square))
    order = [F.desc("length"), F.asc("number")]
    folder = new_folder(df.sparkSession, "products")
    ranked.repartitionByRange(*order).sortWithinPartitions(*order).write.parquet(folder)
    kept = [f for f in df.schema.fields if f.name != vector]
    names = [f.name for f in kept]
    added = [StructField(key, others.schema[key].dataType), StructField("product", FloatType()), StructField("place", IntegerType())]

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            found = Best(_matrix(batch.column(vector)), k)
            for longest, parts in _parts(folder):
                if not len(found.open(longest)):
                    break
                for part in parts:
                    rows = found.open(part.column("length")[0].as_py())
                    if not len(rows):
                        break
                    found.add(rows, _matrix(part.column("other")), part.column("number").to_numpy(), part.column("key"))
            row, keys, product, place = found.listed()
            if keys is not None:
                own = [batch.column(n).take(pa.array(row)) for n in names]
                more = [keys, pa.array(product.astype(np.float32)), pa.array(place.astype(np.int32))]
                yield pa.RecordBatch.from_arrays([*own, *more], names=[*names, key, "product", "place"])

    n, m = df.count(), df.sparkSession.read.parquet(folder).count()
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-n * m // PRODUCTS_PER_TASK))
    return df.repartition(tasks).mapInArrow(best, StructType([*kept, *added]))
