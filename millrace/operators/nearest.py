"""The nearest of very many centres, exactly.

Some centres are pivots: about the square root of their number. Every centre belongs to the cell of its nearest pivot,
and a cell has a radius. A centre of a cell cannot be nearer to a point than the point's distance to the pivot less the
radius (triangle inequality), so a cell whose bound is above the best distance known so far stays closed. The pivots are
centres too and give the first such distance.

Cells are files in the shared folder. Points stay where they are and are read once; a task opens the cells that its
points need, a part of a cell at a time. Only the pivots and the radii go through the driver.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from millrace.workspace import materialize, new_folder

# distances held at a time, centres of a cell read at a time, and centre values that a worker keeps of opened cells
DISTANCES = 2_000_000
CENTRES_AT_A_TIME = 8192
KEPT_VALUES = 8_000_000
# the shortcut for many distances is this far off at most, relative to the squared lengths
SLACK = 1e-9


def _matrix(vectors: pa.Array) -> np.ndarray:
    """The rows of a list column without nulls, all of one length."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(vectors), -1)


def _usable(vectors: pa.Array, length: int) -> np.ndarray:
    """Which rows are lists of this length of numbers that are there."""
    lengths = pc.fill_null(pc.list_value_length(vectors), -1).to_numpy(zero_copy_only=False)
    flat = vectors.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    out = lengths == length
    out[np.repeat(np.arange(len(vectors)), np.maximum(lengths, 0))[np.isnan(flat)]] = False
    return out


def _rough(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared distances of all points to all centres, and how far they may be off for each point."""
    a, b = (points * points).sum(axis=1), (centres * centres).sum(axis=1)
    rough = a[:, None] + b[None, :] - 2 * (points @ centres.T)
    return np.maximum(rough, 0), SLACK * (a + (b.max() if len(b) else 0.0) + 1e-300)


def _exact(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of points and centres, pair by pair, added up in the order of the values."""
    total = np.zeros(len(points))
    for i in range(points.shape[1]):
        gap = points[:, i] - centres[:, i]
        total += gap * gap
    return total


class Cells:
    """The cells of one set of centres, as files and their bounds."""

    def __init__(self, path: str, pivots: np.ndarray, radii: np.ndarray) -> None:
        self.path, self.pivots, self.radii = path, pivots, radii
        self._open: OrderedDict[int, list[tuple[np.ndarray, list]]] = OrderedDict()
        self._kept = 0

    def parts(self, cell: int) -> Iterator[tuple[np.ndarray, list]]:
        """The centres of a cell and their keys, in parts; small cells are remembered."""
        if cell in self._open:
            self._open.move_to_end(cell)
            yield from self._open[cell]
            return
        fs, folder = pafs.FileSystem.from_uri(f"{self.path}/cell={cell}")
        read, size = [], 0
        for info in sorted(fs.get_file_info(pafs.FileSelector(folder)), key=lambda x: x.path):
            if not info.path.endswith(".parquet"):
                continue
            with fs.open_input_file(info.path) as file:
                for batch in pq.ParquetFile(file).iter_batches(CENTRES_AT_A_TIME, columns=["centre", "key"]):
                    part = _matrix(batch.column("centre")), batch.column("key").to_pylist()
                    size += part[0].size
                    if size <= KEPT_VALUES:
                        read.append(part)
                    else:
                        read = []
                    yield part
        if size <= KEPT_VALUES:
            self._open[cell] = read
            self._kept += size
            while self._kept > KEPT_VALUES:
                _, dropped = self._open.popitem(last=False)
                self._kept -= sum(m.size for m, _ in dropped)

    def nearest(self, points: np.ndarray) -> tuple[list, np.ndarray, int]:
        """The key of the nearest centre of each point, the distance, and how many pairs of point and cell were opened."""
        n = len(points)
        keys: list = [None] * n
        best = np.full(n, np.inf)
        rough, off = _rough(points, self.pivots)
        # the distance to a pivot from below and above
        low, high = np.sqrt(np.maximum(rough - off[:, None], 0)), np.sqrt(rough + off[:, None])
        bound = high.min(axis=1)
        floor = low - self.radii[None, :]
        opened = 0
        for cell in np.argsort(floor.min(axis=0), kind="stable").tolist():
            rows = np.flatnonzero(floor[:, cell] <= bound)
            opened += len(rows)
            if len(rows):
                for centres, names in self.parts(cell):
                    self._closer(points, rows, centres, names, best, keys)
                bound[rows] = np.minimum(bound[rows], np.sqrt(best[rows]) * (1 + SLACK))
        return keys, np.sqrt(best), opened

    @staticmethod
    def _closer(points: np.ndarray, rows: np.ndarray, centres: np.ndarray, names: list, best: np.ndarray, keys: list) -> None:
        step = max(1, DISTANCES // max(1, len(centres)))
        for lo in range(0, len(rows), step):
            mine = rows[lo : lo + step]
            rough, off = _rough(points[mine], centres)
            # those that may be nearest once they are added up exactly
            limit = np.minimum(rough.min(axis=1) + 2 * off, best[mine] + off)
            at, of = np.nonzero(rough <= limit[:, None])
            exact = _exact(points[mine[at]], centres[of])
            for row, centre, distance in zip(mine[at].tolist(), of.tolist(), exact.tolist()):
                if distance < best[row] or (distance == best[row] and names[centre] < keys[row]):
                    best[row], keys[row] = distance, names[centre]


def build_cells(centres: DataFrame, key: str, vector: str, pivots: int | None = None) -> Cells | None:
    """The cells of ``centres``; None if there are no centres. Centres without a key or a whole vector take no part.

    ``pivots`` is by default the square root of the number of centres. They are those with the smallest hashes. Of equal
    centres only the smallest key can be an answer.
    """
    rows = centres.select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("centre"))
    whole = F.col("key").isNotNull() & F.col("centre").isNotNull() & ~F.exists("centre", lambda x: x.isNull() | F.isnan(x))
    distinct = rows.where(whole).groupBy("centre").agg(F.min("key").alias("key"))
    rows = materialize(distinct.select("key", "centre"), "centres")
    n, shortest, longest = rows.agg(F.count("*"), F.min(F.size("centre")), F.max(F.size("centre"))).first()
    if not n:
        return None
    if shortest != longest:
        raise ValueError(f"the centres have from {shortest} to {longest} values")
    wanted = pivots or int(np.ceil(np.sqrt(n)))
    picked = np.array([r["centre"] for r in rows.orderBy(F.xxhash64("key"), "key").limit(wanted).select("centre").collect()], np.float64)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, DISTANCES // len(picked))
        for batch in batches:
            for lo in range(0, len(batch), step):
                part = batch.slice(lo, step)
                own = _matrix(part.column("centre"))
                cell = _rough(own, picked)[0].argmin(axis=1)
                radius = np.sqrt(_exact(own, picked[cell])) * (1 + SLACK)
                yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int32()), pa.array(radius), *part.columns], names=["cell", "radius", *part.schema.names])

    schema = StructType([*StructType.fromDDL("cell int, radius double").fields, *rows.schema.fields])
    path = new_folder(centres.sparkSession, "cells")
    rows.mapInArrow(dealt, schema).repartition("cell").write.partitionBy("cell").parquet(path)
    radii = np.full(len(picked), -np.inf)
    found = centres.sparkSession.read.parquet(path).groupBy("cell").agg(F.max("radius").alias("radius"))
    for r in found.collect():
        radii[r["cell"]] = r["radius"]
    return Cells(path, picked, radii)


def assign_by_cells(df: DataFrame, vector: str, centres: DataFrame, key: str, centre: str = "centre", pivots: int | None = None) -> DataFrame:
    """Add ``cluster``, the ``key`` of the nearest centre, and the ``distance`` to it, for any number of centres.

    Equal distances go to the smaller key. A point that is null, has another length than the centres or holds nulls
    or NaN has neither, and so has every point if there are no centres.
    """
    cells = build_cells(centres, key, centre, pivots)
    kind = centres.schema[key].dataType
    if cells is None:
        return df.withColumns({"cluster": F.lit(None).cast(kind), "distance": F.lit(None).cast("double")})
    schema = StructType([*df.schema.fields, StructField("cluster", kind), StructField("distance", DoubleType())])

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        length = cells.pivots.shape[1]
        step = max(1, DISTANCES // len(cells.pivots))
        for batch in batches:
            for lo in range(0, len(batch), step):
                part = batch.slice(lo, step)
                usable = _usable(part.column(vector), length)
                keys, distances = [None] * len(part), [None] * len(part)
                if usable.any():
                    found, away, _ = cells.nearest(_matrix(part.column(vector).filter(pa.array(usable))))
                    for i, k, d in zip(np.flatnonzero(usable).tolist(), found, away.tolist()):
                        keys[i], distances[i] = k, d
                added = [pa.array(keys, to_arrow_type(kind)), pa.array(distances, pa.float64())]
                yield pa.RecordBatch.from_arrays([*part.columns, *added], names=[*part.schema.names, "cluster", "distance"])

    return df.mapInArrow(assigned, schema)
