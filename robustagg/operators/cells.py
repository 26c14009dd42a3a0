"""Cells: bounded, spatially close groups of points with a center and a radius.

The points of a group (a part, a radius guess) are sorted by their distance to a
fixed origin (one range shuffle, so a group may span any number of tasks) and cut
into runs; a run is split at the median of its widest coordinate until each piece
has at most ``cell_rows`` points. A cell is one row of arrays, stored once in the
checkpoint folder; nothing ever rewrites its coordinates. What the triangle
inequality says about a cell (center, radius, range of distances to the origin)
lets later steps skip or settle whole cells without a distance per point.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from robustagg.sources.store import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

RUN_CELLS = 16   # cells of a run that is split in memory
SLACK = 1e-9     # rounding error allowed for in a bound, relative to the distances in it

SUMMARY = "grp int, cell long, n int, weight long, center array<double>, radius double, low double, high double"
CELL = f"{SUMMARY}, ids array<long>, x array<double>, w array<long>"


def matrix(col: pa.Array | pa.ChunkedArray, n: int) -> np.ndarray:
    """Rows of a list column as an n x dim matrix of doubles."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return flat.reshape(n, -1) if n else np.zeros((0, 0))


def distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Distance of every row to ``c``, squares summed in coordinate order."""
    acc = np.zeros(len(x))
    for j in range(x.shape[1]):
        diff = x[:, j] - c[j]
        acc += diff * diff
    return np.sqrt(acc)


def _pieces(x: np.ndarray, rows: np.ndarray, limit: int) -> Iterator[np.ndarray]:
    stack = [rows]
    while stack:
        rows = stack.pop()
        if len(rows) <= limit:
            yield rows
            continue
        part = x[rows]
        widest = int(np.argmax(part.max(0) - part.min(0)))
        half = len(rows) // 2
        order = np.argpartition(part[:, widest], half)
        stack += [rows[order[half:]], rows[order[:half]]]


def _distance_to_origin(origin: list[float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = np.asarray(origin)
        for b in batches:
            if b.num_rows:
                d = distances(matrix(b.column("features"), b.num_rows), at)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), b.column(2).cast(pa.list_(pa.float64())), b.column(3), pa.array(d)],
                    ["grp", "id", "features", "weight", "d0"])
    return run


def _cut(cell_rows: int):
    def cells(t: pa.Table, first: int) -> pa.RecordBatch:
        n = t.num_rows
        x, d0 = matrix(t.column("features"), n), t.column("d0").to_numpy()
        ids, w = t.column("id").to_numpy(), t.column("weight").to_numpy()
        out: dict[str, list] = {c.split()[0]: [] for c in CELL.split(", ")}
        grp = t.column("grp")[0].as_py()
        for k, rows in enumerate(_pieces(x, np.arange(n), cell_rows)):
            rows = rows[np.argsort(ids[rows], kind="stable")]
            xs = x[rows]
            center = xs.mean(0)
            values = (grp, first + k, len(rows), int(w[rows].sum()), center, float(distances(xs, center).max()),
                      float(d0[rows].min()), float(d0[rows].max()), ids[rows], xs.ravel(), w[rows])
            for name, value in zip(out, values, strict=True):
                out[name].append(value)
        kinds = {"grp": pa.int32(), "n": pa.int32(), "cell": pa.int64(), "weight": pa.int64(), "ids": pa.list_(pa.int64()),
                 "w": pa.list_(pa.int64()), "center": pa.list_(pa.float64()), "x": pa.list_(pa.float64())}
        return pa.RecordBatch.from_pydict({c: pa.array(v, kinds.get(c, pa.float64())) for c, v in out.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        count = made = 0
        for batch in batches:
            groups = batch.column("grp").to_numpy()
            bounds = [0, *(np.flatnonzero(np.diff(groups)) + 1).tolist(), batch.num_rows]
            for lo, hi in zip(bounds, bounds[1:], strict=False):
                while lo < hi:
                    if held and held[0].column("grp")[0].as_py() != groups[lo] or count >= RUN_CELLS * cell_rows:
                        first = (held[0].column("pid")[0].as_py() << 33) + made
                        out = cells(pa.Table.from_batches(held), first)
                        made += out.num_rows
                        yield out
                        held, count = [], 0
                    take = min(hi - lo, RUN_CELLS * cell_rows - count)
                    held.append(batch.slice(lo, take))
                    count, lo = count + take, lo + take
        if held:
            yield cells(pa.Table.from_batches(held), (held[0].column("pid")[0].as_py() << 33) + made)
    return run


def build_cells(points: DataFrame, origin: list[float], cell_rows: int) -> DataFrame:
    """Stored cells of ``points`` (grp int, id long, features, weight long): one row
    per cell (``CELL`` and ``bin``, its file), ids ascending inside. ``origin`` is any vector of the
    points' dimension."""
    sized = points.select(F.col("grp").cast("int").alias("grp"), F.col("id").cast("long").alias("id"), "features",
                          F.col("weight").cast("long").alias("weight")).mapInArrow(
        _distance_to_origin(list(origin)), "grp int, id long, features array<double>, weight long, d0 double")
    ranged = (sized.repartitionByRange("grp", "d0", "id").sortWithinPartitions("grp", "d0", "id")
              .withColumn("pid", F.spark_partition_id()))
    cut = ranged.mapInArrow(_cut(cell_rows), CELL)
    return stored(cut.withColumn("bin", F.shiftright("cell", 33).cast("int")), folders="bin")


def chosen(cells: DataFrame, keys: DataFrame) -> DataFrame:
    """The cells of ``keys`` (grp, cell); files (bins, one per task that wrote
    them) without any are not read."""
    bins = [r[0] for r in keys.select(F.shiftright("cell", 33).cast("int")).distinct().collect()]
    return cells.where(F.col("bin").isin(bins)).join(keys, ["grp", "cell"], "left_semi")


def summary(cells: DataFrame) -> DataFrame:
    """The cells without their points."""
    return cells.select(*(c.split()[0] for c in SUMMARY.split(", ")))
