"""Closest pair of a point set, without comparing all pairs.

Up to one block of points is settled in one task: sorted by the widest
coordinate, neighbours at growing distance in the order are compared while that
coordinate alone does not rule them out.

Beyond a block, copies are found first by grouping on the coordinates. Blocks of a
hash of the id then give an upper bound on the smallest positive distance; the
points go into small cells (``operators.cells``), and only cells that may hold two
points within the bound meet, with only those of their points that lie within the
bound of the other cell.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from robustagg.operators.balls import DEFAULT_BLOCK_ROWS, _cell_pairs, _distance_chunks
from robustagg.operators.cells import SLACK, build_cells, distances, matrix
from robustagg.sources.store import features_column, stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CELL_ROWS = 256
_SHAPE = "zero boolean, positive double"


def closest_in(x: np.ndarray, counted: list[int] | None = None) -> tuple[bool, float]:
    """Whether two rows coincide, and the smallest positive distance (inf without one)."""
    zero, best, total = False, np.inf, 0
    if len(x) > 1:
        widest = int(np.argmax(x.max(0) - x.min(0)))
        x = x[np.argsort(x[:, widest], kind="stable")]
        for s in range(1, len(x)):
            near = np.flatnonzero(x[s:, widest] - x[:-s, widest] <= best)
            if not len(near):
                break
            acc = np.zeros(len(near))
            for j in range(x.shape[1]):
                diff = x[near + s, j] - x[near, j]
                acc += diff * diff
            d = np.sqrt(acc)
            total += len(d)
            zero = zero or bool((d == 0).any())
            best = min(best, float(d[d > 0].min(initial=np.inf)))
    if counted is not None:
        counted.append(total)
    return zero, best


def _found(zero: bool, best: float) -> dict:
    return {"zero": pa.array([zero]), "positive": pa.array([None if np.isinf(best) else best], pa.float64())}


def _in_block(t: pa.Table) -> pa.Table:
    return pa.table(_found(*closest_in(matrix(t.column("features"), t.num_rows))))


def _in_pairs(batches):
    for batch in batches:
        best = np.inf
        for i in range(batch.num_rows):
            get = lambda c: batch.column(c)[i]  # noqa: E731, B023
            ca, cb = (get(c).values.to_numpy() for c in ("center_a", "center_b"))
            x, y = (get(c).values.to_numpy().reshape(-1, len(ca)) for c in ("x_a", "x_b"))
            if get("a").as_py() == get("b").as_py():
                best = min(best, closest_in(x)[1])
                continue
            bound = min(best, get("r").as_py())
            keep = lambda p, c, r: p[distances(p, c) <= (r + bound) * (1 + SLACK)]  # noqa: E731, B023
            x, y = keep(x, cb, get("radius_b").as_py()), keep(y, ca, get("radius_a").as_py())
            if len(x) and len(y):
                for _, d in _distance_chunks(x, y):
                    best = min(best, float(d[d > 0].min(initial=np.inf)))
        if not np.isinf(best):
            yield pa.RecordBatch.from_pydict({"positive": pa.array([best])})


def closest_pair(points: DataFrame, n_rows: int, block_rows: int = DEFAULT_BLOCK_ROWS,
                 cell_rows: int = CELL_ROWS) -> DataFrame:
    """One row (min_distance, min_positive) over the pairs of ``points`` (point_id,
    features), ``n_rows`` at most; null where there is no such pair."""
    rows = points.select("point_id", features_column())
    if n_rows <= block_rows:
        return _row(rows.withColumn("block", F.lit(0)).groupBy("block").applyInArrow(_in_block, _SHAPE))
    rows = stored(rows)
    different = stored(rows.groupBy("features").agg(F.min("point_id").alias("id"), F.count(F.lit(1)).alias("n")))
    blocks = max(1, math.ceil(n_rows / block_rows))
    sampled = (different.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks))).groupBy("block").applyInArrow(_in_block, _SHAPE)
               .agg(F.min("positive")).first()[0])
    copies = different.agg(F.coalesce(F.max("n") > 1, F.lit(False)).alias("zero"))
    if sampled is None:  # blocks of one point each: any two points give a bound
        two = different.orderBy("id").limit(2).collect()
        if len(two) < 2:
            return _row(copies.withColumn("positive", F.lit(None).cast("double")))
        sampled = closest_in(np.array([r["features"] for r in two]))[1]
    first = list(different.select("features").first()["features"])
    cells = build_cells(different.select(F.lit(0).alias("grp"), "id", "features", F.lit(1).alias("weight")), first, cell_rows)
    reach = cells.sparkSession.range(1).select(F.lit(0).alias("grp"), F.lit(float(sampled)).alias("r"))
    pairs = _cell_pairs(cells, reach).where("a <= b").select("grp", "a", "b", "r")
    side = lambda s: cells.select("grp", F.col("cell").alias(s), *(F.col(c).alias(f"{c}_{s}") for c in ("center", "radius", "x")))
    found = (pairs.join(side("a"), ["grp", "a"]).join(side("b"), ["grp", "b"])
             .select("a", "b", "r", "center_a", "center_b", "radius_a", "radius_b", "x_a", "x_b")
             .mapInArrow(_in_pairs, "positive double"))
    best = found.agg(F.least(F.min("positive"), F.lit(float(sampled))).alias("positive"))
    positive = best.first()[0]  # one number
    return _row(copies.withColumn("positive", F.lit(positive)))


def _row(found: DataFrame) -> DataFrame:
    return found.agg(F.max("zero").alias("zero"), F.min("positive").alias("min_positive")).select(
        F.when(F.col("zero"), 0.0).otherwise(F.col("min_positive")).alias("min_distance"), "min_positive")
