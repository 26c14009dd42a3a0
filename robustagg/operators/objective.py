"""Objective of a k-center solution: the (z+1)-th largest distance from a point
to its nearest center, over all input points (unweighted).

The nearest center comes from one map-only Arrow kernel over the point scan: no
join, no shuffle of the points. The (z+1)-th largest value is a bounded
top-(z+1) (``TakeOrderedAndProject``, each task keeps z+1 values). For a large z
that would funnel partitions * (z+1) rows into one task, so above ``TAKE_LIMIT``
the values are stored once and the range that holds the value is narrowed by
exact counts per bucket until few rows are left to rank; also exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from robustagg.operators.balls import nearest_centers_arrow
from robustagg.session import ensure_checkpoint_dir

TAKE_LIMIT = 10_000


Centers = tuple[list[int], list[list[float]]]


def centers_of(solution: DataFrame, known: Centers | None = None) -> Centers:
    """Point ids and coordinates of a solution (at most k rows), in step order:
    ``known`` when the solver already observed them, else one small collect."""
    if known is not None:
        return known
    rows = solution.select("step", "point_id", "features").orderBy("step").collect()
    return [r["point_id"] for r in rows], [list(r["features"]) for r in rows]


def nearest_frame(points: DataFrame, feats: list[list[float]], **kernel) -> DataFrame:
    """``(point_id, pos, distance)`` of every point's nearest center (ties to
    the earlier center)."""
    if not feats:
        raise ValueError("a solution needs at least one center")
    return nearest_centers_arrow(points, feats, **kernel)


def assign_to_centers(points: DataFrame, solution: DataFrame,
                      centers: Centers | None = None, **kernel) -> DataFrame:
    """``(point_id, center_id, distance)`` for every point: its nearest center
    of the solution (ties to the earlier step)."""
    ids, feats = centers_of(solution, centers)
    near = nearest_frame(points, feats, **kernel)
    return near.select("point_id",
                       F.element_at(F.lit(ids).cast("array<long>"), F.col("pos") + 1)
                        .alias("center_id"),
                       "distance")


def _narrow(v: DataFrame, k: int, rank_rows: int, buckets: int = 4096) -> tuple[DataFrame, int]:
    """The rows of ``v`` in a range that holds its k-th largest value, and its
    rank there. Each round counts the range's rows in equal buckets (at most
    ``buckets`` counts reach the driver) and goes on with the bucket of the
    rank, until at most ``rank_rows`` rows or one value are left."""
    while True:
        lo, hi, n = v.agg(F.min("v"), F.max("v"), F.count("v")).first()
        if n <= max(rank_rows, 1) or lo == hi:
            return v, k
        width = (hi - lo) / buckets
        bucket = F.least(F.floor((F.col("v") - F.lit(lo)) / F.lit(width)), F.lit(buckets - 1))
        above = 0
        for r in sorted(v.groupBy(bucket.alias("b")).count().collect(), reverse=True):
            if above + r["count"] >= k:
                break
            above += r["count"]
        inside = v.where(bucket == F.lit(r["b"]))
        if r["count"] == n:  # neighbouring floating point numbers: rank them as they are
            return v, k
        v, k = inside, k - above


def kth_largest(values: DataFrame, col: str, k: int, name: str = "value",
                take_limit: int | None = None) -> DataFrame:
    """One row: the k-th largest of ``col`` (null when there are fewer than k
    rows; nulls do not count). Exact."""
    if k < 1:
        raise ValueError("k must be >= 1")
    take_limit = TAKE_LIMIT if take_limit is None else take_limit
    v = values.select(F.col(col).alias("v")).where("v is not null")
    if k > take_limit:
        ensure_checkpoint_dir(v.sparkSession)
        v = v.checkpoint()  # the values are computed once
        if v.count() >= k:
            v, k = _narrow(v, k, take_limit)
            lo, hi = v.agg(F.min("v"), F.max("v")).first()
            if lo == hi:
                return v.limit(1).select(F.col("v").alias(name))
    top = v.orderBy(F.col("v").desc()).limit(int(k))
    return top.agg(F.when(F.count(F.lit(1)) == F.lit(int(k)), F.min("v")).alias(name))


def objective(points: DataFrame, solution: DataFrame, z: int,
              centers: Centers | None = None, take_limit: int | None = None) -> DataFrame:
    """One row ``objective``: the largest nearest-center distance once the z
    farthest points are ignored."""
    _, feats = centers_of(solution, centers)
    return kth_largest(nearest_frame(points, feats), "distance", int(z) + 1, "objective", take_limit)
