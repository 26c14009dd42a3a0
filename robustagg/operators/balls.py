"""Ball weights: for every uncovered point of a guess, the uncovered weight
within a radius of it (a range self-join on distance, summed).

Spark's higher-order functions would express this, but they run interpreted
(no code generation), about a microsecond per pair; exploding pairs into rows
is what we must not do. So the pairs are evaluated by a small numpy kernel on
bounded blocks, while Spark does the partitioning, shuffling and summing:

* the uncovered points of each guess are stored as cells of at most
  ``block_rows`` points (``operators.cells``);
* pairs of cells that are too far apart by the triangle inequality are never
  met, pairs that lie wholly within the radius add a cell's weight, and for the
  rest the kernel compares the points of two cells (``ball_weights_cells``);
* the partial weights per candidate are summed by a ``groupBy``. With one block
  per guess there is nothing to sum, and all greedy steps run in that block's
  task (``cover_single_blocks``).

Distances are summed in coordinate order from 0.0, as the SQL expressions do,
so a point exactly on the radius is counted the same way everywhere.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from robustagg.operators.cells import SLACK, build_cells, distances, matrix, summary
from robustagg.sources.store import features_column, stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

DEFAULT_BLOCK_ROWS = 4096
_CELLS = 1 << 17
PLAIN = pa.list_(pa.float64())  # whatever the nullability and width of the input's elements
_OUT_SCHEMA = "guess int, idx long, point_id long, ball_weight long"


_matrix = matrix


def _distance_chunks(cand: np.ndarray, members: np.ndarray):
    """Yield ``(lo, d)``: distances of candidate rows lo.. to every member,
    a few rows at a time so the temporaries stay cache-sized (about 1 MB)."""
    n, m = cand.shape[0], members.shape[0]
    chunk = max(1, _CELLS // max(m, 1))
    mt = np.ascontiguousarray(members.T)
    acc = np.empty((min(chunk, n), m))
    diff = np.empty_like(acc)
    for lo in range(0, n, chunk):
        c = cand[lo:lo + chunk]
        a, d = acc[:c.shape[0]], diff[:c.shape[0]]
        a.fill(0.0)
        for j in range(members.shape[1]):
            np.subtract(c[:, j][:, None], mt[j][None, :], out=d)
            np.multiply(d, d, out=d)
            a += d
        np.sqrt(a, out=a)
        yield lo, a


def ball_sums(cand: np.ndarray, radius: np.ndarray, members: np.ndarray,
              weights: np.ndarray) -> np.ndarray:
    """For each candidate row, the sum of member weights within its radius."""
    out = np.zeros(cand.shape[0], dtype=np.int64)
    if cand.shape[0] == 0 or members.shape[0] == 0:
        return out
    wf = weights.astype(np.float64)   # exact: weights stay far below 2**53
    for lo, d in _distance_chunks(cand, members):
        inside = d <= radius[lo:lo + d.shape[0]][:, None]
        out[lo:lo + d.shape[0]] = np.rint(inside @ wf).astype(np.int64)
    return out


def _single_block(factor: float):
    def run(t: pa.Table) -> pa.Table:
        n = t.num_rows
        x = _matrix(t.column("features"), n)
        r = t.column("radius").to_numpy() * factor
        w = t.column("weight").to_numpy().astype(np.int64)
        bw = ball_sums(x, r, x, w)
        return pa.table({"guess": t.column("guess"), "idx": t.column("idx"),
                         "point_id": t.column("point_id"),
                         "ball_weight": pa.array(bw, type=pa.int64()),
                         "features": t.column("features").combine_chunks().cast(PLAIN)})
    return run


_COVER_SCHEMA = ("idx long, point_id long, features array<double>, weight long, guess int, radius double, "
                 "uncovered boolean, center_step int, steps_done int")


def cover_block(x: np.ndarray, idx: np.ndarray, w: np.ndarray, radius: float, steps: int, select: float, remove: float,
                uncovered: np.ndarray, counted: list[int] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Greedy steps on one block: which rows stay uncovered and, per row, the step
    (from 1) that made it a center, or 0. Ball weights are computed once; a step
    subtracts the balls around the points that it newly covers, so a pair's
    distance is computed at most twice in all steps."""
    step_of = np.zeros(len(x), np.int64)
    uncovered = uncovered.copy()
    live = np.flatnonzero(uncovered)
    r = np.full(len(x), radius * select)
    balls = np.zeros(len(x), np.int64)
    balls[live] = ball_sums(x[live], r[live], x[live], w[live])
    pairs = len(live) ** 2
    for step in range(1, steps + 1):
        top = balls[live].max(initial=0)
        if top <= 0:
            break
        best = live[balls[live] == top]
        center = best[np.argmin(idx[best])]  # ties: smaller idx
        step_of[center] = step
        gone = live[distances(x[live], x[center]) <= remove * radius]
        uncovered[gone] = False
        live = np.flatnonzero(uncovered)
        balls[live] -= ball_sums(x[live], r[live], x[gone], w[gone])
        pairs += len(live) * len(gone)
    if counted is not None:
        counted.append(pairs)
    return uncovered, step_of


def _cover(steps: int, select: float, remove: float):
    def run(t: pa.Table) -> pa.Table:
        n = t.num_rows
        features = t.column("features").combine_chunks().cast(PLAIN)
        x = _matrix(features, n)
        radius = t.column("radius")[0].as_py()
        left, step_of = cover_block(x, t.column("idx").to_numpy(), t.column("weight").to_numpy().astype(np.int64), radius,
                                    steps, select, remove, t.column("uncovered").to_numpy(zero_copy_only=False))
        return pa.table({
            "idx": t.column("idx"), "point_id": t.column("point_id"), "features": features,
            "weight": t.column("weight").cast(pa.int64()), "guess": t.column("guess"), "radius": t.column("radius"),
            "uncovered": pa.array(left), "center_step": pa.array(step_of, pa.int32(), mask=step_of == 0),
            "steps_done": pa.array(np.full(n, steps, np.int32))})
    return run


def cover_single_blocks(state: DataFrame, steps: int, select: float, remove: float) -> DataFrame:
    """All greedy steps of every guess whose points form one block: one task per
    guess, one job. ``state`` is a starting state (no centers yet)."""
    return state.select(*(c.split()[0] for c in _COVER_SCHEMA.split(", "))).groupBy("guess").applyInArrow(
        _cover(steps, select, remove), _COVER_SCHEMA)


def _cell_pairs(cells: DataFrame, reach: DataFrame) -> DataFrame:
    """(grp, a, b, r, inside) of the pairs of cells of a guess whose points may lie
    within ``r`` of each other (``reach``: grp, r); ``inside``: all of them do.

    Cells are listed in buckets of distance to the origin, a bucket as wide as the
    radius or the mean cell; a pair meets in the buckets that both ranges, one of
    them widened by r, touch, and counts in the first."""
    s = summary(cells).join(reach, "grp").select("grp", "cell", "center", "radius", "low", "high", "r")
    width = s.groupBy("grp").agg(F.greatest(F.max("r"), F.avg(F.col("high") - F.col("low")), F.lit(1e-300)).alias("width"))
    s = s.join(width, "grp")

    def listed(side: str, more) -> DataFrame:
        at = lambda v: F.floor(v / F.col("width"))
        first, last = at(F.col("low") - more), at(F.col("high") + more)
        return s.select("grp", F.explode(F.sequence(first, last)).alias("bucket"), first.alias(f"first_{side}"),
                        *(F.col(c).alias(f"{c}_{side}") for c in ("cell", "center", "radius")),
                        *(["r"] if side == "a" else []))
    margin = F.col("r") * (1 + SLACK) + SLACK * F.abs("high")
    both = listed("a", margin).join(listed("b", F.lit(0.0)), ["grp", "bucket"])
    both = both.where(F.col("bucket") == F.greatest("first_a", "first_b"))
    d = F.sqrt(F.aggregate(F.zip_with("center_a", "center_b", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda t, v: t + v))
    both = both.withColumn("d", d).withColumn("spread", F.col("radius_a") + F.col("radius_b"))
    slack = F.lit(SLACK) * (F.col("d") + F.col("spread") + F.col("r"))
    return (both.where(F.col("d") - F.col("spread") <= F.col("r") + slack)
            .select("grp", F.col("cell_a").alias("a"), F.col("cell_b").alias("b"), "r",
                    (F.col("d") + F.col("spread") + slack <= F.col("r")).alias("inside")))


def _pair_sums(batches):
    """Pairs of cells -> partial ball weights of the first cell's points."""
    for batch in batches:
        col = {c: batch.column(c) for c in batch.schema.names}
        grp, ids, sums = [], [], []
        for i in range(batch.num_rows):
            mine, r = col["ids_a"][i].values.to_numpy(), col["r"][i].as_py()
            x = col["x_a"][i].values.to_numpy().reshape(len(mine), -1)
            w = col["w_b"][i].values.to_numpy()
            y = col["x_b"][i].values.to_numpy().reshape(len(w), -1)
            part = ball_sums(x, np.full(len(x), r), y, w)
            hit = np.flatnonzero(part)
            grp.append(np.full(len(hit), col["grp"][i].as_py(), np.int32))
            ids.append(mine[hit])
            sums.append(part[hit])
        if grp:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(v)) for v in (grp, ids, sums)], ["grp", "id", "part"])


def ball_weights_cells(members: DataFrame, candidates: DataFrame | None, reach: DataFrame, origin: list[float],
                       cell_rows: int = DEFAULT_BLOCK_ROWS, seen: dict | None = None) -> DataFrame:
    """``(grp, id, ball_weight)``: weight of the ``members`` (grp, id, features,
    weight) within the radius of their group (``reach``: grp, r) of every
    candidate (the members themselves, or ``candidates`` of the same columns).
    Candidates with no member near have no row.

    A metric range index: points are stored as cells; pairs of cells too far apart
    by their ranges and centers are never met, pairs wholly inside the radius add
    the cell's weight, and only the rest compares points (two cells at a time).
    ``seen`` receives ``distances``, the point pairs compared, and ``pairs``."""
    cells = build_cells(members, origin, cell_rows)
    if candidates is None:
        pairs = stored(_cell_pairs(cells, reach))
        mine = cells
    else:
        mine = build_cells(candidates, origin, cell_rows)
        # Both sides in one list; a candidate cell meets member cells only.
        tagged = mine.withColumn("cell", -F.col("cell") - 1).unionByName(cells)
        pairs = stored(_cell_pairs(tagged, reach).where("a < 0 and b >= 0").withColumn("a", -F.col("a") - 1))
    a = mine.select("grp", F.col("cell").alias("a"), F.col("ids").alias("ids_a"), F.col("x").alias("x_a"))
    b = cells.select("grp", F.col("cell").alias("b"), F.col("x").alias("x_b"), F.col("w").alias("w_b"))
    partly = pairs.where("not inside").join(a, ["grp", "a"]).join(b, ["grp", "b"]).select(
        "grp", "r", "ids_a", "x_a", "x_b", "w_b")
    partial = partly.mapInArrow(_pair_sums, "grp int, id long, part long")
    whole = (pairs.where("inside").join(cells.select("grp", F.col("cell").alias("b"), "weight"), ["grp", "b"])
             .groupBy("grp", "a").agg(F.sum("weight").alias("part"))
             .join(a.select("grp", "a", "ids_a"), ["grp", "a"]).select("grp", F.explode("ids_a").alias("id"), "part"))
    if seen is not None:
        n = mine.select("grp", F.col("cell").alias("a"), F.col("n").alias("na"))
        m = cells.select("grp", F.col("cell").alias("b"), F.col("n").alias("nb"))
        sizes = pairs.where("not inside").join(n, ["grp", "a"]).join(m, ["grp", "b"])
        seen["distances"] = sizes.agg(F.sum(F.col("na").cast("long") * F.col("nb"))).first()[0] or 0
        seen["pairs"] = pairs.count()
    return partial.unionByName(whole).groupBy("grp", "id").agg(F.sum("part").cast("long").alias("ball_weight"))


def ball_weights_blocked(unc: DataFrame, factor: float, n_rows: int,
                         block_rows: int = DEFAULT_BLOCK_ROWS, seen: dict | None = None) -> DataFrame:
    """``(guess, idx, point_id, ball_weight)`` of the uncovered rows ``unc``
    (columns guess, radius, idx, point_id, features, weight): weight of the
    uncovered rows of the same guess within ``factor * radius``."""
    cols = ["guess", "radius", "idx", "point_id", "features", "weight"]
    if n_rows <= block_rows:
        # One block per guess: the kernel also passes the coordinates through,
        # so the heaviest ball needs no lookup afterwards.
        return unc.select(*cols).groupBy("guess").applyInArrow(
            _single_block(factor), _OUT_SCHEMA + ", features array<double>")
    first = unc.select("features").first()
    if first is None:
        return unc.select("guess", "idx", "point_id", F.lit(0).cast("long").alias("ball_weight"))
    rows = unc.select(F.col("guess").alias("grp"), F.col("idx").alias("id"), "features", "weight")
    reach = unc.groupBy(F.col("guess").alias("grp")).agg((F.max("radius") * factor).alias("r"))
    sums = ball_weights_cells(rows, None, reach, list(first["features"]), block_rows, seen)
    sums = sums.select(F.col("grp").alias("guess"), F.col("id").alias("idx"), "ball_weight")
    return (unc.select("guess", "idx", "point_id").join(sums, ["guess", "idx"], "left")
            .select("guess", "idx", "point_id", F.coalesce("ball_weight", F.lit(0)).cast("long").alias("ball_weight")))


_PAIR_SCHEMA = "pairs long, min_distance double, min_positive double, max_distance double"


def _pair_block(c: pa.Table, m: pa.Table) -> pa.Table:
    """Count, min, smallest positive and max of the distances between two blocks
    (within one block: each unordered pair once, by point id)."""
    empty = pa.table({"pairs": pa.array([0], pa.int64()),
                      "min_distance": pa.array([None], pa.float64()),
                      "min_positive": pa.array([None], pa.float64()),
                      "max_distance": pa.array([None], pa.float64())})
    if c.num_rows == 0 or m.num_rows == 0:
        return empty
    same = c.column("ablk")[0].as_py() == c.column("bblk")[0].as_py()
    x = _matrix(c.column("features"), c.num_rows)
    y = _matrix(m.column("other"), m.num_rows)
    xi = c.column("point_id").to_numpy()
    yi = m.column("other_id").to_numpy()
    count, lo, above, hi = 0, np.inf, np.inf, -np.inf
    for s0, d in _distance_chunks(x, y):
        if same:
            d = d[xi[s0:s0 + d.shape[0]][:, None] < yi[None, :]]
        if d.size:
            count += d.size
            lo, hi = min(lo, d.min()), max(hi, d.max())
            above = min(above, d[d > 0].min(initial=np.inf))
    if not count:
        return empty
    return pa.table({"pairs": pa.array([count], pa.int64()),
                     "min_distance": pa.array([lo], pa.float64()),
                     "min_positive": pa.array([None if np.isinf(above) else above], pa.float64()),
                     "max_distance": pa.array([hi], pa.float64())})


def pair_distance_summary(points: DataFrame, block_rows: int = DEFAULT_BLOCK_ROWS,
                          n_rows: int | None = None) -> DataFrame:
    """One row ``(pairs, min_distance, min_positive, max_distance)`` over all unordered pairs
    of distinct points. The n^2/2 distances are evaluated block against block
    (cogroup on (a block, b block), a <= b) and reduced inside the kernel; no
    pair row is ever produced and a task holds two blocks at most."""
    if n_rows is None:
        n_rows = points.count()
    nb = max(1, math.ceil(n_rows / block_rows))
    blk = F.pmod(F.xxhash64("point_id"), F.lit(nb)).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.lit(nb - 1))).alias("o")
    base = points.select("point_id", "features", blk.alias("blk"))
    left = (base.select("point_id", "features", "blk", other)
                .where(F.col("o") >= F.col("blk"))
                .select("point_id", "features", F.col("blk").alias("ablk"), F.col("o").alias("bblk")))
    right = (base.select("point_id", "features", "blk", other)
                 .where(F.col("o") <= F.col("blk"))
                 .select(F.col("point_id").alias("other_id"), F.col("features").alias("other"),
                         F.col("o").alias("ablk"), F.col("blk").alias("bblk")))
    partial = (left.groupBy("ablk", "bblk").cogroup(right.groupBy("ablk", "bblk"))
                   .applyInArrow(_pair_block, _PAIR_SCHEMA))
    return partial.agg(F.sum("pairs").cast("long").alias("pairs"),
                       F.min("min_distance").alias("min_distance"),
                       F.min("min_positive").alias("min_positive"),
                       F.max("max_distance").alias("max_distance"))


_NEAREST_SCHEMA = "point_id long, features array<double>, pos int, distance double"
CENTER_BYTES = 16 * 1024 * 1024   # coordinates of centers in one task closure


PLAIN_CENTERS = 64  # centers that are compared one by one


class CenterIndex:
    """Centers in groups around pivots, each sorted by distance to its pivot, so
    that most centers are ruled out by |d(x, pivot) - d(c, pivot)| alone."""

    def __init__(self, centers: np.ndarray):
        self.centers = centers
        n = max(1, int(np.sqrt(len(centers))))
        near = np.full(len(centers), np.inf)
        group = np.zeros(len(centers), np.int64)
        pivots = [0]
        while True:  # farthest-first pivots
            d = distances(centers, centers[pivots[-1]])
            closer = d < near
            near[closer], group[closer] = d[closer], len(pivots) - 1
            if len(pivots) == n or not near.max() > 0:
                break
            pivots.append(int(np.argmax(near)))
        self.pivots = centers[pivots]
        order = np.lexsort((near, group))
        bounds = np.searchsorted(group[order], np.arange(len(pivots) + 1))
        self.members = [order[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]
        self.keys = [near[m] for m in self.members]

    def nearest(self, x: np.ndarray, counted: list[int] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Position of and distance to the nearest center of each row (ties: the earlier one)."""
        n = len(x)
        pos, best = np.full(n, len(self.centers), np.int64), np.full(n, np.inf)
        to = np.empty((n, len(self.pivots)))
        for lo, d in _distance_chunks(x, self.pivots):
            to[lo:lo + len(d)] = d
        total = to.size
        own = to.argmin(1)
        for first in (True, False):
            for g, (members, keys) in enumerate(zip(self.members, self.keys, strict=True)):
                d = to[:, g]
                slack = SLACK * (d + keys[-1])
                rows = np.flatnonzero(own == g) if first else np.flatnonzero(
                    (own != g) & (d - keys[-1] - slack <= best) & (keys[0] - d - slack <= best))
                # Rows that look at much the same stretch of the sorted centers go together.
                rows = rows[np.argsort(d[rows], kind="stable")]
                for i in range(0, len(rows), 64):
                    some = rows[i:i + 64]
                    if first:
                        a, b = 0, len(members)
                    else:
                        a = int(np.searchsorted(keys, (d[some] - best[some] - slack[some]).min()))
                        b = int(np.searchsorted(keys, (d[some] + best[some] + slack[some]).max(), "right"))
                    some_members = np.sort(members[a:b])
                    if not len(some_members):
                        continue
                    total += len(some) * len(some_members)
                    for lo, dist in _distance_chunks(x[some], self.centers[some_members]):
                        at = some[lo:lo + len(dist)]
                        k = dist.argmin(1)
                        found, which = dist[np.arange(len(at)), k], some_members[k]
                        closer = (found < best[at]) | (found == best[at]) & (which < pos[at])
                        best[at[closer]], pos[at[closer]] = found[closer], which[closer]
        if counted is not None:
            counted.append(total)
        return pos, best


def nearest_of(x: np.ndarray, centers: np.ndarray, index: CenterIndex | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Position of and distance to the nearest center of each row (ties: the earlier one)."""
    if index is not None:
        return index.nearest(x)
    pos, dist = np.empty(len(x), np.int64), np.empty(len(x))
    for lo, d in _distance_chunks(x, centers):
        near = np.argmin(d, axis=1)  # first minimum: earlier center
        pos[lo:lo + len(d)], dist[lo:lo + len(d)] = near, d[np.arange(len(d)), near]
    return pos, dist


def _nearest_kernel(centers: np.ndarray, first: int):
    dim = centers.shape[1]

    def run(batches):
        index = CenterIndex(centers) if len(centers) > PLAIN_CENTERS else None
        for b in batches:
            n = b.num_rows
            if n == 0:
                continue
            feats = b.column("features").cast(PLAIN)
            lengths = np.diff(feats.offsets.to_numpy())
            if feats.null_count or (lengths != dim).any():
                raise ValueError(f"a point has no features or a dimension other than {dim}")
            x = _matrix(feats, n)
            if np.isnan(x).any():
                raise ValueError("a coordinate is null or NaN")
            near, best = nearest_of(x, centers, index)
            pos = b.column("pos").to_numpy().copy()
            dist = b.column("distance").to_numpy().copy()
            closer = best < dist  # ties stay with the earlier block
            pos[closer] = near[closer] + first
            dist[closer] = best[closer]
            yield pa.RecordBatch.from_arrays([b.column("point_id"), feats, pa.array(pos), pa.array(dist)],
                                             ["point_id", "features", "pos", "distance"])
    return run


def nearest_centers_arrow(points: DataFrame, centers: list[list[float]],
                          center_bytes: int = CENTER_BYTES) -> DataFrame:
    """``(point_id, pos, distance)``: each point's nearest center (ties to the
    earlier one), map-only over Arrow batches. The centers go to the tasks in
    blocks of at most ``center_bytes`` (one block as a rule); the best so far is
    carried from block to block. Points without features, with a null or NaN
    coordinate or of another dimension than the centers fail the job."""
    c = np.asarray(centers, dtype=np.float64)
    rows = max(1, center_bytes // (8 * c.shape[1]))
    out = points.select("point_id", features_column(), F.lit(-1).alias("pos"), F.lit(float("inf")).alias("distance"))
    for first in range(0, len(c), rows):
        out = out.mapInArrow(_nearest_kernel(c[first:first + rows], first), _NEAREST_SCHEMA)
    return out.select("point_id", "pos", "distance")
