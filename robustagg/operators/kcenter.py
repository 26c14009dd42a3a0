"""Weighted k-center with z outliers (the greedy cover with a radius search).

Input: weighted points ``(idx, point_id, features, weight)``; ``idx`` fixes
the list order (part then pick for a coreset, point id for raw points).

For a radius r the greedy cover repeats, at most k times: among the uncovered
points take the one whose ball of radius (1+2a)r holds the most uncovered
weight (ties to the smaller idx), make it a center, and mark covered every
uncovered point within (3+4a)r of it. The answer is the smallest r of the
series r0, 2 r0, 4 r0, ... whose cover leaves uncovered weight <= z; r0 is
half the smallest distance among the first k+z+1 points.

Spark design:

* All radius guesses are independent, so they run side by side as a
  ``guess`` column. The number of guesses comes from an upper bound on the
  diameter (the diagonal of the bounding box): once (3+4a)r reaches it one
  ball covers everything.
* While a guess's points fit one block, all its steps run in that block's
  task: one job for all guesses and steps. Beyond a block there is one round
  per step for every guess.
* Ball weights need, for each uncovered candidate, the uncovered weight
  within a radius: a range self-join (``balls.ball_weights_cells``). It runs
  once; each step then subtracts the balls around the points that the step
  newly covered, so a pair of points is compared at most twice in all steps.
* The state (T points x G guesses, with the ball weights) is cut from its
  lineage each step with ``checkpoint()`` (reliable storage,
  ``spark.checkpoint.dir``). The stop test, the per-guess uncovered weight and
  the number of centers are observed metrics of that same job.
* Picking the heaviest ball (``max_by`` per guess) and removing the covered
  points (a join with the new centers, broadcast: one row per guess) are plain
  DataFrame operators.
* The solver compares pairs of weighted points: run it on a coreset (``robustagg.operators.coreset``), whose size m * L does not grow
  with the data. ``kcenter_exact`` on raw points is the reference's
  sequential algorithm and is only meant for inputs of bounded size.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from robustagg.functions.distance import euclidean, euclidean_sql
from robustagg.operators.balls import (
    DEFAULT_BLOCK_ROWS, ball_weights_blocked, ball_weights_cells, cover_single_blocks,
)
from robustagg.operators.closest import closest_pair
from robustagg.params import check_alpha, check_k_z
from robustagg.session import ensure_checkpoint_dir
from robustagg.sources.store import features_column


def selection_factor(alpha: float) -> float:
    return 1 + 2 * alpha


def removal_factor(alpha: float) -> float:
    return 3 + 4 * alpha


@dataclass
class SolverInput:
    """Scalars a solve needs, gathered with one small aggregate job."""
    n_rows: int
    dim: int                     # common dimension of the points
    initial_guess: float
    guesses: list[float]


@dataclass
class KCenterResult:
    state: DataFrame             # final greedy state, checkpointed
    per_guess: DataFrame         # radius_search summary per guess
    solution: DataFrame          # (step, point_id, features) of the winning guess
    initial_guess: float
    final_guess: float
    guesses: int                 # number of guesses the doubling search makes
    solution_size: int
    n_rows: int
    centers: tuple[list[int], list[list[float]]] | None = None   # ids, coordinates by step


def window_radius_frame(wpoints: DataFrame, m: int) -> DataFrame:
    """One row: ``dmin`` / ``dpos`` (smallest and smallest positive distance
    among the first m points in idx order) and ``initial_guess`` = dmin / 2."""
    head = wpoints.orderBy("idx").limit(m).select(F.col("idx").alias("point_id"), "features")
    return closest_pair(head, m).select(
        F.col("min_distance").alias("dmin"), F.col("min_positive").alias("dpos"),
        F.expr("coalesce(min_distance / 2, 0D)").alias("initial_guess"))


def spread_frame(wpoints: DataFrame) -> DataFrame:
    """One row: row count, number of ids, first point, smallest and largest
    dimension, smallest weight, and the diagonal of the bounding box (an upper bound on every pair
    distance). Partial aggregates per coordinate, so the shuffle is tiny."""
    coords = (wpoints.selectExpr("posexplode(features) AS (pos, x)")
                     .groupBy("pos").agg(F.expr("max(x) - min(x) AS span")))
    diag = coords.agg(F.expr("sqrt(sum(span * span)) AS diag"))
    sizes = wpoints.agg(F.expr("count(1) AS n"), F.expr("min(size(features)) AS dim_lo"),
                        F.expr("max(size(features)) AS dim_hi"), F.expr("min(weight) AS w_lo"),
                        F.expr("count(CASE WHEN weight IS NULL THEN 1 END) AS w_null"),
                        F.expr("count(DISTINCT idx) AS n_idx"), F.expr("min_by(features, idx) AS p0"))
    return sizes.unionByName(diag, allowMissingColumns=True)


def _nearest_positive(wpoints: DataFrame, p0: list[float]) -> float | None:
    d = euclidean(F.col("features"), F.lit(p0).cast("array<double>"))
    return wpoints.agg(F.min(F.when(d > 0, d)).alias("near")).first()["near"]


def guess_series(r0: float, positive: float | None, diag: float, alpha: float) -> list[float]:
    """r0, 2 r0, 4 r0, ... up to the first radius whose removal ball spans the
    diameter bound. With r0 = 0 (copies in the window) the series is 0, then
    doubling from half the smallest positive distance (the reference would
    double 0 forever)."""
    if r0 > 0:
        base, guesses = r0, []
    else:
        base, guesses = (positive / 2 if positive else None), [0.0]
    if base is not None:
        reach = diag * (1 + 1e-9) / (removal_factor(alpha) * base)
        count = 1 + max(0, math.ceil(math.log2(reach))) if reach > 0 else 1
        r = base
        for _ in range(count):
            guesses.append(r)
            r *= 2
    return guesses


def prepare(wpoints: DataFrame, k: int, z: int, alpha: float) -> SolverInput:
    """Input checks, then r0 and the guess series: two small jobs (a third one
    only when the window holds nothing but copies of one point)."""
    check_k_z(k, z)
    check_alpha(alpha)
    rows = spread_frame(wpoints).collect()
    sizes = next(r for r in rows if r["n"] is not None)
    if not sizes["n"]:
        raise ValueError("k-center of an empty point set")
    if sizes["n_idx"] != sizes["n"]:
        raise ValueError(f"{sizes['n']} points share {sizes['n_idx']} ids")
    diag = next((r["diag"] for r in rows if r["diag"] is not None), 0.0)
    if sizes["dim_lo"] != sizes["dim_hi"]:
        raise ValueError(f"points of unequal dimension ({sizes['dim_lo']} and {sizes['dim_hi']})")
    if sizes["w_null"] or sizes["w_lo"] is None or sizes["w_lo"] < 0:
        raise ValueError("weights must be non-negative and not null")
    win = window_radius_frame(wpoints, k + z + 1).first()
    r0 = win["dmin"] / 2 if win["dmin"] is not None else 0.0
    positive = win["dpos"]
    if r0 == 0 and positive is None and diag > 0:
        positive = _nearest_positive(wpoints, list(sizes["p0"]))
    return SolverInput(n_rows=sizes["n"], dim=sizes["dim_hi"], initial_guess=r0,
                       guesses=guess_series(r0, positive, diag, alpha))


STATE_ROWS_PER_PARTITION = 200_000


def initial_state(wpoints: DataFrame, guesses: list[float], n_rows: int | None = None) -> DataFrame:
    """One row per (guess, point): everything uncovered, no center yet. With
    ``n_rows`` known, the state gets a number of partitions sized to it (a
    small coreset state is one task per stage, not one per shuffle slot)."""
    radii = F.array(*[F.lit(float(r)) for r in guesses])
    if n_rows is not None:
        parts = max(1, math.ceil(n_rows * len(guesses) / STATE_ROWS_PER_PARTITION))
        wpoints = wpoints.repartition(parts)
    return (wpoints
            .select("idx", "point_id", "features", "weight",
                    F.posexplode(radii).alias("guess", "radius"))
            .withColumn("uncovered", F.lit(True))
            .withColumn("center_step", F.lit(None).cast("int"))
            .withColumn("steps_done", F.lit(0)))


def ball_weights(state: DataFrame, alpha: float, n_rows: int,
                 block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """``(guess, idx, point_id, ball_weight)`` for every uncovered point: the
    uncovered weight within (1+2a) * radius of it, itself included
    (``robustagg.operators.balls``: numpy on bounded blocks, Spark shuffles
    and sums)."""
    unc = state.where("uncovered")
    return ball_weights_blocked(unc, selection_factor(alpha), n_rows, block_rows)


def best_ball(weights: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """``(guess, c_idx, c_features)``: the heaviest ball per guess, ties to the
    smaller idx; guesses whose uncovered weight is 0 get no row. When the
    weights carry no coordinates they are looked up in ``state`` by streaming
    it past the winners (one row per guess, broadcast)."""
    order = F.struct(F.col("ball_weight"), -F.col("idx"))
    has_features = "features" in weights.columns
    pick = F.struct("idx", "features") if has_features else F.struct("idx")
    # The positivity test is applied after the aggregate so that Catalyst does
    # not push it below the ball-weight projection and evaluate that twice.
    best = (weights.groupBy("guess")
                   .agg(F.max_by(pick, order).alias("c"), F.max("ball_weight").alias("top"))
                   .where(F.col("top") > 0))
    if has_features:
        return best.select("guess", F.col("c.idx").alias("c_idx"),
                           F.col("c.features").alias("c_features"))
    if state is None:
        raise ValueError("best_ball needs the state to look the centers up")
    winners = best.select("guess", F.col("c.idx").alias("c_idx"))
    return (state.select("guess", F.col("idx").alias("c_idx"), F.col("features").alias("c_features"))
                 .join(F.broadcast(winners), ["guess", "c_idx"]))


def _double(x: float) -> str:
    return f"{float(x)!r}D"


def cover_step(state: DataFrame, best: DataFrame, alpha: float, more: tuple[str, ...] = ()) -> DataFrame:
    """One greedy step: mark the new centers (``best``: guess, c_idx,
    c_features; one row per guess, broadcast) and remove their (3+4a) *
    radius balls from the uncovered set; guesses without a new center keep
    their state. The step counter is a column, so every step compiles to the
    same generated code; the projection is SQL text, parsed once in the JVM
    (the same expressions as ``robustagg.functions.distance``)."""
    joined = state.join(F.broadcast(best), "guess", "left")
    dist = euclidean_sql("features", "c_features")
    reach = f"{_double(removal_factor(alpha))} * radius"
    return joined.selectExpr(
        "idx", "point_id", "features", "weight", "guess", "radius",
        f"uncovered AND (c_idx IS NULL OR {dist} > {reach}) AS uncovered",
        "CAST(CASE WHEN idx = c_idx THEN steps_done + 1 ELSE center_step END AS INT)"
        " AS center_step",
        "CAST(steps_done + 1 AS INT) AS steps_done", *more)


def greedy_cover(state: DataFrame, k: int, alpha: float, n_rows: int,
                 block_rows: int = DEFAULT_BLOCK_ROWS, steps: int | None = None) -> DataFrame:
    """Run up to k greedy steps for every guess; returns the checkpointed
    final state. Stops early once no guess has uncovered weight left (an
    observed metric of the checkpoint job itself, no extra job)."""
    return greedy_cover_observed(state, k, alpha, n_rows, block_rows, steps)[0]


def _step_metrics(n_guesses: int) -> list[Column]:
    unc = "CASE WHEN uncovered THEN weight ELSE 0 END"
    cols = [F.expr(f"sum({unc}) AS w")]
    for g in range(n_guesses):
        cols.append(F.expr(f"sum(CASE WHEN guess = {g} THEN {unc} ELSE 0 END) AS w{g}"))
        cols.append(F.expr(f"count(CASE WHEN guess = {g} THEN center_step END) AS c{g}"))
    return cols


def greedy_cover_observed(state: DataFrame, k: int, alpha: float, n_rows: int,
                          block_rows: int = DEFAULT_BLOCK_ROWS, steps: int | None = None,
                          n_guesses: int = 0, z: int | None = None) -> tuple[DataFrame, dict]:
    """``greedy_cover`` that also returns the metrics observed on the last
    checkpoint job: total uncovered weight ``w`` and, for each of the first
    ``n_guesses`` guesses, its uncovered weight ``w<g>`` and number of centers
    ``c<g>`` (the radius search without another job). With ``z`` given, guesses
    above one that already leaves at most z are dropped: they cannot win."""
    ensure_checkpoint_dir(state.sparkSession)
    last = steps or k
    seen = Observation("greedy_steps")
    if n_rows <= block_rows:
        # One block per guess: all its steps in one task, all guesses in one job.
        state = cover_single_blocks(state, last, selection_factor(alpha), removal_factor(alpha))
        return state.observe(seen, *_step_metrics(n_guesses)).checkpoint(), seen.get
    return _cover_cells(state, last, alpha, block_rows, n_guesses, z)


def _cover_cells(state: DataFrame, last: int, alpha: float, block_rows: int, n_guesses: int,
                 z: int | None) -> tuple[DataFrame, dict]:
    """Greedy steps beyond one block. The state carries the ball weights; a step
    subtracts what the points it newly covers (``newly``) had added."""
    first = state.select("features").first()
    if first is None:
        return state, {}
    origin = list(first["features"])
    as_rows = lambda df: df.select(F.col("guess").alias("grp"), F.col("idx").alias("id"), "features", "weight")
    reach = state.groupBy(F.col("guess").alias("grp")).agg((F.max("radius") * selection_factor(alpha)).alias("r"))
    keyed = lambda sums: sums.select(F.col("grp").alias("guess"), F.col("id").alias("idx"), "ball_weight")
    unc = as_rows(state.where("uncovered"))
    sums = keyed(ball_weights_cells(unc, None, reach, origin, block_rows))
    state = (state.join(sums, ["guess", "idx"], "left")
             .withColumn("ball", F.coalesce("ball_weight", F.lit(0))).drop("ball_weight")
             .withColumn("newly", F.lit(False)).checkpoint())
    metrics: dict = {}
    for step in range(1, last + 1):
        if step > 1:
            live, newly = state.where("uncovered"), state.where("newly")
            lost = keyed(ball_weights_cells(as_rows(newly), as_rows(live), reach, origin, block_rows))
            state = (state.join(lost, ["guess", "idx"], "left")
                     .withColumn("ball", F.col("ball") - F.coalesce("ball_weight", F.lit(0))).drop("ball_weight").checkpoint())
        best = best_ball(state.where("uncovered").select("guess", "idx", "features", F.col("ball").alias("ball_weight")))
        nxt = cover_step(state.withColumn("was", F.col("uncovered")), best, alpha, ("ball", "was"))
        nxt = nxt.withColumn("newly", F.col("was") & ~F.col("uncovered")).drop("was")
        seen = Observation(f"greedy_step_{step}")
        state = nxt.observe(seen, *_step_metrics(n_guesses)).checkpoint()
        metrics = seen.get
        if step < last and not metrics.get("w"):
            break
        if z is not None and step < last:
            good = next((g for g in range(n_guesses) if (metrics.get(f"w{g}") or 0) <= z), n_guesses)
            if good < n_guesses - 1:
                state, n_guesses = state.where(F.col("guess") <= F.lit(good)), good + 1
    return state.drop("ball", "newly"), metrics


def radius_search(state: DataFrame, z: int) -> DataFrame:
    """Per guess: radius, uncovered weight, number of centers and whether the
    cover leaves at most z uncovered weight."""
    return (state.groupBy("guess", "radius")
                 .agg(F.sum(F.when(F.col("uncovered"), F.col("weight")).otherwise(F.lit(0)))
                       .cast("long").alias("uncovered_weight"),
                      F.count("center_step").alias("centers"))
                 .withColumn("ok", F.col("uncovered_weight") <= F.lit(int(z))))


def weighted_kcenter(wpoints: DataFrame, k: int, z: int, alpha: float,
                     block_rows: int = DEFAULT_BLOCK_ROWS) -> KCenterResult:
    """Solve weighted k-center with z outliers on ``(idx, point_id, features,
    weight)``. Quadratic in the number of rows: pass a coreset."""
    prep = prepare(wpoints, k, z, alpha)
    n_guesses = len(prep.guesses)
    state, seen = greedy_cover_observed(initial_state(wpoints, prep.guesses, prep.n_rows), k,
                                        alpha, prep.n_rows, block_rows, n_guesses=n_guesses, z=z)
    per_guess = radius_search(state, z)
    # Per-guess uncovered weight and center count were observed on the last
    # step's job: the driver picks the smallest guess that leaves <= z.
    g = next((g for g in range(n_guesses) if (seen.get(f"w{g}") or 0) <= z), None)
    if g is None:
        raise RuntimeError("no radius guess covered the points; the diameter bound failed")
    solution = (state.where((F.col("guess") == F.lit(g)) & F.col("center_step").isNotNull())
                     .select(F.col("center_step").alias("step"), "point_id", "features")
                     .orderBy("step"))
    chosen = solution.collect()  # at most k rows, once
    centers = ([c["point_id"] for c in chosen], [list(c["features"]) for c in chosen])
    return KCenterResult(state=state, per_guess=per_guess, solution=solution,
                         initial_guess=prep.initial_guess, final_guess=prep.guesses[g],
                         guesses=g + 1, solution_size=int(seen.get(f"c{g}") or 0),
                         n_rows=prep.n_rows, centers=centers)


def unit_weighted(points: DataFrame) -> DataFrame:
    """Raw points in point-id order, weight 1 each (the sequential solver)."""
    return points.select(F.col("point_id").alias("idx"), "point_id", features_column(),
                         F.lit(1).cast("long").alias("weight"))


def coreset_weighted(core: DataFrame, m: int) -> DataFrame:
    """Coreset rows in (part, pick) order: idx = part * m + pick."""
    return core.select((F.col("part").cast("long") * F.lit(int(m)) + F.col("pick")).alias("idx"),
                       "point_id", features_column(), "weight")


def kcenter_exact(points: DataFrame, k: int, z: int, alpha: float = 0.0, **kw) -> KCenterResult:
    """The sequential algorithm on all points (unit weights). O(n^2) distance
    evaluations per step: meant for inputs of bounded size."""
    return weighted_kcenter(unit_weighted(points), k, z, alpha, **kw)
