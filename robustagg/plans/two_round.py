"""Two-round k-center with z outliers.

The points are stored once in the checkpoint folder (a text is parsed once, bad
points fail there); their count, dimension and id range come with that write.

Round 1: one shuffle spreads the points over L parts; each part yields m =
k+z+1 farthest-first picks weighted by the points nearest to them (the
coreset, at most m * L rows). The coreset is stored: it is read by the
solver several times and must not recompute the scan.

Round 2: the weighted greedy cover with radius search on the coreset
(``alpha`` = 2 by default), run as Spark jobs over the stored coreset.

Objective: a second, map-only pass over the stored points (Arrow kernel).
Nothing but scalars and the k centers reaches the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from robustagg.operators.coreset import compress, coreset, parts_for, rows_per_part
from robustagg.operators.kcenter import (
    KCenterResult, coreset_weighted, kcenter_exact, weighted_kcenter,
)
from robustagg.operators.objective import objective
from robustagg.params import check_k_z, check_parts
from robustagg.sources.store import store_points, stored


@dataclass
class TwoRoundResult:
    core: DataFrame
    solve: KCenterResult
    objective: DataFrame
    parts: int
    k: int
    z: int
    levels: int = 1


def two_round_kcenter(points: DataFrame, k: int, z: int, parts: int | None = None,
                      alpha: float = 2.0, by: str = "rank",
                      max_part_rows: int | None = None, levels: int = 1,
                      **solver_kw) -> TwoRoundResult:
    """Round 1 (coreset over ``parts`` parts; chosen from the point count when
    ``None`` so that no part exceeds ``max_part_rows``, by default what a
    256 MB part holds at the data's dimension), then round 2 on the
    coreset. The same L gives the same result whether it was given or chosen.
    ``levels`` > 1 asks for further farthest-first levels over the coreset
    before round 2 (a smaller solver input; the approximation loosens by a
    constant per level); nothing adds levels by itself."""
    check_k_z(k, z)
    if levels < 1:
        raise ValueError(f"levels must be >= 1, got {levels}")
    m = k + z + 1
    # The input is read (and text parsed) once; what follows reads columns back.
    points, stats = store_points(points)
    if parts is None:
        max_part_rows = max_part_rows or rows_per_part(stats.dim)
        parts = parts_for(stats.n, k, z, max_part_rows)
    check_parts(parts)
    core = stored(coreset(points, m, parts, by, max_part_rows=max_part_rows or "auto", stats=stats))
    if levels > 1:
        core, _ = compress(core, m, parts, levels - 1, max_part_rows=max_part_rows or "auto")
    solve = weighted_kcenter(coreset_weighted(core, m), k, z, alpha, **solver_kw)
    obj = objective(points, solve.solution, z, solve.centers)
    return TwoRoundResult(core=core, solve=solve, objective=obj, parts=parts, k=k, z=z,
                          levels=levels)


def summary_frame(solve: KCenterResult, obj: DataFrame, n: int, k: int, z: int,
                  parts: int | None) -> DataFrame:
    """One row: n, k, z, l, initial_guess, final_guess, guesses,
    solution_size, objective."""
    return obj.select(
        F.lit(int(n)).cast("long").alias("n"),
        F.lit(int(k)).alias("k"),
        F.lit(int(z)).alias("z"),
        F.lit(parts).cast("int").alias("l"),
        F.lit(float(solve.initial_guess)).alias("initial_guess"),
        F.lit(float(solve.final_guess)).alias("final_guess"),
        F.lit(int(solve.guesses)).alias("guesses"),
        F.lit(int(solve.solution_size)).alias("solution_size"),
        F.col("objective"))


def two_round_summary(res: TwoRoundResult) -> DataFrame:
    # n = total coreset weight = number of input points (no extra pass).
    n = res.core.agg(F.sum("weight")).first()[0]
    return summary_frame(res.solve, res.objective, n, res.k, res.z, res.parts)


def exact_summary(points: DataFrame, k: int, z: int, alpha: float = 0.0) -> DataFrame:
    solve = kcenter_exact(points, k, z, alpha)
    obj = objective(points, solve.solution, z, solve.centers)
    return summary_frame(solve, obj, solve.n_rows, k, z, None)
