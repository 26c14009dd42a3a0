"""Types of point columns, and the operators that leave distances out: same results, fewer distances."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import point_frame
from robustagg.operators import balls, cells, closest
from robustagg.operators import coreset as cs
from robustagg.operators import kcenter as kc
from robustagg.operators.objective import assign_to_centers, objective
from robustagg.operators.traversal import traverse
from robustagg.plans.two_round import two_round_kcenter, two_round_summary
from robustagg.sources.points import parse_points
from robustagg.sources.store import store_points


def clusters(n, k, dim=2, seed=3):
    rng = np.random.default_rng(seed)
    return rng.uniform(0, 1000, (k, dim))[rng.integers(0, k, n)] + rng.normal(0, 1, (n, dim))


def frame(spark, x):
    return point_frame(spark, list(enumerate(x.tolist())))


@pytest.fixture(scope="module")
def kinds(spark):
    """The same points as arrays without nulls, of floats and of integers."""
    base = spark.range(240).select(F.col("id").alias("point_id"), (F.col("id") * 37 % 101).alias("a"), (F.col("id") % 13).alias("b"))
    made = {t: base.select("point_id", F.array(*(F.coalesce(F.col(c).cast(t), F.lit(0).cast(t)) for c in "ab")).alias("features"))
            for t in ("double", "float", "int")}
    made["nullable"] = spark.createDataFrame(made["double"].collect(), "point_id long, features array<double>")
    assert not made["double"].schema["features"].dataType.containsNull
    return made


@pytest.mark.parametrize("kind", ["double", "float", "int"])
@pytest.mark.parametrize("bound", ["auto", 20])
def test_point_types_on_both_sides_of_the_part_bound(kinds, kind, bound):
    rows = lambda t: sorted(map(tuple, cs.coreset(kinds[t], 7, 3, max_part_rows=bound).collect()))
    assert rows(kind) == rows("nullable")


@pytest.mark.parametrize("kind", ["double", "float", "int"])
def test_point_types_in_solvers_and_assignment(kinds, kind):
    for block_rows in (4096, 50) if kind == "double" else (4096,):
        got = kc.kcenter_exact(kinds[kind], 3, 4, block_rows=block_rows)
        assert got.centers == kc.kcenter_exact(kinds["nullable"], 3, 4).centers
    want = two_round_summary(two_round_kcenter(kinds["nullable"], 3, 4, 4)).collect()
    assert two_round_summary(two_round_kcenter(kinds[kind], 3, 4, 4)).collect() == want
    a = assign_to_centers(kinds[kind], got.solution, got.centers)
    assert a.count() == 240 and objective(kinds[kind], got.solution, 4, got.centers).first()[0] > 0
    core = cs.coreset(kinds[kind], 5, 2)
    assert cs.nearest_pick(kinds[kind], core, 2).count() == 240


def test_even_parts_whatever_the_ids(spark):
    p = spark.range(403).select((F.col("id") * 8).alias("point_id"), F.array(F.col("id").cast("double")).alias("features"))
    sizes = [r["count"] for r in cs.with_parts(p, 8).groupBy("part").count().collect()]
    assert len(sizes) == 8 and max(sizes) - min(sizes) == 1
    dense = p.withColumn("point_id", F.col("point_id") / 8 + 100)
    sizes = [r["count"] for r in cs.with_parts(dense, 8).groupBy("part").count().collect()]
    assert max(sizes) - min(sizes) == 1


def test_text_points_are_parsed_once_and_fail_there(spark):
    acc = spark.sparkContext.accumulator(0)

    def seen(line: str) -> str:
        acc.add(1)
        return line
    lines = spark.range(300).select(F.col("id").alias("point_id"), F.concat_ws(",", "id", F.col("id") % 7).alias("value"))
    once = F.udf(seen, "string").asNondeterministic()
    res = two_round_kcenter(parse_points(lines.withColumn("value", once("value"))), 3, 5, 2)
    two_round_summary(res).collect()
    res.core.count()
    assert acc.value == 300
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        store_points(parse_points(lines.withColumn("value", F.when(F.col("point_id") == 7, "1,x").otherwise(F.col("value")))))
    for bad in ("array(1D, null)", "array(1D, double('nan'))", "null", "array(1D)"):
        rows = spark.range(9).selectExpr("id as point_id", f"case when id = 4 then {bad} else array(1D, 2D) end as features")
        with pytest.raises(ValueError):
            store_points(rows)


def test_traversal_rounds_touch_few_cells(spark):
    x = clusters(6000, 40)
    p = frame(spark, x).withColumns({"part": F.lit(0), "weight": F.lit(1).cast("long")})
    seen: dict = {}
    got = traverse(p, 60, [0.0, 0.0], cell_rows=50, seen=seen).orderBy("pick").collect()
    picks, assign = cs.farthest_first(x, 60)
    assert [r["point_id"] for r in got] == picks
    assert [r["weight"] for r in got] == np.bincount(assign, minlength=60).tolist()
    later = seen["touched"][1:]
    assert seen["rounds"] < 60 and seen["touched"][0] == seen["cells"] and min(later) < seen["cells"] / 4
    assert sum(later) < seen["cells"] * 59 / 4  # one pass over everything per pick would be 59


def test_traversal_with_ties_copies_and_weights(spark):
    grid = [(i, [float(i % 9), float(i // 9 % 9)]) for i in range(400)]
    p = point_frame(spark, grid).withColumns({"part": (F.col("point_id") % 2).cast("int"), "weight": F.col("point_id") % 3})
    got = traverse(p, 30, [0.0, 0.0], cell_rows=16, candidates=3, pool=8).collect()
    for part in (0, 1):
        mine = [g for g in grid if g[0] % 2 == part]
        x = np.array([g[1] for g in mine])
        picks, assign = cs.farthest_first(x, 30)
        weight = np.bincount(assign, [g[0] % 3 for g in mine], minlength=len(picks))
        want = [(mine[i][0], int(w)) for i, w in zip(picks, weight, strict=True)]
        assert [(r["point_id"], r["weight"]) for r in sorted(got, key=lambda r: r["pick"]) if r["part"] == part] == want


def test_ball_weights_leave_out_far_and_settle_near_cells(spark):
    x = clusters(3000, 30)
    p = frame(spark, x).select(F.lit(0).alias("guess"), F.lit(20.0).alias("radius"), F.col("point_id").alias("idx"), "point_id",
                               "features", (F.col("point_id") % 5).alias("weight"))
    both = p.unionByName(p.withColumns({"guess": F.lit(1), "radius": F.lit(2.0)}))
    seen: dict = {}
    got = balls.ball_weights_blocked(both, 1.0, 6000, 64, seen).collect()
    assert len(got) == 6000 and seen["distances"] < 2 * 3000 ** 2 / 2
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    for guess, r in ((0, 20.0), (1, 2.0)):
        want = (d <= r) @ (np.arange(3000) % 5)
        assert {g["idx"]: g["ball_weight"] for g in got if g["guess"] == guess} == dict(enumerate(want.tolist()))


def test_greedy_steps_compare_a_pair_at_most_twice():
    rng = np.random.default_rng(5)
    for _ in range(20):
        n = int(rng.integers(1, 120))
        x, w, idx = rng.integers(0, 12, (n, 2)).astype(float), rng.integers(0, 4, n), rng.permutation(n)
        counted: list[int] = []
        left, step_of = balls.cover_block(x, idx, w, 1.5, 6, 1.0, 3.0, np.ones(n, bool), counted)
        assert counted[0] <= 2 * n * n
        live, steps = np.ones(n, bool), np.zeros(n, int)
        for step in range(1, 7):  # plain greedy
            d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
            ball = np.where(live, ((d <= 1.5) & live) @ w, -1)
            if ball.max() <= 0:
                break
            c = min(np.flatnonzero(ball == ball.max()), key=lambda i: idx[i])
            steps[c] = step
            live &= d[c] > 4.5
        assert (left == live).all() and (step_of == steps).all()


def test_greedy_cells_equal_one_block(spark):
    w = kc.unit_weighted(frame(spark, clusters(700, 12)))
    prep = kc.prepare(w, 5, 10, 0.0)
    state = kc.initial_state(w, prep.guesses, prep.n_rows)
    rows = lambda b: sorted(map(tuple, kc.greedy_cover(state, 3, 0.0, prep.n_rows, b).select(
        "guess", "idx", "uncovered", "center_step").collect()), key=str)
    assert rows(4096) == rows(60)


def test_closest_pair(spark):
    rng = np.random.default_rng(9)
    x = rng.uniform(0, 1, (100_000, 2))
    big = spark.createDataFrame(__import__("pandas").DataFrame({"point_id": np.arange(len(x)), "features": x.tolist()}))
    got = closest.closest_pair(big, len(x)).first()
    counted: list[int] = []
    assert got["min_distance"] == got["min_positive"] == closest.closest_in(x, counted)[1]
    for dim in (1, 3, 20):
        y = rng.integers(0, 50, (300, dim)).astype(float)
        d = np.sqrt(((y[:, None] - y[None]) ** 2).sum(-1))[np.triu_indices(300, 1)]
        for block in (4096, 40):
            got = closest.closest_pair(frame(spark, y), 300, block, 8).first()
            assert got["min_distance"] == pytest.approx(d.min(), abs=1e-12) and got["min_positive"] == pytest.approx(d[d > 0].min())
    same = point_frame(spark, [(i, [1.0, 1.0]) for i in range(30)])
    for block in (4096, 7):
        assert tuple(closest.closest_pair(same, 30, block).first()) == (0.0, None)
        assert tuple(closest.closest_pair(same.limit(1), 30, block).first()) == (None, None)


def test_center_index_rules_most_centers_out():
    rng = np.random.default_rng(2)
    base = rng.normal(size=(100, 64))
    centers = base[rng.integers(0, 100, 10_000)] + rng.normal(0, 0.02, (10_000, 64))
    x = base[rng.integers(0, 100, 300)] + rng.normal(0, 0.02, (300, 64))
    counted: list[int] = []
    pos, best = balls.CenterIndex(centers).nearest(x, counted)
    plain, dist = balls.nearest_of(x, centers)
    assert (pos == plain).all() and (best == dist).all() and counted[0] * 3 <= len(x) * len(centers)
    grid = rng.integers(0, 4, (200, 2)).astype(float)  # ties and copies: the earlier center
    pos, best = balls.CenterIndex(grid).nearest(grid)
    plain, dist = balls.nearest_of(grid, grid)
    assert (pos == plain).all() and (best == dist).all()


def test_cells_hold_every_point_once(spark):
    x = clusters(1000, 3, 3)
    p = frame(spark, x).select((F.col("point_id") % 2).alias("grp"), F.col("point_id").alias("id"), "features", F.lit(2).alias("weight"))
    got = cells.build_cells(p, [0.0, 0.0, 0.0], 32).collect()
    assert sorted(i for r in got for i in r["ids"]) == list(range(1000)) and sum(r["weight"] for r in got) == 2000
    for r in got:
        own = x[r["ids"]]
        assert r["n"] == len(own) <= 32 and {i % 2 for i in r["ids"]} == {r["grp"]}
        d = np.sqrt(((own - np.array(r["center"])) ** 2).sum(1))
        assert d.max() <= r["radius"] * (1 + 1e-12)
        to = np.sqrt((own ** 2).sum(1))
        assert r["low"] <= to.min() + 1e-9 and to.max() <= r["high"] + 1e-9
