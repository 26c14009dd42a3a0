import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF01, point_frame
from robustagg.operators import kcenter as kc
from robustagg.operators.objective import kth_largest, objective
from robustagg.plans.two_round import two_round_kcenter
from robustagg.sources import points as pts
import robustagg.operators.objective as objmod


def _ids(res):
    return [r.point_id for r in res.solution.collect()]


@pytest.mark.parametrize("alpha,r0,final,guesses,centers,obj", [
    (2.0, 603.95, 603.95, 1, [1337, 604, 1368, 380], 4159.842425),
    (0.0, 603.95, 1207.9, 2, [804, 871, 43, 1427, 1101, 103, 819], 3252.674131),
])
def test_fixture_two_round(spark, alpha, r0, final, guesses, centers, obj):
    p = pts.customer_points(spark, SF01)
    res = two_round_kcenter(p, 8, 40, 4, alpha)
    assert round(res.solve.initial_guess, 6) == r0
    assert round(res.solve.final_guess, 6) == final
    assert res.solve.guesses == guesses
    assert _ids(res.solve) == centers
    # the centers observed on the last step's job are the solution's
    assert res.solve.centers[0] == centers
    assert res.solve.centers[1] == [list(r.features) for r in res.solve.solution.collect()]
    assert round(res.objective.first()[0], 6) == obj


@pytest.mark.parametrize("k,z,r0,final,guesses,centers,obj", [
    (3, 5, 498.596529, 1994.386117, 3, [88, 51, 74], 4247.558735),
    (5, 10, 201.060151, 1608.481210, 4, [42, 51, 61, 23], 3324.806160),
])
def test_fixture_exact(spark, k, z, r0, final, guesses, centers, obj):
    p = pts.supplier_points(spark, SF01)
    res = kc.kcenter_exact(p, k, z, 0.0)
    assert (round(res.initial_guess, 6), round(res.final_guess, 6), res.guesses) == (r0, final, guesses)
    assert _ids(res) == centers
    assert round(objective(p, res.solution, z).first()[0], 6) == obj


def _brute_optimum(x, k, z):
    best = np.inf
    for c in itertools.combinations(range(len(x)), k):
        d = np.min(np.linalg.norm(x[:, None, :] - x[None, list(c), :], axis=2), axis=1)
        best = min(best, np.sort(d)[len(x) - 1 - z])
    return best


def _numpy_greedy(x, w, k, z, alpha):
    """Straight transcription of the definition (for the property tests)."""
    n = len(x)
    dist = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2))
    m = min(n, k + z + 1)
    win = dist[:m, :m][~np.eye(m, dtype=bool)]
    r = win.min() / 2
    while True:
        unc = np.ones(n, bool)
        centers = []
        while len(centers) < k and w[unc].sum() > 0:
            bw = [(w[unc & (dist[i] <= (1 + 2 * alpha) * r)].sum() if unc[i] else -1) for i in range(n)]
            c = int(np.argmax(bw))
            centers.append(c)
            unc &= ~(dist[c] <= (3 + 4 * alpha) * r)
        if w[unc].sum() <= z:
            return centers, r
        r *= 2


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_against_definition_and_bound(spark, seed):
    rng = np.random.default_rng(seed)
    x = np.round(rng.uniform(0, 10, size=(9, 2)), 3)
    rows = [(i, x[i]) for i in range(len(x))]
    df = point_frame(spark, rows)
    k, z = 2, 2
    res = kc.kcenter_exact(df, k, z, 0.0)
    want, r = _numpy_greedy(x, np.ones(len(x), dtype=np.int64), k, z, 0.0)
    assert _ids(res) == want
    assert res.final_guess == pytest.approx(r)
    got = objective(df, res.solution, z).first()[0]
    assert got <= 6 * _brute_optimum(x, k, z) + 1e-9
    # the answer is the first guess that works, and it really works
    per = sorted(res.per_guess.collect(), key=lambda r: r.guess)
    assert per[res.guesses - 1].ok and not any(p.ok for p in per[:res.guesses - 1])


def _ball_weights_expr(state, alpha):
    """Ball weights with Spark higher-order functions only (one member array
    per guess): an independent cross-check for small inputs."""
    from robustagg.functions.distance import euclidean
    unc = state.where("uncovered")
    members = (unc.groupBy("guess")
                  .agg(F.collect_list(F.struct("features", "weight")).alias("members")))
    cand = unc.select("guess", "radius", "idx", "point_id", F.col("features").alias("cf"))
    limit = F.lit(kc.selection_factor(alpha)) * F.col("radius")
    within = F.aggregate(
        F.filter("members", lambda mb: euclidean(mb["features"], F.col("cf")) <= limit),
        F.lit(0).cast("long"), lambda acc, mb: acc + mb["weight"])
    return cand.join(members, "guess").select("guess", "idx", "point_id",
                                              within.alias("ball_weight"))


def test_blocked_and_expression_paths_agree(spark):
    p = pts.supplier_points(spark, SF01)
    w = kc.unit_weighted(p)
    prep = kc.prepare(w, 3, 5, 0.0)
    st = kc.initial_state(w, prep.guesses, prep.n_rows)
    cols = ["guess", "idx", "point_id", "ball_weight"]
    a = kc.ball_weights(st, 0.0, prep.n_rows).select(cols)
    b = kc.ball_weights(st, 0.0, prep.n_rows, block_rows=16).select(cols)
    c = _ball_weights_expr(st, 0.0).select(cols)
    for other in (b, c):
        assert a.exceptAll(other).count() == 0 and other.exceptAll(a).count() == 0
    full = kc.kcenter_exact(p, 3, 5, 0.0, block_rows=16)
    assert _ids(full) == [88, 51, 74]


def test_input_order_does_not_matter(spark):
    p = pts.supplier_points(spark, SF01)
    shuffled = p.repartition(7, F.rand(11))
    assert _ids(kc.kcenter_exact(shuffled, 3, 5, 0.0)) == [88, 51, 74]


def test_single_point(spark):
    df = point_frame(spark, [(3, [1.0, 2.0])])
    res = kc.kcenter_exact(df, 2, 0)
    assert _ids(res) == [3] and res.initial_guess == 0.0 and res.final_guess == 0.0
    assert objective(df, res.solution, 0).first()[0] == 0.0


def test_copies_in_window(spark):
    # the first k+z+1 points are copies: r0 = 0; 0 is tried first, then doubling
    rows = [(i, [0.0, 0.0]) for i in range(4)] + [(10, [5.0, 0.0]), (11, [5.0, 1.0])]
    df = point_frame(spark, rows)
    res = kc.kcenter_exact(df, 1, 1)
    assert res.initial_guess == 0.0
    assert res.final_guess > 0 and res.guesses >= 2
    assert _ids(res) == [0]
    all_copies = point_frame(spark, [(i, [2.0, 2.0]) for i in range(5)])
    res2 = kc.kcenter_exact(all_copies, 1, 0)
    assert _ids(res2) == [0] and res2.guesses == 1 and res2.final_guess == 0.0


def test_doubling_and_ties(spark):
    # collinear 0, 1, 2: r0 = 0.5 leaves one point out, 2 * r0 takes all
    df = point_frame(spark, [(1, [0.0, 0.0]), (2, [1.0, 0.0]), (3, [2.0, 0.0])])
    res = kc.kcenter_exact(df, 1, 0)
    assert round(res.initial_guess, 9) == 0.5 and res.final_guess == 1.0 and res.guesses == 2
    assert _ids(res) == [2]
    # equal ball weights: the lower id wins, in both clusters
    df2 = point_frame(spark, [(1, [0.0, 0.0]), (2, [1.0, 0.0]), (3, [10.0, 0.0]), (4, [11.0, 0.0])])
    res2 = kc.kcenter_exact(df2, 2, 0)
    assert _ids(res2) == [1, 3] and res2.guesses == 1


def test_n_not_above_z(spark):
    df = point_frame(spark, [(1, [0.0]), (2, [1.0])])
    res = kc.kcenter_exact(df, 1, 2)
    assert objective(df, res.solution, 2).first()[0] is None


def test_bad_arguments(spark):
    df = point_frame(spark, [(1, [0.0]), (2, [1.0])])
    for k, z, a in ((0, 1, 0.0), (1, -1, 0.0), (1, 1, -0.5)):
        with pytest.raises(ValueError):
            kc.kcenter_exact(df, k, z, a)
    bad = point_frame(spark, [(1, [0.0, 1.0]), (2, [1.0])])
    with pytest.raises(ValueError):
        kc.kcenter_exact(bad, 1, 0)
    negative = kc.unit_weighted(df).withColumn("weight", F.lit(-1).cast("long"))
    with pytest.raises(ValueError):
        kc.weighted_kcenter(negative, 1, 0, 0.0)


def test_kth_largest_both_paths(spark, monkeypatch):
    df = spark.range(1, 5001).select((F.col("id") * 1.0).alias("v"))
    assert kth_largest(df, "v", 1).first()[0] == 5000.0
    assert kth_largest(df, "v", 100).first()[0] == 4901.0
    monkeypatch.setattr(objmod, "TAKE_LIMIT", 10)
    assert kth_largest(df, "v", 100).first()[0] == 4901.0
    assert kth_largest(df, "v", 5000).first()[0] == 1.0
    assert kth_largest(df, "v", 5001).first()[0] is None


def test_kth_largest_ties_nulls_and_close_values(spark):
    rows = [3.0] * 50 + [None] * 5 + [1.0 + i * 2.0 ** -52 for i in range(40)] + [float(i) for i in range(10)]
    df = spark.createDataFrame([(v,) for v in rows], "v double")
    want = sorted((v for v in rows if v is not None), reverse=True)
    for k in (1, 7, 8, 30, 56, 57, 70, 97, 98, 100):
        assert kth_largest(df, "v", k, take_limit=3).first()[0] == want[k - 1]
    assert kth_largest(df, "v", 101, take_limit=3).first()[0] is None


def test_two_round_auto_parts_equal_given_parts(spark):
    p = pts.customer_points(spark, SF01)
    auto = two_round_kcenter(p, 4, 5, parts=None, max_part_rows=200)
    given = two_round_kcenter(p, 4, 5, parts=auto.parts)
    assert auto.parts >= 8 and auto.levels == given.levels == 1
    assert [r.point_id for r in auto.solve.solution.orderBy("step").collect()] == \
        [r.point_id for r in given.solve.solution.orderBy("step").collect()]
    assert auto.objective.first() == given.objective.first()


def test_two_round_levels_on_request(spark):
    p = pts.customer_points(spark, SF01)
    res = two_round_kcenter(p, 4, 5, parts=16, levels=2)
    assert res.levels == 2 and res.core.count() <= 4 * 10
    assert res.core.agg(F.sum("weight")).first()[0] == 1500
    assert 1 <= res.solve.solution_size <= 4 and res.objective.first()[0] is not None
    with pytest.raises(ValueError):
        two_round_kcenter(p, 4, 5, parts=16, levels=0)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_solver_step_plan_has_no_pair_join(spark):
    p = pts.supplier_points(spark, SF01)
    w = kc.unit_weighted(p)
    prep = kc.prepare(w, 3, 5, 0.0)
    st = kc.initial_state(w, prep.guesses, prep.n_rows).checkpoint()
    for block_rows in (4096, 16):
        bw = kc.ball_weights(st, 0.0, prep.n_rows, block_rows)
        step = kc.cover_step(st, kc.best_ball(bw, st), 0.0)
        plan = _plan(step)
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
        assert "FlatMapGroupsInArrow" in plan or "MapInArrow" in plan


def test_objective_plan_is_map_only_before_top(spark):
    p = pts.supplier_points(spark, SF01)
    res = kc.kcenter_exact(p, 3, 5, 0.0)
    plan = _plan(objective(p, res.solution, 5))
    assert "TakeOrderedAndProject" in plan
    assert "Join" not in plan


def test_nearest_pick_in_closure_and_as_a_stream(spark):
    from robustagg.operators import coreset as cs
    e = pts.embedding_points(spark, SF01)
    picks = cs.coreset(e, 6, 2).cache()
    small, large = cs.nearest_pick(e, picks, 2), cs.nearest_pick(e, picks, 2, closure_bytes=1)
    assert "Exchange" not in _plan(small) and "hashpartitioning(part" in _plan(large)
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, large.collect()))
    picks.unpersist()


def test_results_do_not_depend_on_shuffle_partitions(spark):
    from robustagg.operators import popularity as pop
    from robustagg.sources import transactions as tx
    p = pts.customer_points(spark, SF01)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    results = []
    try:
        for n in ("3", "13"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            res = two_round_kcenter(p.repartition(int(n)), 8, 40, 4, 2.0)
            top = pop.popularity_top_h(pop.product_popularity(
                pop.product_customer_pairs(tx.transactions_from_tables(spark, SF01))), 5)
            results.append((_ids(res.solve), round(res.objective.first()[0], 9),
                            [tuple(r) for r in top.orderBy("rank").collect()]))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert results[0] == results[1]
    assert results[0][0] == [1337, 604, 1368, 380]


@pytest.mark.parametrize("seed,alpha", [(4, 0.0), (5, 2.0), (6, 2.0)])
def test_weighted_random_against_definition(spark, seed, alpha):
    rng = np.random.default_rng(seed)
    x = np.round(rng.uniform(0, 10, size=(14, 2)), 3)
    w = rng.integers(1, 6, size=len(x))
    df = spark.createDataFrame(
        [(int(i), int(i), [float(v) for v in x[i]], int(w[i])) for i in range(len(x))],
        "idx long, point_id long, features array<double>, weight long")
    k, z = 3, 4
    res = kc.weighted_kcenter(df, k, z, alpha)
    want, r = _numpy_greedy(x, w.astype(np.int64), k, z, alpha)
    assert _ids(res) == want
    assert res.final_guess == pytest.approx(r)


def test_centers_in_blocks(spark):
    from robustagg.operators.objective import assign_to_centers
    p = pts.supplier_points(spark, SF01)
    res = kc.kcenter_exact(p, 5, 10, 0.0)
    one = {tuple(r) for r in assign_to_centers(p, res.solution, res.centers).collect()}
    blocks = {tuple(r) for r in assign_to_centers(p, res.solution, res.centers, center_bytes=16).collect()}
    assert blocks == one
    assert round(objective(p, res.solution, 10, res.centers).first()[0], 6) == 3324.80616
