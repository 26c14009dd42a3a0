import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF01, point_frame
from robustagg.operators import coreset as cs
from robustagg.sources import points as pts


def test_numpy_traversal_properties():
    rng = np.random.default_rng(7)
    x = rng.normal(size=(300, 3))
    picks, assign = cs.farthest_first(x, 20)
    assert len(picks) == len(set(picks)) == 20 and picks[0] == 0
    # the distance of each new pick to the earlier ones does not increase
    radii = []
    for t in range(1, len(picks)):
        d = np.min([np.linalg.norm(x[picks[t]] - x[p]) for p in picks[:t]])
        radii.append(d)
    assert all(a >= b - 1e-12 for a, b in zip(radii, radii[1:]))
    # every point is assigned to its nearest pick
    dist = np.array([[np.linalg.norm(x[i] - x[p]) for p in picks] for i in range(len(x))])
    assert (dist[np.arange(len(x)), assign] <= dist.min(axis=1) + 1e-12).all()


def test_traversal_stops_when_points_run_out():
    x = np.array([[0.0, 0.0]] * 5 + [[1.0, 0.0]] * 4 + [[0.0, 2.0]] * 3)
    picks, assign = cs.farthest_first(x, 10)
    assert len(picks) == 3
    assert np.bincount(assign).tolist() == [5, 3, 4]


def test_fixture_customer_coreset(spark):
    core = cs.coreset(pts.customer_points(spark, SF01), 49, 4).cache()
    assert core.count() == 196
    assert core.agg(F.sum("weight")).first()[0] == 1500
    first = core.where("part = 0").orderBy("pick").limit(6).collect()
    assert [(r.point_id, r.weight) for r in first] == [
        (0, 15), (1116, 2), (1368, 4), (380, 6), (628, 8), (1364, 2)]
    core.unpersist()


def test_fixture_embeddings_traversal(spark):
    picks = cs.farthest_first_centers(pts.embedding_points(spark, SF01), 6, 1)
    assert [r.point_id for r in picks.orderBy("pick").collect()] == [0, 188, 291, 152, 366, 49]


def test_small_parts_and_copies(spark):
    rows = [(i, [float(i % 3), 0.0]) for i in range(12)]   # three distinct points
    core = cs.coreset(point_frame(spark, rows), 5, 2).orderBy("part", "pick").collect()
    # part 0 holds ids 0,2,..,10 -> coordinates 0,2,1,0,2,1: three picks only
    part0 = [r for r in core if r.part == 0]
    assert [r.point_id for r in part0] == [0, 2, 4]
    assert sum(r.weight for r in core) == 12
    one = cs.coreset(point_frame(spark, [(5, [1.0, 1.0])]), 4, 3).collect()
    assert [(r.part, r.pick, r.point_id, r.weight) for r in one] == [(0, 0, 5, 1)]


def test_unequal_dimension_fails(spark):
    df = point_frame(spark, [(0, [0.0, 0.0]), (1, [1.0, 0.0, 2.0])])
    with pytest.raises(Exception):
        cs.coreset(df, 2, 1).collect()


def test_hash_parts_cover_all_points(spark):
    p = pts.customer_points(spark, SF01)
    core = cs.coreset(p, 10, 3, by="hash")
    assert core.agg(F.sum("weight")).first()[0] == 1500


def test_nearest_pick_matches_weights(spark):
    p = pts.customer_points(spark, SF01)
    core = cs.coreset(p, 12, 3).cache()
    near = cs.nearest_pick(p, core, 3)
    counts = {(r.part, r.center_id): r.n for r in
              near.groupBy("part", "center_id").agg(F.count("*").alias("n")).collect()}
    for r in core.collect():
        assert counts[(r.part, r.point_id)] == r.weight
    core.unpersist()


def test_parts_for():
    assert cs.parts_for(10, 2, 1) >= 1
    assert cs.parts_for(10_000_000, 8, 40, max_part_rows=1_000_000) >= 20


def test_auto_parts_stay_under_the_bound(spark):
    p = pts.customer_points(spark, SF01)
    bound = 100
    parts = cs.parts_for(1500, 4, 5, bound)
    sizes = (p.select(cs.part_column(parts, "hash").alias("part")).groupBy("part").count()
              .agg(F.max("count")).first()[0])
    assert sizes <= bound


def test_points_text_source(spark, tmp_path):
    f = tmp_path / "pts.txt"
    f.write_text("1.5,2\n3,4.25,\n")
    df = pts.read_points(spark, str(f)).orderBy("point_id").collect()
    assert [list(r.features) for r in df] == [[1.5, 2.0], [3.0, 4.25]]
    f2 = tmp_path / "bad.txt"
    f2.write_text("1.5,x\n")
    with pytest.raises(Exception):
        pts.read_points(spark, str(f2)).collect()


def test_pair_summary_blocked_equals_single(spark):
    from robustagg.operators.balls import pair_distance_summary
    p = pts.embedding_points(spark, SF01)
    one = pair_distance_summary(p).first()
    many = pair_distance_summary(p, block_rows=64).first()
    assert one.pairs == many.pairs == 124750
    assert round(one.min_distance, 6) == round(many.min_distance, 6) == 0.98708
    assert round(one.max_distance, 6) == round(many.max_distance, 6) == 1.759898


def test_compress_keeps_total_weight(spark):
    p = pts.customer_points(spark, SF01)
    core = cs.coreset(p, 10, 30).checkpoint()           # 300 rows
    small, parts = cs.compress(core, 10, 30, levels=3)
    assert parts == [8, 2, 2]                           # a quarter each, two at least
    rows = small.collect()
    assert len(rows) == 20 and sum(r.weight for r in rows) == 1500
    # compressed picks are original points
    ids = {r.point_id for r in core.collect()}
    assert {r.point_id for r in rows} <= ids


@pytest.mark.parametrize("bad", [[float("nan"), 1.0], None, [1.0, 2.0, 3.0], [1.0, None]])
def test_bad_points_fail_at_every_size(spark, bad):
    """The same error whether a part fits in memory or not, and in the objective."""
    rows = [(i, [float(i), float(i % 7)]) for i in range(40)]
    rows[17] = (17, bad)
    df = spark.createDataFrame(rows, "point_id long, features array<double>")
    for bound in (None, 4):
        with pytest.raises(Exception, match="dimension|no features|NaN"):
            cs.coreset(df, 5, 2, max_part_rows=bound).collect()
    from robustagg.operators.objective import nearest_frame
    with pytest.raises(Exception, match="dimension|no features|NaN"):
        nearest_frame(df, [[0.0, 0.0], [5.0, 1.0]]).collect()


def test_text_points_keep_their_position(spark, tmp_path):
    """Ids are line numbers over the files in order, however the files are split."""
    for f, lo in (("a.txt", 0), ("b.txt", 3000)):
        (tmp_path / f).write_text("".join(f"{i}.5,{i % 13}\n" for i in range(lo, lo + 3000)))
    key, old = "spark.sql.files.maxPartitionBytes", spark.conf.get("spark.sql.files.maxPartitionBytes")
    seen = []
    try:
        for size in ("128m", "4k"):
            spark.conf.set(key, size)
            df = pts.read_points(spark, str(tmp_path))
            seen.append(df.rdd.getNumPartitions())
            assert all(r.point_id == int(r.features[0]) for r in df.collect())
            assert df.count() == 6000
    finally:
        spark.conf.set(key, old)


@pytest.mark.parametrize("weighted", [False, True])
def test_distributed_traversal_equals_in_memory(spark, weighted):
    p = pts.customer_points(spark, SF01)
    if weighted:
        p = p.withColumn("w", (F.col("point_id") % 3 + 1).cast("long"))
    wc = "w" if weighted else None
    mem = cs.coreset(p, 12, 3, weight_col=wc, max_part_rows=None)
    dist = cs.coreset(p, 12, 3, weight_col=wc, max_part_rows=100)    # every part is larger
    mixed = cs.coreset(p, 12, 3, by="hash", weight_col=wc, max_part_rows=None)
    assert {tuple(r) for r in mem.select("part", "pick", "point_id", "weight").collect()} == \
           {tuple(r) for r in dist.select("part", "pick", "point_id", "weight").collect()}
    total = p.agg(F.sum("w")).first()[0] if weighted else 1500
    assert mixed.agg(F.sum("weight")).first()[0] == total
    assert dist.agg(F.sum("weight")).first()[0] == total


def test_distributed_traversal_stops_on_copies(spark):
    rows = [(i, [float(i % 3), 0.0]) for i in range(30)]
    df = point_frame(spark, rows)
    a = cs.coreset(df, 6, 2, max_part_rows=None).orderBy("part", "pick").collect()
    b = cs.coreset(df, 6, 2, max_part_rows=4).orderBy("part", "pick").collect()
    assert [tuple(r[:3]) + (r[4],) for r in a] == [tuple(r[:3]) + (r[4],) for r in b]
    assert len(a) == 6


from hypothesis import given, settings, strategies as st


def _naive_traversal(x, m):
    """The definition as orderings: the next pick is the row of largest (distance
    to the picks, -row); a row belongs to the pick of smallest (distance, pick)."""
    def dist(a, b):
        acc = 0.0
        for p, q in zip(a, b):
            acc += (p - q) * (p - q)
        return acc ** 0.5
    picks = [0]
    while len(picks) < m:
        gap, row = max((min(dist(a, x[p]) for p in picks), -i) for i, a in enumerate(x))
        if gap == 0.0:
            break
        picks.append(-row)
    assign = [min((dist(a, x[p]), j) for j, p in enumerate(picks))[1] for a in x]
    return picks, assign


@settings(max_examples=200, deadline=None)
@given(pts_=st.lists(st.tuples(st.integers(0, 3), st.integers(0, 3)), min_size=1, max_size=25),
       m=st.integers(1, 8))
def test_traversal_matches_definition_on_grids(pts_, m):
    x = np.array(pts_, dtype=np.float64)
    picks, assign = cs.farthest_first(x, m)
    want_picks, want_assign = _naive_traversal([list(p) for p in x], m)
    assert picks == want_picks
    assert assign.tolist() == want_assign


@settings(max_examples=200, deadline=None)
@given(pts_=st.lists(st.tuples(st.integers(0, 4), st.integers(0, 4), st.integers(1, 5)),
                     min_size=1, max_size=30),
       r=st.sampled_from([0.0, 1.0, 2.0 ** 0.5, 2.0, 5.0 ** 0.5, 3.0]))
def test_ball_sums_match_definition_on_grids(pts_, r):
    from robustagg.operators.balls import ball_sums
    x = np.array([p[:2] for p in pts_], dtype=np.float64)
    w = np.array([p[2] for p in pts_], dtype=np.int64)
    got = ball_sums(x, np.full(len(x), r), x, w)
    want = []
    for a in x:
        total = 0
        for b, wb in zip(x, w):
            d = ((a[0] - b[0]) * (a[0] - b[0]) + (a[1] - b[1]) * (a[1] - b[1])) ** 0.5
            if d <= r:
                total += int(wb)
        want.append(total)
    assert got.tolist() == want
