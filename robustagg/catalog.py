"""Registered queries and their DuckDB oracles.

``queries()`` maps a name to ``f(spark, sf_dir) -> DataFrame``; every query
reads the whole test tables. ``oracle_sql()`` gives, for each name, SQL that
DuckDB runs over the same tables (views ``lineitem``, ``orders``, ...).
Column names and types agree on both sides; doubles are rounded to 6 digits
on both sides.

The k-center oracles are recursive CTEs that follow the definitions directly
(all pair distances, one recursion step per pick / greedy step); they are
meant for the small check scale only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from robustagg.operators import balls
from robustagg.operators import coreset as cs
from robustagg.operators import kcenter as kc
from robustagg.operators import popularity as pop
from robustagg.operators.objective import assign_to_centers, objective
from robustagg.plans.popularity_report import popularity_report
from robustagg.plans.two_round import exact_summary, two_round_kcenter, two_round_summary
from robustagg.session import ensure_checkpoint_dir
from robustagg.operators.closest import closest_pair
from robustagg.sources import points as pts
from robustagg.sources import transactions as tx
from robustagg.sources.text import write_lines

# Fixed parameters of the registered queries.
SALTS = 4            # K of the salted popularity
TOP_H = 5            # H of the top-H report
COUNTRY = "Nation_3"  # mixed case on purpose: matching ignores case
CORE_K, CORE_Z, CORE_L, CORE_ALPHA = 8, 40, 4, 2.0    # two-round, customer
CORE_M = CORE_K + CORE_Z + 1
EXACT_K, EXACT_Z, EXACT_ALPHA = 3, 5, 0.0             # sequential, supplier
FF_PICKS = 6                                          # farthest-first, embeddings
EMB_L = 4                                             # parts of the embeddings
LARGE_M, LARGE_Z = 9, 100                             # forced large-part and large-z branches
PART_KEY = "{} * 7919 + 13"                           # a part key of the caller
LEVEL_L, LEVEL_M = 8, 6                                # parts and picks of a coreset of two levels
WIDE_KZ = (5, 10)                                     # sequential, supplier, second setup
EMB_KZL = (4, 10, 2)                                  # two-round on embeddings (k, z, L)

ROUND = 6


def _r(c):
    return F.round(c, ROUND)


# ---------------------------------------------------------------- popularity

def _lines(spark, sf):
    return tx.transaction_lines_from_tables(spark, sf)


def _typed_cols(df: DataFrame) -> DataFrame:
    return df.select(
        tx.token(tx.PRODUCT_FIELD).alias("product_id"),
        tx.token(tx.QUANTITY_FIELD).cast("int").alias("quantity"),
        tx.token(tx.CUSTOMER_FIELD).cast("int").alias("customer_id"),
        tx.token(tx.COUNTRY_FIELD).alias("country"))


def q_txn_scan(spark, sf):
    return _lines(spark, sf)


def q_txn_count(spark, sf):
    return pop.row_count(_lines(spark, sf), "n_rows")


def q_txn_parse(spark, sf):
    return tx.parse_transactions(_lines(spark, sf))


def q_txn_filter_all(spark, sf):
    return _typed_cols(pop.keep_transactions(tx.split_transactions(_lines(spark, sf)), "all"))


def q_txn_filter_country(spark, sf):
    return _typed_cols(pop.keep_transactions(tx.split_transactions(_lines(spark, sf)), COUNTRY))


def q_product_customer_pairs(spark, sf):
    return pop.product_customer_pairs(tx.split_transactions(_lines(spark, sf)))


def q_pair_count(spark, sf):
    return pop.row_count(pop.product_customer_pairs(tx.split_transactions(_lines(spark, sf))),
                         "n_pairs")


def _pairs(spark, sf, country=None):
    return pop.product_customer_pairs(tx.transactions_from_tables(spark, sf), country)


def q_product_popularity(spark, sf):
    return pop.product_popularity(_pairs(spark, sf))


def q_product_popularity_salted(spark, sf):
    return pop.product_popularity_salted(_pairs(spark, sf), SALTS)


def q_popularity_top_h(spark, sf):
    return popularity_report(tx.transactions_from_tables(spark, sf), TOP_H)


def q_popularity_top_h_country(spark, sf):
    return popularity_report(tx.transactions_from_tables(spark, sf), TOP_H, COUNTRY)


def q_popularity_top_h_salted(spark, sf):
    return popularity_report(tx.transactions_from_tables(spark, sf), TOP_H, None, SALTS)


def q_popularity_by_product(spark, sf):
    return popularity_report(tx.transactions_from_tables(spark, sf), 0)


def q_popularity_by_product_country(spark, sf):
    return popularity_report(tx.split_transactions(_lines(spark, sf)), 0, COUNTRY)


# ------------------------------------------------------------------- points

def q_points_parse(spark, sf):
    p = pts.parse_points(pts.customer_point_lines(spark, sf))
    return p.select("point_id", F.col("features")[0].alias("x0"), F.col("features")[1].alias("x1"))


def q_point_count(spark, sf):
    return pop.row_count(pts.customer_points(spark, sf), "n_points")


def q_nearest_center(spark, sf):
    emb = pts.embedding_points(spark, sf)
    picks = cs.coreset(emb, FF_PICKS, EMB_L)
    near = cs.nearest_pick(emb, picks, EMB_L)
    return near.select("point_id", "center_id", _r(F.col("distance")).alias("distance"))


def q_pairwise_distances(spark, sf):
    summary = balls.pair_distance_summary(pts.embedding_points(spark, sf))
    return summary.select("pairs", _r(F.col("min_distance")).alias("min_distance"),
                          _r(F.col("max_distance")).alias("max_distance"))


def q_farthest_first_centers(spark, sf):
    return cs.farthest_first_centers(pts.customer_points(spark, sf), CORE_M, CORE_L)


def q_farthest_first_embeddings(spark, sf):
    return cs.farthest_first_centers(pts.embedding_points(spark, sf), FF_PICKS, EMB_L)


def _core(spark, sf):
    ensure_checkpoint_dir(spark)
    return cs.coreset(pts.customer_points(spark, sf), CORE_M, CORE_L).checkpoint()


def q_coreset(spark, sf):
    return cs.coreset(pts.customer_points(spark, sf), CORE_M, CORE_L).select(
        "part", "pick", "point_id", "weight")


def q_coreset_weights(spark, sf):
    return cs.coreset_weights(cs.coreset(pts.customer_points(spark, sf), CORE_M, CORE_L))


def q_coreset_total_weight(spark, sf):
    return cs.total_weight(cs.coreset(pts.customer_points(spark, sf), CORE_M, CORE_L))


def _solver_start(spark, sf):
    w = kc.coreset_weighted(_core(spark, sf), CORE_M)
    prep = kc.prepare(w, CORE_K, CORE_Z, CORE_ALPHA)
    return w, prep, kc.initial_state(w, prep.guesses, prep.n_rows)


def _ball_weights(prep, state):
    return kc.ball_weights(state, CORE_ALPHA, prep.n_rows)


def q_initial_radius(spark, sf):
    w = kc.coreset_weighted(_core(spark, sf), CORE_M)
    return kc.window_radius_frame(w, CORE_M).select(_r(F.col("initial_guess")).alias("initial_guess"))


def q_ball_weights(spark, sf):
    w, prep, state = _solver_start(spark, sf)
    return _ball_weights(prep, state).select("guess", "point_id", "ball_weight")


def q_ball_members(spark, sf):
    # The range join of J3 as its member count: uncovered points within
    # (1+2a) * radius of each candidate (unit weights through the same kernel).
    w, prep, state = _solver_start(spark, sf)
    unit = state.withColumn("weight", F.lit(1).cast("long"))
    return kc.ball_weights(unit, CORE_ALPHA, prep.n_rows).select(
        "guess", "point_id", F.col("ball_weight").alias("members"))


def q_best_ball(spark, sf):
    w, prep, state = _solver_start(spark, sf)
    best = kc.best_ball(_ball_weights(prep, state), state)
    return best.join(w.select(F.col("idx").alias("c_idx"), "point_id"), "c_idx").select(
        "guess", "point_id")


def q_cover_step(spark, sf):
    w, prep, state = _solver_start(spark, sf)
    best = kc.best_ball(_ball_weights(prep, state), state)
    return kc.cover_step(state, best, CORE_ALPHA).select("guess", "point_id", "uncovered")


def _greedy(spark, sf):
    w, prep, state = _solver_start(spark, sf)
    return kc.greedy_cover(state, CORE_K, CORE_ALPHA, prep.n_rows)


def q_greedy_cover(spark, sf):
    return _greedy(spark, sf).where(F.col("center_step").isNotNull()).select(
        "guess", F.col("center_step").alias("step"), "point_id")


def q_radius_search(spark, sf):
    per = kc.radius_search(_greedy(spark, sf), CORE_Z)
    return per.select("guess", _r(F.col("radius")).alias("radius"), "uncovered_weight",
                      "centers", "ok")


def q_kcenter_exact(spark, sf):
    res = kc.kcenter_exact(pts.supplier_points(spark, sf), EXACT_K, EXACT_Z, EXACT_ALPHA)
    return res.solution.select("step", "point_id")


def q_kcenter_exact_wide(spark, sf):
    res = kc.kcenter_exact(pts.supplier_points(spark, sf), *WIDE_KZ, 0.0)
    return res.solution.select("step", "point_id")


def q_kcenter_coreset_alpha0(spark, sf):
    res = two_round_kcenter(pts.customer_points(spark, sf), CORE_K, CORE_Z, CORE_L, 0.0)
    return res.solve.solution.select("step", "point_id")


def q_kcenter_embeddings_summary(spark, sf):
    k, z, parts = EMB_KZL
    res = two_round_kcenter(pts.embedding_points(spark, sf), k, z, parts, CORE_ALPHA)
    return _rounded_summary(two_round_summary(res))


def q_kcenter_coreset(spark, sf):
    res = two_round_kcenter(pts.customer_points(spark, sf), CORE_K, CORE_Z, CORE_L, CORE_ALPHA)
    return res.solve.solution.select("step", "point_id")


def q_kcenter_objective(spark, sf):
    res = two_round_kcenter(pts.customer_points(spark, sf), CORE_K, CORE_Z, CORE_L, CORE_ALPHA)
    return res.objective.select(_r(F.col("objective")).alias("objective"))


def q_kcenter_assignment(spark, sf):
    customers = pts.customer_points(spark, sf)
    res = two_round_kcenter(customers, CORE_K, CORE_Z, CORE_L, CORE_ALPHA)
    a = assign_to_centers(customers, res.solve.solution, res.solve.centers)
    return a.select("point_id", "center_id", _r(F.col("distance")).alias("distance"))


def q_ball_weights_blocked(spark, sf):
    """Ball weights over many small blocks, as a solver input beyond one block takes them."""
    w, prep, state = _solver_start(spark, sf)
    return balls.ball_weights_blocked(state.where("uncovered"), kc.selection_factor(CORE_ALPHA), prep.n_rows,
                                      block_rows=64).select("guess", "point_id", "ball_weight")


def q_coreset_large_parts(spark, sf):
    """Every part over the memory bound: the traversal as DataFrame jobs."""
    return cs.coreset(pts.customer_points(spark, sf), LARGE_M, CORE_L, max_part_rows=100).select(
        "part", "pick", "point_id", "weight")


def q_coreset_key_parts(spark, sf):
    """Parts from a column of the caller."""
    keyed = pts.customer_points(spark, sf).withColumn("own", F.expr(f"({PART_KEY.format('point_id')}) % {CORE_L}"))
    return cs.coreset(keyed, CORE_M, CORE_L, part_col="own").select("part", "pick", "point_id", "weight")


def q_objective_large_z(spark, sf):
    """A large z: the value is narrowed down by bucket counts."""
    customers = pts.customer_points(spark, sf)
    res = two_round_kcenter(customers, CORE_K, CORE_Z, CORE_L, CORE_ALPHA)
    return objective(customers, res.solve.solution, LARGE_Z, res.solve.centers, take_limit=20).select(
        _r(F.col("objective")).alias("objective"))


def q_nearest_center_blocks(spark, sf):
    """Nearest centers with two centers to a block."""
    customers = pts.customer_points(spark, sf)
    res = two_round_kcenter(customers, CORE_K, CORE_Z, CORE_L, CORE_ALPHA)
    a = assign_to_centers(customers, res.solve.solution, res.solve.centers, center_bytes=2 * 2 * 8)
    return a.select("point_id", "center_id", _r(F.col("distance")).alias("distance"))


def q_txn_file_scan(spark, sf):
    """Transactions read from text files."""
    return tx.parse_transactions(tx.read_transaction_lines(spark, write_lines(_lines(spark, sf))))


def q_points_file_scan(spark, sf):
    """Points read from text files, numbered by position."""
    p = pts.read_points(spark, write_lines(pts.customer_point_lines(spark, sf), order="point_id"))
    return p.select("point_id", F.col("features")[0].alias("x0"), F.col("features")[1].alias("x1"))


def q_kcenter_text_summary(spark, sf):
    """The two-round plan on points from text files."""
    p = pts.read_points(spark, write_lines(pts.customer_point_lines(spark, sf), order="point_id"))
    return _rounded_summary(two_round_summary(two_round_kcenter(p, CORE_K, CORE_Z, CORE_L, CORE_ALPHA)))


def q_coreset_rank_parts(spark, sf):
    """Ids that are all multiples of L still give even parts: rank modulo L."""
    spread = pts.customer_points(spark, sf).withColumn("point_id", F.col("point_id") * CORE_L)
    return cs.coreset(spread, CORE_M, CORE_L).select("part", "pick", "point_id", "weight")


def q_coreset_levels(spark, sf):
    """A second, weighted farthest-first level over the coreset."""
    core = cs.coreset(pts.customer_points(spark, sf), LEVEL_M, LEVEL_L)
    core, _ = cs.compress(core, LEVEL_M, LEVEL_L)
    return core.select("part", "pick", "point_id", "weight")


def q_greedy_cover_cells(spark, sf):
    """Greedy steps over cells of few points, with ball weights carried from step to step."""
    w, prep, state = _solver_start(spark, sf)
    done = kc.greedy_cover(state, CORE_K, CORE_ALPHA, prep.n_rows, block_rows=64)
    return done.where(F.col("center_step").isNotNull()).select("guess", F.col("center_step").alias("step"), "point_id")


def q_closest_pair_cells(spark, sf):
    """Smallest distance of all customers, by cells."""
    customers = pts.customer_points(spark, sf)
    found = closest_pair(customers, customers.count(), block_rows=100, cell_rows=20)
    return found.select(_r(F.col("min_distance")).alias("min_distance"), _r(F.col("min_positive")).alias("min_positive"))


def q_nearest_center_stream(spark, sf):
    """Nearest picks with picks and points brought together by part."""
    emb = pts.embedding_points(spark, sf)
    near = cs.nearest_pick(emb, cs.coreset(emb, FF_PICKS, EMB_L), EMB_L, closure_bytes=1)
    return near.select("point_id", "center_id", _r(F.col("distance")).alias("distance"))


def _rounded_summary(df):
    return df.select("n", "k", "z", "l", _r(F.col("initial_guess")).alias("initial_guess"),
                     _r(F.col("final_guess")).alias("final_guess"), "guesses", "solution_size",
                     _r(F.col("objective")).alias("objective"))


def q_kcenter_summary(spark, sf):
    res = two_round_kcenter(pts.customer_points(spark, sf), CORE_K, CORE_Z, CORE_L, CORE_ALPHA)
    return _rounded_summary(two_round_summary(res))


def q_kcenter_exact_summary(spark, sf):
    return _rounded_summary(exact_summary(pts.supplier_points(spark, sf), EXACT_K, EXACT_Z,
                                          EXACT_ALPHA))


def q_exact_objective(spark, sf):
    sup = pts.supplier_points(spark, sf)
    res = kc.kcenter_exact(sup, EXACT_K, EXACT_Z, EXACT_ALPHA)
    return objective(sup, res.solution, EXACT_Z, res.centers).select(
        _r(F.col("objective")).alias("objective"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "txn_scan": q_txn_scan,
    "txn_count": q_txn_count,
    "txn_parse": q_txn_parse,
    "txn_filter_all": q_txn_filter_all,
    "txn_filter_country": q_txn_filter_country,
    "product_customer_pairs": q_product_customer_pairs,
    "pair_count": q_pair_count,
    "product_popularity": q_product_popularity,
    "product_popularity_salted": q_product_popularity_salted,
    "popularity_top_h": q_popularity_top_h,
    "popularity_top_h_country": q_popularity_top_h_country,
    "popularity_top_h_salted": q_popularity_top_h_salted,
    "popularity_by_product": q_popularity_by_product,
    "popularity_by_product_country": q_popularity_by_product_country,
    "points_parse": q_points_parse,
    "point_count": q_point_count,
    "nearest_center": q_nearest_center,
    "pairwise_distances": q_pairwise_distances,
    "initial_radius": q_initial_radius,
    "ball_weights": q_ball_weights,
    "ball_members": q_ball_members,
    "best_ball": q_best_ball,
    "cover_step": q_cover_step,
    "greedy_cover": q_greedy_cover,
    "radius_search": q_radius_search,
    "farthest_first_centers": q_farthest_first_centers,
    "farthest_first_embeddings": q_farthest_first_embeddings,
    "coreset_weights": q_coreset_weights,
    "coreset_total_weight": q_coreset_total_weight,
    "coreset": q_coreset,
    "kcenter_exact": q_kcenter_exact,
    "kcenter_exact_wide": q_kcenter_exact_wide,
    "kcenter_coreset": q_kcenter_coreset,
    "kcenter_coreset_alpha0": q_kcenter_coreset_alpha0,
    "kcenter_embeddings_summary": q_kcenter_embeddings_summary,
    "kcenter_objective": q_kcenter_objective,
    "kcenter_assignment": q_kcenter_assignment,
    "kcenter_summary": q_kcenter_summary,
    "kcenter_exact_summary": q_kcenter_exact_summary,
    "exact_objective": q_exact_objective,
    "ball_weights_blocked": q_ball_weights_blocked,
    "coreset_large_parts": q_coreset_large_parts,
    "coreset_key_parts": q_coreset_key_parts,
    "objective_large_z": q_objective_large_z,
    "nearest_center_blocks": q_nearest_center_blocks,
    "txn_file_scan": q_txn_file_scan,
    "points_file_scan": q_points_file_scan,
    "kcenter_text_summary": q_kcenter_text_summary,
    "coreset_rank_parts": q_coreset_rank_parts,
    "coreset_levels": q_coreset_levels,
    "greedy_cover_cells": q_greedy_cover_cells,
    "closest_pair_cells": q_closest_pair_cells,
    "nearest_center_stream": q_nearest_center_stream,
}


# ------------------------------------------------------------------- oracles

_TXN = """
txn AS (
  SELECT CAST(l.l_partkey AS VARCHAR) AS product_id,
         CAST(CASE WHEN l.l_returnflag = 'R' THEN -l.l_quantity ELSE l.l_quantity END AS INTEGER)
           AS quantity,
         CAST(o.o_custkey AS INTEGER) AS customer_id,
         n.n_name AS country,
         l.l_orderkey, l.l_linestatus, l.l_linenumber, l.l_suppkey
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey)"""

_LINES = """
lines AS (
  SELECT concat_ws(',', CAST(l_orderkey AS VARCHAR), product_id, l_linestatus,
                   CAST(quantity AS VARCHAR), CAST(l_linenumber AS VARCHAR),
                   CAST(l_suppkey AS VARCHAR), CAST(customer_id AS VARCHAR), country) AS value
  FROM txn)"""


def _kept(country: str | None) -> str:
    cond = "quantity > 0"
    if country is not None:
        cond += f" AND lower(country) = '{country.lower()}'"
    return f"kept AS (SELECT * FROM txn WHERE {cond})"


def _pairs_sql(country: str | None) -> str:
    return f"{_kept(country)},\npairs AS (SELECT DISTINCT product_id, customer_id FROM kept)"


_POPULARITY = ("popularity AS (SELECT product_id, count(*) AS popularity "
               "FROM pairs GROUP BY product_id)")


def _top_h(h: int) -> str:
    return (f"SELECT product_id, popularity, CAST(row_number() OVER "
            f"(ORDER BY popularity DESC, product_id) AS INTEGER) AS rank "
            f"FROM popularity ORDER BY popularity DESC, product_id LIMIT {h}")


def _with(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(c.strip() for c in ctes) + "\n"


_POINTS = {
    "customer": "SELECT c_custkey AS v, [c_acctbal, c_nationkey * CAST(400.0 AS DOUBLE)] AS e "
                "FROM customer",
    "supplier": "SELECT s_suppkey AS v, [s_acctbal, s_nationkey * CAST(400.0 AS DOUBLE)] AS e "
                "FROM supplier",
    "embeddings": "SELECT vec_id AS v, CAST(embedding AS DOUBLE[]) AS e FROM embeddings",
}


def _fft_ctes(table: str, parts: int, m: int, key: str = "v") -> list[str]:
    """pts(v, part, e); ff: one recursion row set per pick; cpt(part, pick,
    v, e): the picks; core(part, pick, v, e, w): picks with weights."""
    return [
        f"pts AS (SELECT v, CAST({key} % {parts} AS INTEGER) AS part, e FROM ({_POINTS[table]}) p)",
        f"""ff(it, part, v, e, d, cid) AS (
  SELECT 1, part, v, e, CAST('infinity' AS DOUBLE), min(v) OVER (PARTITION BY part) FROM pts
  UNION ALL
  SELECT it + 1, part, v, e, d, nxt FROM (
    SELECT s.*, arg_max(v, (d, -v)) OVER (PARTITION BY part) AS nxt,
           max(d) OVER (PARTITION BY part) AS md
    FROM (SELECT f.it, f.part, f.v, f.e, least(f.d, list_distance(f.e, c.e)) AS d
          FROM ff f JOIN pts c ON c.v = f.cid WHERE f.it < {m}) s) s2
  WHERE md > 0)""",
        """cpt AS (SELECT DISTINCT ff.part, CAST(ff.it - 1 AS INTEGER) AS pick, ff.cid AS v, p.e
        FROM ff JOIN pts p ON p.v = ff.cid)""",
        """asg AS (SELECT p.part, p.v, arg_min(c.v, (list_distance(p.e, c.e), c.pick)) AS cv
        FROM pts p JOIN cpt c ON c.part = p.part GROUP BY p.part, p.v)""",
        """core AS (SELECT c.part, c.pick, c.v, c.e, count(a.v) AS w
         FROM cpt c LEFT JOIN asg a ON a.part = c.part AND a.cv = c.v
         GROUP BY c.part, c.pick, c.v, c.e)""",
    ]


def _second_level_ctes(parts: int, m: int) -> list[str]:
    """core2 of ``core``: the same traversal over its rows by rank, weights summed."""
    return [
        f"p2 AS (SELECT v, e, w, CAST((row_number() OVER (ORDER BY v) - 1) % {parts} AS INTEGER) AS part FROM core)",
        f"""f2(it, part, v, e, d, cid) AS (
  SELECT 1, part, v, e, CAST('infinity' AS DOUBLE), min(v) OVER (PARTITION BY part) FROM p2
  UNION ALL
  SELECT it + 1, part, v, e, d, nxt FROM (
    SELECT s.*, arg_max(v, (d, -v)) OVER (PARTITION BY part) AS nxt, max(d) OVER (PARTITION BY part) AS md
    FROM (SELECT f.it, f.part, f.v, f.e, least(f.d, list_distance(f.e, c.e)) AS d
          FROM f2 f JOIN p2 c ON c.v = f.cid WHERE f.it < {m}) s) s2
  WHERE md > 0)""",
        """c2 AS (SELECT DISTINCT f2.part, CAST(f2.it - 1 AS INTEGER) AS pick, f2.cid AS v, p2.e
        FROM f2 JOIN p2 ON p2.v = f2.cid)""",
        """a2 AS (SELECT p2.part, p2.v, any_value(p2.w) AS w, arg_min(c.v, (list_distance(p2.e, c.e), c.pick)) AS cv
        FROM p2 JOIN c2 c ON c.part = p2.part GROUP BY p2.part, p2.v)""",
        """core2 AS (SELECT c.part, c.pick, c.v, CAST(sum(a.w) AS BIGINT) AS w
         FROM c2 c JOIN a2 a ON a.part = c.part AND a.cv = c.v GROUP BY c.part, c.pick, c.v)""",
    ]


def _solver_ctes(t_sql: str, k: int, z: int, alpha: float) -> list[str]:
    """t(i, v, e, w) -> gs(guess, r); g: recursive greedy state; fin; per_guess;
    winner; sol(step, point_id, e). Assumes the window radius is positive."""
    m = k + z + 1
    sel = float(1 + 2 * alpha)
    rem = float(3 + 4 * alpha)
    return [
        f"t AS MATERIALIZED ({t_sql})",
        f"win AS (SELECT i, e FROM t ORDER BY i LIMIT {m})",
        "r0 AS (SELECT min(list_distance(a.e, b.e)) / 2 AS r FROM win a JOIN win b ON a.i < b.i)",
        """coords AS (SELECT unnest(range(len(e))) AS j, unnest(e) AS x FROM t)""",
        """bb AS (SELECT sqrt(sum(span * span)) AS diag
       FROM (SELECT j, max(x) - min(x) AS span FROM coords GROUP BY j) s)""",
        f"""ng AS (SELECT CAST(1 + greatest(0, ceil(log2(diag * (1 + 1e-9) / ({rem} * r))))
                 AS INTEGER) AS g FROM r0, bb)""",
        """gs AS (SELECT CAST(q.guess AS INTEGER) AS guess, r0.r * pow(2, q.guess) AS r
        FROM r0, ng, range(0, 64) q(guess) WHERE q.guess < ng.g)""",
        "dm AS MATERIALIZED (SELECT a.i AS a, b.i AS b, list_distance(a.e, b.e) AS d FROM t a, t b)",
        f"""g(guess, r, step, i, w, unc, cstep) AS (
  SELECT gs.guess, gs.r, 0, t.i, t.w, true, CAST(NULL AS INTEGER) FROM gs, t
  UNION ALL
  SELECT * FROM (
    WITH bw AS (
      SELECT x.guess, x.i, sum(y.w) AS bw
      FROM g x JOIN dm ON dm.a = x.i AND dm.d <= {sel} * x.r
               JOIN g y ON y.guess = x.guess AND y.i = dm.b AND y.unc
      WHERE x.unc AND x.step < {k}
      GROUP BY x.guess, x.i),
    nc AS (SELECT guess, arg_max(i, (bw, -i)) AS c FROM bw WHERE bw > 0 GROUP BY guess)
    SELECT x.guess, x.r, x.step + 1, x.i, x.w,
           x.unc AND (nc.c IS NULL OR dm.d > {rem} * x.r),
           CASE WHEN x.i = nc.c THEN CAST(x.step + 1 AS INTEGER) ELSE x.cstep END
    FROM g x LEFT JOIN nc ON nc.guess = x.guess
             LEFT JOIN dm ON dm.a = nc.c AND dm.b = x.i
    WHERE x.step < {k}))""",
        f"fin AS (SELECT * FROM g WHERE step = {k})",
        """per_guess AS (SELECT guess, r, CAST(sum(CASE WHEN unc THEN w ELSE 0 END) AS BIGINT) AS uw,
               count(cstep) AS centers FROM fin GROUP BY guess, r)""",
        f"winner AS (SELECT min(guess) AS guess FROM per_guess WHERE uw <= {z})",
        """sol AS (SELECT f.cstep AS step, t.v AS point_id, t.e
        FROM fin f JOIN winner USING (guess) JOIN t ON t.i = f.i WHERE f.cstep IS NOT NULL)""",
    ]


def _objective_ctes(table: str, z: int) -> list[str]:
    return [
        f"allp AS ({_POINTS[table]})",
        """nd AS (SELECT a.v, min(list_distance(a.e, s.e)) AS d FROM allp a, sol s GROUP BY a.v)""",
        f"obj AS (SELECT d AS objective FROM nd ORDER BY d DESC LIMIT 1 OFFSET {z})",
    ]


_EXACT_T = "SELECT v AS i, v, e, CAST(1 AS BIGINT) AS w FROM allp_t"


def _core_solver(table: str = "customer", k: int = CORE_K, z: int = CORE_Z,
                 parts: int = CORE_L, alpha: float = CORE_ALPHA) -> list[str]:
    m = k + z + 1
    core_t = f"SELECT CAST(part AS BIGINT) * {m} + pick AS i, v, e, w FROM core"
    return _fft_ctes(table, parts, m) + _solver_ctes(core_t, k, z, alpha)


def _exact_solver(k: int = EXACT_K, z: int = EXACT_Z, alpha: float = EXACT_ALPHA) -> list[str]:
    return ([f"allp_t AS ({_POINTS['supplier']})"]
            + _solver_ctes(_EXACT_T, k, z, alpha))


def _summary_select(n_sql: str, l_sql: str, k: int, z: int) -> str:
    return f"""SELECT CAST(({n_sql}) AS BIGINT) AS n, CAST({k} AS INTEGER) AS k,
  CAST({z} AS INTEGER) AS z, CAST({l_sql} AS INTEGER) AS l,
  round((SELECT r FROM r0), 6) AS initial_guess,
  round((SELECT r FROM per_guess WHERE guess = (SELECT guess FROM winner)), 6) AS final_guess,
  CAST((SELECT guess FROM winner) + 1 AS INTEGER) AS guesses,
  CAST((SELECT count(*) FROM sol) AS INTEGER) AS solution_size,
  round((SELECT objective FROM obj), 6) AS objective"""


def _step1_ctes() -> list[str]:
    return _core_solver()[:-5] + [
        f"""bw1 AS MATERIALIZED (SELECT gs.guess, a.i, sum(b.w) AS ball_weight
         FROM gs, t a JOIN dm ON dm.a = a.i JOIN t b ON b.i = dm.b
         WHERE dm.d <= {float(1 + 2 * CORE_ALPHA)} * gs.r GROUP BY gs.guess, a.i)""",
        "nc1 AS MATERIALIZED (SELECT guess, arg_max(i, (ball_weight, -i)) AS c FROM bw1 GROUP BY guess)",
    ]


def _oracles() -> dict[str, str]:
    o: dict[str, str] = {}
    o["txn_scan"] = _with(_TXN, _LINES) + "SELECT value FROM lines"
    o["txn_count"] = _with(_TXN) + "SELECT count(*) AS n_rows FROM txn"
    o["txn_parse"] = _with(_TXN) + "SELECT product_id, quantity, customer_id, country FROM txn"
    o["txn_filter_all"] = (_with(_TXN, _kept(None))
                           + "SELECT product_id, quantity, customer_id, country FROM kept")
    o["txn_filter_country"] = (_with(_TXN, _kept(COUNTRY))
                               + "SELECT product_id, quantity, customer_id, country FROM kept")
    o["product_customer_pairs"] = _with(_TXN, _pairs_sql(None)) + "SELECT * FROM pairs"
    o["pair_count"] = _with(_TXN, _pairs_sql(None)) + "SELECT count(*) AS n_pairs FROM pairs"
    o["product_popularity"] = _with(_TXN, _pairs_sql(None), _POPULARITY) + "SELECT * FROM popularity"
    o["product_popularity_salted"] = o["product_popularity"]
    o["popularity_top_h"] = _with(_TXN, _pairs_sql(None), _POPULARITY) + _top_h(TOP_H)
    o["popularity_top_h_country"] = _with(_TXN, _pairs_sql(COUNTRY), _POPULARITY) + _top_h(TOP_H)
    o["popularity_top_h_salted"] = o["popularity_top_h"]
    o["popularity_by_product"] = (_with(_TXN, _pairs_sql(None), _POPULARITY)
                                  + "SELECT * FROM popularity ORDER BY product_id")
    o["popularity_by_product_country"] = (_with(_TXN, _pairs_sql(COUNTRY), _POPULARITY)
                                          + "SELECT * FROM popularity ORDER BY product_id")
    o["points_parse"] = ("SELECT CAST(c_custkey AS BIGINT) AS point_id, "
                         "CAST(printf('%.2f', c_acctbal) AS DOUBLE) AS x0, "
                         "CAST(printf('%.2f', c_nationkey * CAST(400.0 AS DOUBLE)) AS DOUBLE) AS x1 "
                         "FROM customer")
    o["point_count"] = "SELECT count(*) AS n_points FROM customer"
    o["nearest_center"] = _with(*_fft_ctes("embeddings", EMB_L, FF_PICKS)) + """
SELECT p.v AS point_id,
       arg_min(c.v, (list_distance(p.e, c.e), c.pick)) AS center_id,
       round(min(list_distance(p.e, c.e)), 6) AS distance
FROM pts p JOIN cpt c ON c.part = p.part GROUP BY p.v"""
    o["pairwise_distances"] = (_with(f"p AS ({_POINTS['embeddings']})") + """
SELECT count(*) AS pairs, round(min(d), 6) AS min_distance, round(max(d), 6) AS max_distance
FROM (SELECT list_distance(a.e, b.e) AS d FROM p a JOIN p b ON a.v < b.v) s""")
    o["farthest_first_centers"] = (_with(*_fft_ctes("customer", CORE_L, CORE_M))
                                   + "SELECT part, pick, v AS point_id FROM cpt")
    o["farthest_first_embeddings"] = (_with(*_fft_ctes("embeddings", EMB_L, FF_PICKS))
                                      + "SELECT part, pick, v AS point_id FROM cpt")
    core = _fft_ctes("customer", CORE_L, CORE_M)
    o["coreset"] = _with(*core) + "SELECT part, pick, v AS point_id, w AS weight FROM core"
    o["coreset_weights"] = _with(*core) + "SELECT part, v AS point_id, w AS weight FROM core"
    o["coreset_total_weight"] = (_with(*core)
                                 + "SELECT CAST(sum(w) AS BIGINT) AS total_weight FROM core")
    o["initial_radius"] = _with(*_core_solver()) + "SELECT round(r, 6) AS initial_guess FROM r0"
    o["ball_weights"] = (_with(*_step1_ctes())
                         + "SELECT bw1.guess, t.v AS point_id, CAST(ball_weight AS BIGINT) AS "
                           "ball_weight FROM bw1 JOIN t USING (i)")
    o["ball_members"] = (_with(*_step1_ctes())
                         + f"""SELECT gs.guess, a.v AS point_id, count(*) AS members
FROM gs, t a JOIN dm ON dm.a = a.i
WHERE dm.d <= {float(1 + 2 * CORE_ALPHA)} * gs.r GROUP BY gs.guess, a.v""")
    o["best_ball"] = (_with(*_step1_ctes())
                      + "SELECT nc1.guess, t.v AS point_id FROM nc1 JOIN t ON t.i = nc1.c")
    o["cover_step"] = _with(*_step1_ctes()) + f"""
SELECT gs.guess, t.v AS point_id, list_distance(c.e, t.e) > {float(3 + 4 * CORE_ALPHA)} * gs.r AS uncovered
FROM gs JOIN nc1 ON nc1.guess = gs.guess JOIN t c ON c.i = nc1.c, t"""
    o["greedy_cover"] = (_with(*_core_solver())
                         + "SELECT fin.guess, fin.cstep AS step, t.v AS point_id "
                           "FROM fin JOIN t USING (i) WHERE fin.cstep IS NOT NULL")
    o["radius_search"] = (_with(*_core_solver())
                          + f"SELECT guess, round(r, 6) AS radius, uw AS uncovered_weight, centers, "
                            f"uw <= {CORE_Z} AS ok FROM per_guess")
    o["kcenter_exact"] = _with(*_exact_solver()) + "SELECT step, point_id FROM sol"
    o["kcenter_exact_wide"] = (_with(*_exact_solver(*WIDE_KZ, 0.0))
                               + "SELECT step, point_id FROM sol")
    o["kcenter_coreset_alpha0"] = (_with(*_core_solver(alpha=0.0))
                                   + "SELECT step, point_id FROM sol")
    o["kcenter_embeddings_summary"] = (
        _with(*_core_solver("embeddings", *EMB_KZL, CORE_ALPHA),
              *_objective_ctes("embeddings", EMB_KZL[1]))
        + _summary_select("SELECT sum(w) FROM core", str(EMB_KZL[2]), EMB_KZL[0], EMB_KZL[1]))
    o["kcenter_coreset"] = _with(*_core_solver()) + "SELECT step, point_id FROM sol"
    o["kcenter_objective"] = (_with(*_core_solver(), *_objective_ctes("customer", CORE_Z))
                              + "SELECT round(objective, 6) AS objective FROM obj")
    o["kcenter_assignment"] = _with(*_core_solver(), f"allp AS ({_POINTS['customer']})") + """
SELECT a.v AS point_id, arg_min(s.point_id, (list_distance(a.e, s.e), s.step)) AS center_id,
       round(min(list_distance(a.e, s.e)), 6) AS distance
FROM allp a, sol s GROUP BY a.v"""
    o["kcenter_summary"] = (_with(*_core_solver(), *_objective_ctes("customer", CORE_Z))
                            + _summary_select("SELECT sum(w) FROM core", str(CORE_L),
                                              CORE_K, CORE_Z))
    o["kcenter_exact_summary"] = (_with(*_exact_solver(), *_objective_ctes("supplier", EXACT_Z))
                                  + _summary_select("SELECT count(*) FROM allp_t", "NULL",
                                                    EXACT_K, EXACT_Z))
    o["exact_objective"] = (_with(*_exact_solver(), *_objective_ctes("supplier", EXACT_Z))
                            + "SELECT round(objective, 6) AS objective FROM obj")
    # The branches that run at scale, forced by parameters.
    o["ball_weights_blocked"] = o["ball_weights"]
    o["coreset_large_parts"] = (_with(*_fft_ctes("customer", CORE_L, LARGE_M))
                                + "SELECT part, pick, v AS point_id, w AS weight FROM core")
    o["coreset_key_parts"] = (_with(*_fft_ctes("customer", CORE_L, CORE_M, f"({PART_KEY.format('v')})"))
                              + "SELECT part, pick, v AS point_id, w AS weight FROM core")
    o["objective_large_z"] = (_with(*_core_solver(), *_objective_ctes("customer", LARGE_Z))
                              + "SELECT round(objective, 6) AS objective FROM obj")
    o["nearest_center_blocks"] = o["kcenter_assignment"]
    o["txn_file_scan"] = o["txn_parse"]
    o["points_file_scan"] = ("SELECT row_number() OVER (ORDER BY c_custkey) - 1 AS point_id, "
                             "CAST(printf('%.2f', c_acctbal) AS DOUBLE) AS x0, "
                             "CAST(printf('%.2f', c_nationkey * CAST(400.0 AS DOUBLE)) AS DOUBLE) AS x1 FROM customer")
    o["kcenter_text_summary"] = o["kcenter_summary"]
    o["coreset_rank_parts"] = (_with(*_fft_ctes("customer", CORE_L, CORE_M, "(row_number() OVER (ORDER BY v) - 1)"))
                               + f"SELECT part, pick, v * {CORE_L} AS point_id, w AS weight FROM core")
    o["coreset_levels"] = (_with(*_fft_ctes("customer", LEVEL_L, LEVEL_M), *_second_level_ctes(max(2, -(-LEVEL_L // 4)), LEVEL_M))
                           + "SELECT part, pick, v AS point_id, w AS weight FROM core2")
    o["greedy_cover_cells"] = o["greedy_cover"]
    o["closest_pair_cells"] = (_with(f"p AS ({_POINTS['customer']})") + """
SELECT round(min(d), 6) AS min_distance, round(min(CASE WHEN d > 0 THEN d END), 6) AS min_positive
FROM (SELECT list_distance(a.e, b.e) AS d FROM p a JOIN p b ON a.v < b.v) s""")
    o["nearest_center_stream"] = o["nearest_center"]
    return o


def oracles() -> dict[str, str]:
    return _oracles()
