"""Farthest-first traversal of parts that do not fit a task.

The points of a part are stored once as cells (``operators.cells``). Per cell only
a summary is kept up to date: the largest distance of its points to their nearest
pick, and its ``CANDIDATES`` farthest points. A round then does, for all parts
side by side:

1. *Picks.* A part's farthest candidates are brought together (at most
   ``POOL``) and the traversal runs among them. It may go on as long as the next
   pick comes, in the order (distance descending, id), before every point outside
   the pool could: their distances only shrink. So a round yields as many exact
   picks as the pool can vouch for, and always at least one.
2. *Cells.* A pick c can only change a cell whose largest distance M exceeds
   d(c, center) - radius. Only those cells are read; their distances are computed
   anew from the picks that can be nearest to any of their points, and only their
   summaries are written.

No state per point exists, so none is rewritten. At the end one pass gives every
point its nearest pick (ties to the earlier one) and adds up the weights. Same
picks and weights as the traversal in memory.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from robustagg.operators.cells import SLACK, build_cells, chosen, distances, matrix
from robustagg.sources.store import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CELL_ROWS = 4096
CANDIDATES = 32   # of a cell
POOL = 1024       # candidates of a part in one task

_POINT = "struct<d: double, id: long, x: array<double>>"
_STATE = f"grp int, cell long, center array<double>, radius double, farthest double, open boolean, candidates array<{_POINT}>"
_PICK = "grp int, pick int, id long, x array<double>"


def _near(center: np.ndarray, radius: float, picks: np.ndarray) -> np.ndarray:
    """Positions of the picks that may be nearest to a point of the cell."""
    d = distances(picks, center)
    reach = (d.min() + radius) * (1 + SLACK)
    return np.flatnonzero(d - radius <= reach + SLACK * (d + radius))


def _nearest(x: np.ndarray, picks: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mind, assign = np.full(len(x), np.inf), np.zeros(len(x), np.int64)
    for p in which:  # ascending: the earlier pick keeps a tie
        d = distances(x, picks[p])
        closer = d < mind
        mind[closer] = d[closer]
        assign[closer] = p
    return mind, assign


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    lists = {c: batch.column(c) for c in batch.schema.names}
    for i in range(batch.num_rows):
        yield {c: v[i] for c, v in lists.items()}


def _values(scalar) -> np.ndarray:
    return scalar.values.to_numpy(zero_copy_only=False)


def _update(candidates: int):
    """Cells with their part's picks (``px``, flat) -> summaries."""
    kind = pa.list_(pa.struct([("d", pa.float64()), ("id", pa.int64()), ("x", pa.list_(pa.float64()))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {c: [] for c in ("grp", "cell", "center", "radius", "farthest", "open", "candidates")}
            for r in _rows(batch):
                ids, center = _values(r["ids"]), _values(r["center"])
                x, picks = _values(r["x"]).reshape(len(ids), -1), _values(r["px"]).reshape(-1, len(center))
                mind, _ = _nearest(x, picks, _near(center, r["radius"].as_py(), picks))
                order = np.lexsort((ids, -mind))[:candidates]
                values = (r["grp"].as_py(), r["cell"].as_py(), center, r["radius"].as_py(), float(mind.max()),
                          len(ids) > candidates, [{"d": mind[i], "id": ids[i], "x": x[i]} for i in order])
                for name, value in zip(out, values, strict=True):
                    out[name].append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["grp"], pa.int32()), pa.array(out["cell"], pa.int64()),
                 pa.array(out["center"], pa.list_(pa.float64())), pa.array(out["radius"], pa.float64()),
                 pa.array(out["farthest"], pa.float64()), pa.array(out["open"], pa.bool_()), pa.array(out["candidates"], kind)],
                list(out))
    return run


def _pick(m: int):
    """A part's pool -> its next picks."""
    def run(t: pa.Table) -> pa.Table:
        done, grp = t.column("done")[0].as_py(), t.column("grp")[0].as_py()
        d, ids = t.column("d").to_numpy().copy(), t.column("id").to_numpy()
        x = matrix(t.column("x"), t.num_rows)
        # The first point, in the traversal's order, that the pool may not speak for.
        bound = t.column("bound")[0].as_py()
        limit = None if bound is None else (bound["neg"], bound["id"])
        picks: list[int] = []
        while done + len(picks) < m:
            best = int(np.lexsort((ids, -d))[0])
            if not d[best] > 0 or limit is not None and (-d[best], ids[best]) > limit:
                break
            picks.append(best)
            d = np.minimum(d, distances(x, x[best]))
        n = len(picks)
        return pa.table({"grp": pa.array([grp] * n, pa.int32()), "pick": pa.array(range(done, done + n), pa.int32()),
                         "id": pa.array(ids[picks]), "x": pa.array(list(x[picks]), pa.list_(pa.float64()))})
    return run


def _weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        grp, pick, weight = [], [], []
        for r in _rows(batch):
            ids, center = _values(r["ids"]), _values(r["center"])
            x, picks = _values(r["x"]).reshape(len(ids), -1), _values(r["px"]).reshape(-1, len(center))
            _, assign = _nearest(x, picks, _near(center, r["radius"].as_py(), picks))
            total = np.zeros(len(picks), np.int64)
            np.add.at(total, assign, _values(r["w"]))
            hit = np.flatnonzero(np.bincount(assign, minlength=len(picks)))
            grp += [r["grp"].as_py()] * len(hit)
            pick += hit.tolist()
            weight += total[hit].tolist()
        yield pa.RecordBatch.from_arrays([pa.array(grp, pa.int32()), pa.array(pick, pa.int32()), pa.array(weight, pa.int64())],
                                         ["grp", "pick", "weight"])


def _with_picks(cells: DataFrame, picks: DataFrame) -> DataFrame:
    flat = picks.groupBy("grp").agg(F.sort_array(F.collect_list(F.struct("pick", "x"))).alias("p")).select(
        "grp", F.flatten("p.x").alias("px"))  # at most m picks a part
    return cells.join(flat, "grp")


def _pools(state: DataFrame, picks: DataFrame, candidates: int, pool: int) -> DataFrame:
    """(grp, d, id, x, done, bound): each part's first ``pool`` candidates in the
    traversal's order; ``bound`` is the last place that they speak for."""
    place = lambda c: F.struct((-c["d"]).alias("neg"), c["id"].alias("id"))
    # A cell with more points than candidates speaks for the places up to its last candidate.
    cut = state.where("open").groupBy("grp").agg(F.min(place(F.element_at("candidates", -1))).alias("cut"))
    rows = state.select("grp", F.inline("candidates")).withColumn("place", F.struct((-F.col("d")).alias("neg"), "id"))
    rank = F.row_number().over(Window.partitionBy("grp").orderBy("place"))
    first = rows.withColumn("rank", rank).where(F.col("rank") <= pool + 1)
    over = first.where(F.col("rank") == pool + 1).select("grp", F.col("place").alias("over"))
    done = picks.groupBy("grp").agg(F.count(F.lit(1)).cast("int").alias("done"))
    return (first.where(F.col("rank") <= pool).join(done, "grp").join(cut, "grp", "left").join(over, "grp", "left")
            .select("grp", "d", "id", "x", "done", F.least("cut", "over").alias("bound")))


def traverse(points: DataFrame, m: int, origin: list[float], cell_rows: int = CELL_ROWS,
             candidates: int = CANDIDATES, pool: int = POOL, seen: dict | None = None) -> DataFrame:
    """``(part, pick, point_id, features, weight)`` of ``points`` (part, point_id,
    features, weight). ``seen`` receives what the rounds did: ``rounds``, ``cells``,
    and ``touched``, cells read per round."""
    cells = build_cells(points.select(F.col("part").alias("grp"), F.col("point_id").alias("id"), "features", "weight"),
                        origin, cell_rows)
    first = F.min_by(F.struct(F.col("ids")[0].alias("id"), F.slice("x", 1, F.size("center")).alias("x")), F.col("ids")[0])
    picks = stored(cells.groupBy("grp").agg(first.alias("p")).select("grp", F.lit(0).alias("pick"), "p.id", "p.x"))
    new, state = picks, None
    rounds, touched = 0, []
    while True:
        moved = cells
        if state is not None:
            fresh = new.groupBy("grp").agg(F.collect_list("x").alias("fresh"))
            d = lambda c: F.sqrt(F.aggregate(F.zip_with("center", c, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda a, v: a + v))
            hit = F.exists("fresh", lambda c: d(c) - F.col("radius") < F.col("farthest") + F.lit(SLACK) * (d(c) + F.col("radius")))
            marked = stored(state.join(fresh, "grp", "left").withColumn("hit", F.coalesce(hit, F.lit(False))).drop("fresh"))
            keys = marked.where("hit").select("grp", "cell")
            moved = chosen(cells, keys)
            rest = marked.where("not hit").drop("hit")
        columns = ["grp", "cell", "center", "radius", "ids", "x", "px"]
        updated = _with_picks(moved, picks).select(*columns).mapInArrow(_update(candidates), _STATE)
        state = stored(updated if state is None else updated.unionByName(rest))
        rounds += 1
        if seen is not None:
            touched.append(moved.count())
        new = stored(_pools(state, picks, candidates, pool).groupBy("grp").applyInArrow(_pick(m), _PICK))
        if new.isEmpty():
            break
        picks = stored(picks.unionByName(new))
        if picks.groupBy("grp").count().where(F.col("count") < m).isEmpty():
            break
    if seen is not None:
        seen.update(rounds=rounds, touched=touched, cells=cells.count())
    weights = (_with_picks(cells, picks).select("grp", "center", "radius", "ids", "x", "w", "px")
               .mapInArrow(_weigh, "grp int, pick int, weight long").groupBy("grp", "pick").agg(F.sum("weight").alias("weight")))
    return picks.join(weights, ["grp", "pick"], "left").select(
        F.col("grp").alias("part"), "pick", F.col("id").alias("point_id"), F.col("x").alias("features"),
        F.coalesce("weight", F.lit(0)).cast("long").alias("weight"))
