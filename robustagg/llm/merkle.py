"""Merkle manifest of a dataset, with a proof per row, by butterfly exchange.

Rows are leaves: per group (a source) they stand in order, every ``FANOUT``
consecutive nodes become their hash, until one node (the subroot) is left; the
subroots, in order of their groups, go on to the root in the same way. A row's
proof holds, level by level up to the root, the digests to the left and to the
right of its ancestor within the run.

Leaves get their exact rank in their group (``operators.ranks``) and form cells
of ``CELL`` = FANOUT^3 ranks. One pass over the cells gives each cell's root.
Then the cells of a group exchange as a butterfly: in round r, with w = FANOUT^r,
cell t sits in the subtree t // w of w cells; it sends its subtree's root to the
cells at the same place (t mod w) of the other subtrees of its run. Every cell
then holds its run's roots, hashes the common parent itself (as all cells of the
run do) and has the siblings of that level as part of its proofs. After
log_FANOUT(cells) rounds each cell knows the subroot and the upper proof; nothing
is sent back down. A last subtree with fewer cells sends to all places that are
congruent to its own ones, so every cell hears of every subtree once. A round is
one exchange of at most FANOUT rows per cell. Subroots are ranked and treated in
the same way. A second pass over the cells adds the levels inside.

Hashes are lowercase hex SHA-256 of the concatenated inputs.

Defined cases: a null group is a group of its own, before the others; groups are
ordered bytewise; rows that agree in all order columns stand in the order of
their leaves, equal leaves in any order; a null in a column is hashed as ``-``;
empty and very long texts are hashed whole; an empty table gives no rows; extra
columns, whatever their names, are not hashed and not returned unless asked for.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructField, StructType

from robustagg.operators.ranks import with_rank

from .common import cut, ship_package

FANOUT, CELL_LEVELS = 16, 3
CELL = FANOUT ** CELL_LEVELS
PROOF = "array<struct<left: string, right: string>>"


def leaf_hash(columns: Sequence[Column]) -> Column:
    """Hash of a row: each value as ``-`` if null, else its UTF-8 byte count, ``:`` and itself."""
    values = [c.cast("string") for c in columns]
    return F.sha2(F.concat(*(F.when(v.isNull(), "-").otherwise(
        F.concat(F.octet_length(v).cast("string"), F.lit(":"), v)) for v in values)), 256)


def proof_digest(proof: Column) -> Column:
    """Hash of all digests of a proof, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda p: F.concat(p["left"], p["right"])), ""), 256)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(proof, leaf, lambda x, p: F.sha2(F.concat(p["left"], x, p["right"]), 256))


def _parents(nodes: list[str]) -> list[str]:
    return [hashlib.sha256("".join(nodes[i:i + FANOUT]).encode()).hexdigest() for i in range(0, len(nodes), FANOUT)]


def _levels(leaves: list[str], alone: bool) -> list[list[str]]:
    """Nodes of a cell, level by level: up to one node if the cell is the whole
    tree, else always CELL_LEVELS above the leaves."""
    levels = [leaves]
    while len(levels[-1]) > 1 if alone else len(levels) <= CELL_LEVELS:
        levels.append(_parents(levels[-1]))
    return levels


def _sides(levels: list[list[str]]) -> list[list[tuple[str, str]]]:
    """Per leaf: (left, right) of every level below the last."""
    above: list[list[tuple[str, str]]] = [[]]
    for nodes in reversed(levels[:-1]):
        sides = []
        for i in range(len(nodes)):
            run = i - i % FANOUT
            sides.append([("".join(nodes[run:i]), "".join(nodes[i + 1:run + FANOUT])), *above[i // FANOUT]])
        above = sides
    return above


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each (tree, cell), from batches sorted by them; a cell is bounded."""
    held, last = [], None
    for batch in batches:
        keys = list(zip(batch.column("tree").to_pylist(), batch.column("cell").to_pylist(), strict=True))
        start = 0
        for i, key in enumerate(keys):
            if key != last:
                if i > start:
                    held.append(batch.slice(start, i - start))
                if held:
                    yield pa.Table.from_batches(held)
                held, start, last = [], i, key
        if start < len(keys):
            held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)


def _roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in _cells(batches):
        leaves = table.column("leaf").to_pylist()
        yield pa.RecordBatch.from_pydict({
            "tree": table.column("tree").slice(0, 1).combine_chunks(), "cell": table.column("cell").slice(0, 1).combine_chunks(),
            "inner": pa.array([_levels(leaves, False)[-1][0]]), "alone": pa.array([_levels(leaves, True)[-1][0]])})


def _proofs(keep: list[str], types: list[pa.DataType]):
    """Rows of a cell begin with the cell's own row (at = -1), which brings the upper proof."""
    pair = pa.struct([("left", pa.string()), ("right", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _cells(batches):
            head = table.slice(0, 1).to_pylist()[0]
            table = table.slice(1)
            if not table.num_rows:
                continue
            leaves = table.column("leaf").to_pylist()
            upper = [(p["left"], p["right"]) for p in head["up"]]
            proofs = [[*sides, *upper] for sides in _sides(_levels(leaves, head["cells"] == 1))]
            flat = [p for proof in proofs for p in proof]
            ends = [0]
            for proof in proofs:
                ends.append(ends[-1] + len(proof))
            items = pa.StructArray.from_arrays([pa.array([p[0] for p in flat], pa.string()),
                                                pa.array([p[1] for p in flat], pa.string())], fields=list(pair))
            n = table.num_rows
            yield pa.RecordBatch.from_arrays(
                [*(table.column(c).combine_chunks().cast(t) for c, t in zip(keep, types, strict=True)),
                 pa.array(leaves), pa.array([head["subroot"]] * n), pa.array([head["root"]] * n),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), items)],
                [*keep, "leaf", "subroot", "root", "proof"])
    return run


def _targets(w: int) -> Column:
    """Cells that a cell sends its subtree's root to in the round of subtrees of
    ``w`` cells, itself among them."""
    node = F.floor(F.col("cell") / w)
    place = F.col("cell") % w
    size = F.least(F.lit(w).cast("long"), F.col("cells") - node * w)
    first = F.floor(node / FANOUT) * FANOUT
    last = F.least(first + (FANOUT - 1), F.floor((F.col("cells") - 1) / w))
    places = F.sequence(place, F.lit(w - 1).cast("long"), size)
    sent = F.flatten(F.transform(F.filter(F.sequence(first, last), lambda j: j != node),
                                 lambda j: F.transform(places, lambda q: j * w + q)))
    return F.concat(F.array(F.col("cell")), F.filter(sent, lambda t: t < F.col("cells")))


def _round(state: DataFrame, w: int) -> DataFrame:
    """One exchange: each cell learns the roots of its run of subtrees of w cells."""
    node = F.floor(F.col("cell") / w)
    sent = state.select("tree", "cells", "cell", "root", "up", node.alias("node"),
                        F.explode(F.when(F.col("cells") > w, _targets(w)).otherwise(F.array("cell"))).alias("target"))
    own = F.col("cell") == F.col("target")
    heard = sent.groupBy("tree", "target").agg(
        F.sort_array(F.collect_list(F.struct("node", "root"))).alias("run"),
        F.max(F.when(own, F.col("node"))).alias("mine"), F.max("cells").alias("cells"),
        F.max(F.when(own, F.col("root"))).alias("root"), F.max_by("up", own).alias("up"))
    side = lambda keep: F.array_join(F.transform(F.filter("run", keep), lambda x: x["root"]), "")
    joined = F.col("cells") > w
    level = F.struct(side(lambda x: x["node"] < F.col("mine")).alias("left"),
                     side(lambda x: x["node"] > F.col("mine")).alias("right"))
    parent = F.sha2(F.array_join(F.transform("run", lambda x: x["root"]), ""), 256)
    return heard.select("tree", F.col("target").alias("cell"), "cells",
                        F.when(joined, parent).otherwise(F.col("root")).alias("root"),
                        F.when(joined, F.concat("up", F.array(level))).otherwise(F.col("up")).alias("up"))


def _climb(leaves: DataFrame) -> DataFrame:
    """(tree, cell, cells, root, up) of ``leaves`` (tree, cell, at, leaf): per cell the
    root of its tree and the levels of the proofs above the cell."""
    ordered = leaves.select("tree", "cell", "at", "leaf").repartition("tree", "cell").sortWithinPartitions(
        "tree", "cell", "at")
    cells = cut(ordered.mapInArrow(_roots, "tree string, cell long, inner string, alone string"))
    sizes = cells.groupBy("tree").agg(F.count(F.lit(1)).alias("cells"))
    state = cells.join(sizes, "tree").select(
        "tree", "cell", "cells", F.when(F.col("cells") > 1, F.col("inner")).otherwise(F.col("alone")).alias("root"),
        F.array().cast(PROOF).alias("up"))
    largest, w = sizes.agg(F.max("cells")).first()[0] or 0, 1
    while w < largest:
        state, w = _round(state, w), w * FANOUT
    return cut(state)


def _with_proofs(leaves: DataFrame, cells: DataFrame, keep: Sequence[str]) -> DataFrame:
    """``keep``, leaf, subroot, root and proof per leaf, from ``cells`` (tree, cell,
    cells, subroot, root, up)."""
    ship_package(leaves.sparkSession)
    kept = leaves.select(*keep)
    own = cells.select("tree", "cell", F.lit(-1).cast("long").alias("at"), "cells", "subroot", "root", "up")
    rows = leaves.select("tree", "cell", "at", "leaf", *keep).unionByName(own, allowMissingColumns=True)
    types = [to_arrow_type(f.dataType) for f in kept.schema.fields]
    shape = StructType([*(StructField(f.name, f.dataType) for f in kept.schema.fields), *StructType.fromDDL(
        f"leaf string, subroot string, root string, proof {PROOF}").fields])
    return (rows.repartition("tree", "cell").sortWithinPartitions("tree", "cell", "at")
            .mapInArrow(_proofs(list(keep), types), shape))


def merkle_proofs(rows: DataFrame, order: Sequence[str], group: str, leaf: str,
                  keep: Sequence[str]) -> DataFrame:
    """``keep`` (column names other than leaf, subroot, root, proof), leaf,
    subroot, root and proof per row. ``group`` (string) names the tree of a row,
    ``order`` its place there, ``leaf`` its hash; names that begin with ``_m_``
    are reserved."""
    ship_package(rows.sparkSession)
    named = rows.select(
        F.when(F.col(group).isNull(), "").otherwise(F.concat(F.lit("="), F.col(group))).alias("tree"),
        F.col(leaf).alias("leaf"), *(F.col(c).alias(f"_m_o{i}") for i, c in enumerate(order)),
        *(F.col(c).alias(f"_m_k{i}") for i, c in enumerate(keep)))
    leaves = cut(with_rank(named, [f"_m_o{i}" for i in range(len(order))] + ["leaf"], ["tree"], "at")
                 .withColumn("cell", F.floor(F.col("at") / CELL)))
    cells = _climb(leaves)
    # Every cell holds its tree's root; the first one speaks for the tree.
    subroots = with_rank(cells.where("cell = 0").select(F.col("tree").alias("_m_tree"), F.col("root").alias("leaf")),
                         ["_m_tree"], name="at").withColumns(
        {"tree": F.lit(""), "cell": F.floor(F.col("at") / CELL)})
    subroots = cut(subroots)
    top = _climb(subroots).withColumn("subroot", F.lit(None).cast("string"))
    trees = _with_proofs(subroots, top, ["_m_tree"]).select(
        F.col("_m_tree").alias("tree"), F.col("leaf").alias("subroot"), F.col("root").alias("top"), F.col("proof").alias("above"))
    cells = cells.join(trees, "tree").select("tree", "cell", "cells", "subroot", F.col("top").alias("root"),
                                             F.concat("up", "above").alias("up"))
    out = _with_proofs(leaves, cells, [f"_m_k{i}" for i in range(len(keep))])
    return out.select(*(F.col(f"_m_k{i}").alias(c) for i, c in enumerate(keep)), "leaf", "subroot", "root", "proof")


def document_manifest(docs: DataFrame, columns: Sequence[str], changed: Column | None = None) -> DataFrame:
    """doc_id, changed_leaf, leaf, subroot, root, proof of documents hashed over
    ``columns``, per source in order of doc_id. ``changed``: a column that stands
    for the text where not null, for the check of a tampered row."""
    rows = docs.select(*(F.col(c) for c in columns), *([changed.alias("_m_changed")] if changed is not None else []))
    leaf = leaf_hash([F.col(c) for c in columns])
    other = F.lit(None).cast("string")
    if changed is not None:
        other = F.when(F.col("_m_changed").isNotNull(), leaf_hash(
            [F.col("_m_changed") if c == "text" else F.col(c) for c in columns]))
    rows = rows.select("doc_id", F.col("source").alias("_m_source"), leaf.alias("_m_leaf"), other.alias("changed_leaf"))
    return merkle_proofs(rows, ["doc_id"], "_m_source", "_m_leaf", ["doc_id", "changed_leaf"])
