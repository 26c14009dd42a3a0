"""Chat formatting of reply trees (DataFrame functions only).

A tree is given as nodes (tree, node, parent, role, text, score). Path doubling
- iterative self-joins on the ancestor 1, 2, 4, ... steps up - gives every
node's depth, root and summed path score in O(log depth) joins; leaves are
ranked by path score inside their tree; the chosen leaves' paths are expanded
by the same jump tables, largest jump first, and every path becomes one
formatted conversation.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n`` per turn. Control strings in
a text (those of this template and of other common ones) get one more backslash
after their first character; undoing it removes one, so a text that already
holds the escaped form survives as well. Roles are URL-encoded.

Defined cases: null text and null role are empty; null score counts 0; a null
tree or node is no node and is left out; a node whose parent is missing is a
root; equal scores rank by leaf id; repeated (tree, node) rows are one node (the
smallest row by role, text, score); nodes on a cycle are on no root-to-leaf path
and give no conversation; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

START, END = "<|im_start|>", "<|im_end|>\n"
CONTROL = r"([<\[])(\\*)((?:\|im_start\||\|im_end\||/?s)>|<?/?SYS>>|/?INST\])"
ESCAPED = r"([<\[])\\(\\*)((?:\|im_start\||\|im_end\||/?s)>|<?/?SYS>>|/?INST\])"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def reply_paths(nodes: DataFrame, top: int | None = None) -> DataFrame:
    """Root-to-leaf paths of the trees: (tree, leaf, rank, path_score, node,
    depth, role, text), the best ``top`` leaves of each tree (all when None)."""
    row = F.min(F.struct("role", "text", "score", "parent"))
    base = cut(nodes.select("tree", "node", "parent", F.coalesce("role", F.lit("")).alias("role"),
                            F.coalesce("text", F.lit("")).alias("text"),
                            F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))
               .where("tree is not null and node is not null")
               .groupBy("tree", "node").agg(row.alias("r")).select("tree", "node", "r.*"))
    up = base.select("tree", F.col("node").alias("parent"), F.lit(True).alias("known"))
    jump = cut(base.select("tree", "node", "parent", "score").join(up, ["tree", "parent"], "left")
               .select("tree", "node", F.when(F.col("known"), F.col("parent")).alias("up"),
                       F.col("score").alias("total"), F.lit(1).cast("long").alias("steps")))
    jumps, n_nodes = [], base.count()
    while jump.where("up is not null").limit(1).count():
        if 1 << len(jumps) > n_nodes:  # longer than any path: these nodes lead into a cycle
            break
        jumps.append(jump.where("up is not null").select("tree", "node", "up"))
        above = jump.select("tree", F.col("node").alias("up"), F.col("up").alias("up2"),
                            F.col("total").alias("t2"), F.col("steps").alias("s2"))
        jump = cut(jump.join(above, ["tree", "up"], "left")
                   .select("tree", "node", F.col("up2").alias("up"),
                           (F.col("total") + F.coalesce("t2", F.lit(0.0))).alias("total"),
                           # a cycle doubles its count for ever; the bound only keeps it a long
                           F.least(F.col("steps") + F.coalesce("s2", F.lit(0)), F.lit(1 << 60)).alias("steps")))
    inner = base.select("tree", F.col("parent").alias("node")).where("node is not null").distinct()
    leaves = (jump.where("up is null").join(inner, ["tree", "node"], "left_anti")
              .withColumn("rank", F.row_number().over(
                  Window.partitionBy("tree").orderBy(F.desc("total"), "node"))))
    if top is not None:
        leaves = leaves.where(F.col("rank") <= top)
    walk = leaves.select("tree", F.col("node").alias("leaf"), "rank", F.col("total").alias("path_score"), "node",
                         F.col("steps").alias("depth"))
    for k in reversed(range(len(jumps))):
        step = (walk.join(jumps[k], ["tree", "node"])
                .select("tree", "leaf", "rank", "path_score", F.col("up").alias("node"),
                        (F.col("depth") - (1 << k)).alias("depth")))
        walk = cut(walk.unionByName(step))  # else the plan doubles with every jump
    return walk.join(base.select("tree", "node", "role", "text"), ["tree", "node"])


def format_paths(paths: DataFrame) -> DataFrame:
    """One conversation per (tree, leaf): ``formatted`` and ``segments``, the
    same text cut where the loss mask changes, with the mask (``loss``)."""
    turn = F.struct("depth", "role", "text")
    turns = paths.groupBy("tree", "leaf", "rank", "path_score").agg(F.sort_array(F.collect_list(turn)).alias("turns"))

    def cut_turn(t: Column) -> Column:
        head, masked = F.concat(F.lit(START), F.url_encode(t["role"]), F.lit("\n")), t["role"] == "assistant"
        return F.array(F.struct(head.alias("text"), F.lit(False).alias("loss")),
                       F.struct(escape(t["text"]).alias("text"), masked.alias("loss")),
                       F.struct(F.lit(END).alias("text"), F.lit(False).alias("loss")))

    return (turns.withColumn("segments", F.flatten(F.transform("turns", cut_turn)))
            .select("tree", "leaf", "rank", "path_score",
                    F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), "segments"))


def parse_turns(formatted: Column) -> Column:
    """Turns (role, text) read back from a formatted conversation."""
    pieces = F.filter(F.split(formatted, r"<\|im_end\|>\n"), lambda p: p != "")

    def turn(p: Column) -> Column:
        role = F.substring_index(p, "\n", 1)
        return F.struct(F.url_decode(F.substr(role, F.lit(len(START) + 1))).alias("role"),
                        unescape(F.substr(p, F.char_length(role) + 2)).alias("text"))

    return F.transform(pieces, turn)


def conversation_id(tree: Column) -> Column:
    """The conversation that a tree of ``conversation_nodes`` stands for."""
    return F.when(~tree["none"], tree["id"])


def conversation_nodes(conversations: DataFrame) -> DataFrame:
    """Each conversation as a reply tree with one branch: a row answers the row
    before it by (turn, role, text); repeated rows stay rows. ``tree`` is a struct
    that ``conversation_id`` turns back, so that a null id is a conversation too."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = conversations.select("conv_id", "turn", "role", "text")
    some = F.lit("0").cast(rows.schema["conv_id"].dataType)
    tree = F.struct(F.col("conv_id").isNull().alias("none"), F.coalesce(F.col("conv_id"), some).alias("id"))
    return (rows.withColumn("node", F.row_number().over(order).cast("long"))
            .select(tree.alias("tree"), "node",
                    F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"),
                    "role", "text", F.lit(0.0).alias("score")))
