"""Conversation structure repair: the cheapest edits that give a legal order of
roles, found by bidirectional Dijkstra over the edit lattice.

A lattice node is (rows read, role state); the states are nothing yet, system,
user, assistant. Keep costs 0, Rerole (to user or assistant) 1, Delete 2, Insert
(an empty user or assistant turn) 5; blank and repeated rows must be deleted,
truncated rows that stay cost 5 more. Legal results are empty or an optional
system turn and then user, assistant pairs. A forward and a reverse heap run
towards each other; when the sum of their least entries passes the best meeting,
all equal-cost crossings are known, and the least concatenated audit (initials of
the edits, compared as ASCII) is picked from them. A prefix that another one
continues cannot be dropped yet, so both stay until what follows decides.

Rows are range-partitioned by (conversation, turn) and cut into blocks of at most
``BLOCK_ROWS`` rows, so a conversation may span any number of tasks. Blocks are
solved on their own: a block that is a whole conversation from start to end, a
part of a longer one for every pair of states at its ends. The pairs are joined
from the last block to the first, which only handles codes of a byte per row (a
conversation's audit is one value of the result anyway). Blocks then get their
part of the audit back, and the digest runs over the sorted blocks, one at a time.

Defined cases: null roles and texts are one space; a null conversation id is a
conversation; null turns come first; rows of equal turn stand in the order of
role and text; an empty role has no initial, so it is never kept; texts are read
whole; a conversation without rows has cost 0 and an empty audit; an empty table
gives no rows; extra columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from .common import cut, ship_package

BLOCK_ROWS, BLOCK_BYTES = 256, 1 << 20
BLANKS = " \t\n\x0b\x0c\r"
START, SYSTEM, USER, ASSISTANT = range(4)
INITIALS = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
NEXT_ROLE = {START: USER, SYSTEM: USER, ASSISTANT: USER, USER: ASSISTANT}
ROLE_NAMES = {USER: "user", ASSISTANT: "assistant"}
RETYPE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
GONE = "-"  # code of a row that must be deleted; else its initial (or x), upper case if truncated


def _edges(codes: str, i: int, q: int) -> list[tuple[int, str, int, int]]:
    """(cost, initial, i, q) of the edits at a node."""
    q2 = NEXT_ROLE[q]
    out = [(INSERT, "I", i, q2)]
    if i < len(codes):
        code = codes[i]
        out.append((DELETE, "D", i + 1, q))
        if code != GONE:
            role = INITIALS.get(code.lower())
            more = TRUNCATED if code.isupper() else 0
            if role == q2 or (role == SYSTEM and q == START):
                out.append((more, "K", i + 1, role))
            if role != q2:
                out.append((RETYPE + more, "R", i + 1, q2))
    return out


def _back_edges(codes: str, i: int, q: int) -> list[tuple[int, str, int, int]]:
    """(cost, initial, i, q) of the edits that lead to a node."""
    out = []
    for p in (START, SYSTEM, USER, ASSISTANT):
        for j in (i, i - 1):
            if j >= 0:
                out += [(w, c, j, p) for w, c, i2, q2 in _edges(codes, j, p) if i2 == i and q2 == q]
    return out


def _open(audits: set[str]) -> list[str]:
    """The least audit and those that continue it: any other loses whatever follows."""
    least = min(audits)
    return sorted(a for a in audits if a.startswith(least))


def cheapest(codes: str, enter: int = START, exits: tuple[int, ...] = (START, ASSISTANT)) -> tuple[int, list[str]] | None:
    """Least cost from state ``enter`` before the rows to one of ``exits`` behind
    them, and the audits of that cost that may turn out least."""
    n = len(codes)
    source, targets = (0, enter), {(n, q) for q in exits}
    dist = ({source: 0}, {t: 0 for t in targets})
    heap = ([(0, source)], [(0, t) for t in sorted(targets)])
    done: tuple[set, set] = (set(), set())
    best = 0 if source in targets else None
    while heap[0] and heap[1]:
        if best is not None and heap[0][0][0] + heap[1][0][0] > best:
            break
        # Both ends are opened first, then the side with the smaller least entry.
        side = 0 if not done[0] else 1 if not done[1] else int(heap[1][0][0] < heap[0][0][0])
        d, node = heappop(heap[side])
        if node in done[side] or d > dist[side][node]:
            continue
        done[side].add(node)
        for w, _, i, q in (_edges, _back_edges)[side](codes, *node):
            to, total = (i, q), d + w
            if total < dist[side].get(to, total + 1):
                dist[side][to] = total
                heappush(heap[side], (total, to))
            if to in dist[1 - side]:
                met = dist[side][to] + dist[1 - side][to]
                best = met if best is None else min(best, met)
    if best is None:
        return None
    ahead, behind = dist

    heads: dict = {source: [""]}
    for u in sorted(done[0], key=lambda x: (x[0], ahead[x])):
        if u != source:
            found = {a + c for w, c, i, q in _back_edges(codes, *u)
                     if (i, q) in heads and ahead[i, q] + w == ahead[u] for a in heads[i, q]}
            if found:
                heads[u] = _open(found)
    tails: dict = {}
    for v in sorted(done[1] | targets, key=lambda x: (-x[0], behind[x])):
        found = {c + a for w, c, i, q in _edges(codes, *v)
                 if (i, q) in tails and behind[i, q] + w == behind[v] for a in tails[i, q]}
        if v in targets:
            found.add("")
        if found:
            tails[v] = _open(found)
    crossings = {a + b for u in heads if u in tails and ahead[u] + behind[u] == best for a in heads[u] for b in tails[u]}
    for u, starts in heads.items():
        for w, c, i, q in _edges(codes, *u):
            if (i, q) in tails and ahead[u] + w + behind[i, q] == best:
                crossings |= {a + c + b for a in starts for b in tails[i, q]}
    return best, _open(crossings)


class Rope:
    """An audit as segments that share their tails, compared segment by segment."""

    __slots__ = ("head", "tail")

    def __init__(self, head: str, tail: Rope | None):
        self.head, self.tail = head, tail

    def parts(self) -> Iterator[str]:
        rope: Rope | None = self
        while rope is not None:
            yield rope.head
            rope = rope.tail


def _less(a: Rope, b: Rope) -> bool:
    x, y, s, t = a, b, a.head, b.head
    while True:
        while not s:
            if x.tail is None:
                return bool(t) or y.tail is not None and any(y.tail.parts())
            x, s = x.tail, x.tail.head
        while not t:
            if y.tail is None:
                return False
            y, t = y.tail, y.tail.head
        k = min(len(s), len(t))
        if s[:k] != t[:k]:
            return s[:k] < t[:k]
        s, t = s[k:], t[k:]
        if not s and not t and x.tail is y.tail:
            return False


#: (state before, state behind) of a block that some edits lead from one to the other
PAIRS = [(START, q) for q in range(4)] + [(SYSTEM, q) for q in (SYSTEM, USER, ASSISTANT)] \
    + [(p, q) for p in (USER, ASSISTANT) for q in (USER, ASSISTANT)]


def solve_block(codes: str, whole: bool) -> list[tuple[int, int, int, list[str]]]:
    """(enter, exit, cost, audits) of a block; a whole conversation has one, with exit -1."""
    if whole:
        cost, audits = cheapest(codes)
        return [(START, -1, cost, audits[:1])]
    solved = ((p, q, cheapest(codes, p, (q,))) for p, q in PAIRS)
    return [(p, q, *found) for p, q, found in solved if found is not None]


def join_blocks(blocks: list[list[tuple[int, int, int, list[str]]]]) -> tuple[int, list[tuple[int, str]]]:
    """Cost of a conversation, and (state before, audit) of each of its blocks."""
    end = Rope("", None)
    best = {q: (0, end, None) for q in (START, ASSISTANT, -1)}
    steps = []
    for block in reversed(blocks):
        now: dict = {}
        for enter, leave, cost, audits in block:
            if leave not in best:
                continue
            behind, tail, _ = best[leave]
            for audit in audits:
                rope = Rope(audit, tail)
                if enter not in now or cost + behind < now[enter][0] or (
                        cost + behind == now[enter][0] and _less(rope, now[enter][1])):
                    now[enter] = (cost + behind, rope, leave)
        best = now
        steps.append(now)
    total, q, out = best[START][0], START, []
    for now in reversed(steps):
        _, rope, leave = now[q]
        out.append((q, rope.head))
        q = leave
    return total, out


def apply_edits(q: int, audit: str, roles: list[str], texts: list[str]) -> list[tuple[str, str, str]]:
    """(edit, role, text) of the turns that a block keeps or gains, from state ``q``."""
    out, i = [], 0
    for edit in audit:
        if edit == "I":
            q = NEXT_ROLE[q]
            out.append((edit, ROLE_NAMES[q], ""))
            continue
        if edit == "K":
            q = INITIALS[roles[i][:1]]
            out.append((edit, roles[i], texts[i]))
        elif edit == "R":
            q = NEXT_ROLE[q]
            out.append((edit, ROLE_NAMES[q], texts[i]))
        i += 1
    return out


def damage(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies: rows damaged by a checksum of id and turn
    (dropped rows have no copies, so their conversations stay known)."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn"))) % 20
    return rows.select(
        "conv_id", "turn", F.when(fault == 4, "user").otherwise(said("role")).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.regexp_replace(said("text"), "[.!?]", "")).otherwise(said("text")).alias("text"),
        F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).alias("copies"))


def _marked(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, code: rows with their first fault."""
    bare = F.rtrim(F.col("text"), F.lit(BLANKS))
    same = Window.partitionBy("conv_id", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    initial = F.left("role", F.lit(1))
    code = F.when(initial.isin(*INITIALS), initial).otherwise("x")
    return rows.withColumn("again", F.row_number().over(same) > 1).select(
        "conv_id", "turn", "role", "text", "again",
        F.when(bare == "", "blank").when(F.col("again"), "duplicate")
        .when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), "truncated").alias("fault"), code.alias("code"))


_STATS = ("codes string, roles array<string>, texts array<string>, first string, last string, low long, high long, "
          "turns long, blank long, duplicate long, truncated long, illegal long")


def _block(rows: list[dict], part: int, seq: int) -> dict:
    initials = [r["role"][:1] for r in rows]
    turns = [r["turn"] for r in rows if r["turn"] is not None]
    faults = [r["fault"] for r in rows]
    gone = [f in ("blank", "duplicate") for f in faults]
    return {
        "conv_id": rows[0]["conv_id"], "part": part, "seq": seq,
        "codes": "".join(GONE if g else r["code"].upper() if r["fault"] else r["code"] for r, g in zip(rows, gone, strict=True)),
        "roles": [r["role"] for r in rows], "texts": [None if g else r["text"] for r, g in zip(rows, gone, strict=True)],
        "first": initials[0], "last": initials[-1], "low": min(turns, default=None), "high": max(turns, default=None),
        "turns": len(set(turns)), **{f: faults.count(f) for f in ("blank", "duplicate", "truncated")},
        "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))}


def _arrow(schema: StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _cut_blocks(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        size = seq = 0
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if held and (row["conv_id"] != held[0]["conv_id"] or len(held) >= BLOCK_ROWS or size >= BLOCK_BYTES):
                    out.append(_block(held, held[0]["part"], seq))
                    held, size, seq = [], 0, seq + 1
                held.append(row)
                size += len(row["text"])
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)
        if held:
            yield pa.RecordBatch.from_pylist([_block(held, held[0]["part"], seq)], schema)
    return run


_OPTIONS = "array<struct<enter: int, leave: int, cost: long, audits: array<string>>>"


def _solve(schema: pa.Schema, known_limit: int = 50_000):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}  # codes repeat: short conversations have few
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                key = (row.pop("codes"), row.pop("blocks") == 1)
                if key not in known:
                    if len(known) >= known_limit:
                        known.clear()
                    known[key] = [dict(zip(("enter", "leave", "cost", "audits"), x, strict=True)) for x in solve_block(*key)]
                out.append({**row, "options": known[key]})
            yield pa.RecordBatch.from_pylist(out, schema)
    return run


def _join(schema: pa.Schema):
    """Blocks sorted by conversation -> their audits; the first block also has the whole one and the cost."""
    def joined(blocks: list[dict]) -> list[dict]:
        cost, parts = join_blocks([[tuple(o.values()) for o in b["options"]] for b in blocks])
        whole = "".join(a for _, a in parts)
        return [{"conv_id": b["conv_id"], "part": b["part"], "seq": b["seq"], "enter": q, "edits": a,
                 "cost": None if i else cost, "audit": None if i else whole}
                for i, (b, (q, a)) in enumerate(zip(blocks, parts, strict=True))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if held and row["conv_id"] != held[0]["conv_id"]:
                    out += joined(held)
                    held = []
                held.append(row)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)
        if held:
            yield pa.RecordBatch.from_pylist(joined(held), schema)
    return run


def _edit(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pylist([
                {"conv_id": r["conv_id"], "part": r["part"], "seq": r["seq"],
                 "turns": [{"edit": e, "role": a, "text": t}
                           for e, a, t in apply_edits(r["enter"], r["edits"], r["roles"], r["texts"])]}
                for r in batch.to_pylist()], schema)
    return run


def _digest(schema: pa.Schema):
    """Blocks sorted by conversation -> one digest per conversation; one block is held at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, digest, begun, any_row = None, hashlib.sha256(), False, False
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if any_row and row["conv_id"] != last:
                    out.append({"conv_id": last, "repaired_sha256": digest.hexdigest()})
                    digest, begun = hashlib.sha256(), False
                any_row, last = True, row["conv_id"]
                for turn in row["turns"]:
                    digest.update((("\n" if begun else "") + turn["role"] + ":" + turn["text"]).encode())
                    begun = True
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)
        if any_row:
            yield pa.RecordBatch.from_pylist([{"conv_id": last, "repaired_sha256": digest.hexdigest()}], schema)
    return run


class Repair:
    """The repaired conversations: ``blocks`` (conv_id, part, seq, turns) hold the
    turns that stay, with their edits, in order; ``summary`` has one row per
    conversation with its faults, cost, audit and the digest of its turns."""

    def __init__(self, rows: DataFrame):
        spark = rows.sparkSession
        ship_package(spark)
        kind = rows.schema["conv_id"].dataType

        def shape(columns: str) -> StructType:
            return StructType([StructField("conv_id", kind), *StructType.fromDDL(columns).fields])

        def mapped(df: DataFrame, kernel, columns: str) -> DataFrame:
            return df.mapInArrow(kernel(_arrow(shape(columns))), shape(columns))

        copies = F.col("copies") if "copies" in rows.columns else F.lit(1)
        said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
        given = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), said("role"), said("text"), copies.alias("copies"))
        self.conversations = given.select("conv_id").distinct()
        given = given.where("copies > 0").select(
            "conv_id", "turn", "role", "text", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
        # A conversation may span tasks, and so may one turn of it.
        ranged = (_marked(given).withColumn("lead", F.left("text", F.lit(64)))
                  .repartitionByRange("conv_id", "turn", "role", "lead").withColumn("part", F.spark_partition_id())
                  .sortWithinPartitions("conv_id", "turn", "role", "text", "again"))
        blocks = cut(mapped(ranged.select("conv_id", "part", "turn", "role", "text", "fault", "code"), _cut_blocks,
                            f"part int, seq long, {_STATS}"))
        counted = blocks.select("conv_id", "part", "seq", "codes",
                                F.count(F.lit(1)).over(Window.partitionBy("conv_id")).alias("blocks"))
        solved = mapped(counted, _solve, f"part int, seq long, options {_OPTIONS}")
        ordered = lambda df: df.repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq")
        edits = cut(mapped(ordered(solved), _join, "part int, seq long, enter int, edits string, cost long, audit string"))
        self.blocks = mapped(blocks.select("conv_id", "part", "seq", "roles", "texts")
                             .join(edits.select("part", "seq", "enter", "edits"), ["part", "seq"])
                             .select("conv_id", "part", "seq", "roles", "texts", "enter", "edits"), _edit,
                             "part int, seq long, turns array<struct<edit: string, role: string, text: string>>")
        self._stats, self._edits = blocks.drop("roles", "texts", "codes"), edits
        self._mapped, self._ordered = mapped, ordered

    def turns(self) -> DataFrame:
        """conv_id, part, seq, position, edit, role, text: one row per turn of the result."""
        return self.blocks.select("conv_id", "part", "seq", F.posexplode("turns").alias("position", "turn")).select(
            "conv_id", "part", "seq", "position", "turn.*")

    def summary(self) -> DataFrame:
        before = Window.partitionBy("conv_id").orderBy("part", "seq")
        gap = F.concat(F.lag("last").over(before), F.col("first"))
        stats = self._stats.withColumns({
            "across": (~gap.isin("su", "ua", "au")).cast("long"),
            "shared": (F.lag("high").over(before) == F.col("low")).cast("long")})
        total = lambda *c: sum((F.coalesce(F.sum(x), F.lit(0)) for x in c[1:]), F.coalesce(F.sum(c[0]), F.lit(0)))
        stats = stats.groupBy("conv_id").agg(
            F.coalesce(F.max("high") - F.min("low") + 1 - F.sum("turns") + total("shared"), F.lit(0)).alias("gaps"),
            *(total(c).alias(c) for c in ("blank", "duplicate", "truncated")), total("illegal", "across").alias("illegal"))
        digests = self._mapped(self._ordered(self.blocks), _digest, "repaired_sha256 string")
        costs = self._edits.where("audit is not null").select("conv_id", "cost", "audit")
        # One row per conversation on every side; the null id joins by its own key.
        key = lambda df: df.withColumn("k", F.struct(F.col("conv_id").isNull().alias("none"), F.coalesce(
            F.col("conv_id").cast("string"), F.lit("")).alias("id")))
        out = key(self.conversations)
        for side in (stats, costs, digests):
            out = out.join(key(side).drop("conv_id"), "k", "left")
        counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
        return out.select("conv_id", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts),
                          F.coalesce("audit", F.lit("")).alias("audit"),
                          F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def repair_conversations(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``rows`` (conv_id, turn, role, text, and
    optionally copies): conv_id, gaps, blank, duplicate, truncated, illegal, cost,
    audit, repaired_sha256."""
    return Repair(rows).summary()
