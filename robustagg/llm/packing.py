"""Best-fit packing by non-negative least squares over length patterns.

Documents become token ids (plus an end id); longer ones are cut into full
pieces, the first piece taking the remainder. Full pieces are sequences by
themselves. The histogram of the other lengths (fewer rows than a sequence has
tokens) goes to the driver, which

1. enumerates patterns of one to three lengths that fill a sequence exactly,
2. fits how often to repeat each, by non-negative least squares against the
   histogram (coordinate descent),
3. rounds the counts, never above what the histogram holds, and
4. packs the residual histogram best-fit, largest first.

The packing is a short table of rank ranges per length: the r-th document of a
length goes to the sequence and offset that the table names, so documents are
placed by a rank and a lookup. Ranks are exact and distributed (counts per hash
bucket, then numbering inside a bucket).

Defined cases: null text is empty, an empty text is its end id; repeated rows
are separate documents; a null doc_id is carried along; an empty table gives no
rows. Placement is deterministic up to documents that agree in doc_id and ids.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, ship_package
from .pieces import byte_tokens, forget
from .words import ragged, releasing, slices

SLICE_BYTES = 1 << 18


def _tokenize(path: str, end_id: int, size: int, keep_ids: bool):
    def tokenize(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, counts = byte_tokens(path).ids(batch.column("text"))
        ends = np.cumsum(counts)
        ids = np.insert(ids, ends, np.uint32(end_id)).astype("<u4")
        counts = counts + 1
        crcs, n_pieces, raw, at = [], [], memoryview(ids).cast("B"), 0
        cuts = [0]
        for n in counts.tolist():
            first = n if n <= size else n % size or size
            bounds = [0, *range(first, n + 1, size)]
            crcs += [zlib.crc32(raw[4 * (at + a):4 * (at + b)]) for a, b in zip(bounds, bounds[1:], strict=False)]
            cuts += [at + b for b in bounds[1:]]
            n_pieces.append(len(bounds) - 1)
            at += n
        out = {"doc_id": batch.column("doc_id"), "n_ids": pa.array(counts, pa.int64()),
               "crcs": ragged(np.array(crcs, np.int64), np.array(n_pieces, np.int64), pa.int64())}
        if keep_ids:
            lists = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(ids.astype(np.int32)))
            at = np.concatenate([[0], np.cumsum(n_pieces)]).astype(np.int32)
            out["ids"] = pa.ListArray.from_arrays(pa.array(at), lists)
        return pa.RecordBatch.from_pydict(out)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:  # a slice's arrays go before the next slice's come
            yield from map(tokenize, slices(batches, "text", SLICE_BYTES))
        finally:  # the model and the table of known words go: the worker goes on to other stages
            forget(path)
    return releasing(whole)


def patterns(size: int, lengths: list[int], spread: int = 24) -> list[tuple[int, ...]]:
    """Patterns of one to three present lengths that sum to ``size``. For every
    smallest length of a triple, ``spread`` middle lengths evenly over its range."""
    have, out = set(lengths), set()
    for a in sorted(have):
        if a == size:
            out.add((a,))
        if a <= size - a and size - a in have:
            out.add((a, size - a))
        middle = [b for b in sorted(have) if a <= b <= size - a - b and size - a - b in have]
        for b in middle[::max(1, len(middle) // spread)]:
            out.add((a, b, size - a - b))
    return sorted(out)


def fit(patterns: list[tuple[int, ...]], histogram: dict[int, int], sweeps: int = 30) -> np.ndarray:
    """Repeat counts x >= 0 of least squared difference to the histogram."""
    uses = [[(length, p.count(length)) for length in sorted(set(p))] for p in patterns]
    norm = [sum(m * m for _, m in u) for u in uses]
    rest = {length: float(n) for length, n in histogram.items()}
    x = np.zeros(len(patterns))
    for _ in range(sweeps):
        moved = 0.0
        for i, u in enumerate(uses):
            new = max(0.0, x[i] + sum(m * rest[length] for length, m in u) / norm[i])
            step = new - x[i]
            if step:
                for length, m in u:
                    rest[length] -= m * step
                x[i] = new
                moved = max(moved, abs(step))
        if moved < 0.05:
            break
    return x


def best_fit(histogram: dict[int, int], size: int) -> list[tuple[tuple[int, ...], int]]:
    """(pattern, repeats) of best-fit decreasing over a histogram of lengths."""
    open_: dict[int, list[list]] = {}  # free space: [pattern, repeats]
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            space = min((s for s, bins in open_.items() if s >= length and bins), default=None)
            if space is None:
                fits = size // length
                whole, last = divmod(left, fits)
                for k, times in ((fits, whole), (last, 1 if last else 0)):
                    if times:
                        open_.setdefault(size - k * length, []).append([(length,) * k, times])
                break
            bins = open_[space][-1]
            times = min(left, bins[1])
            open_.setdefault(space - length, []).append([bins[0] + (length,), times])
            bins[1] -= times
            left -= times
            if not bins[1]:
                open_[space].pop()
    return [(p, n) for bins in open_.values() for p, n in bins if n]


def plan(histogram: dict[int, int], size: int) -> list[tuple[tuple[int, ...], int]]:
    """(pattern, repeats) that place every length of the histogram exactly."""
    left = dict(histogram)
    candidates = patterns(size, list(left))
    counts = fit(candidates, left)
    out = []
    for i in np.argsort(-counts, kind="stable").tolist():
        p = candidates[i]
        times = min([round(float(counts[i])), *(left[length] // p.count(length) for length in set(p))])
        if times > 0:
            out.append((p, times))
            for length in p:
                left[length] -= times
    return out + best_fit({length: n for length, n in left.items() if n}, size)


class Slots:
    """Where the r-th document of a length goes: arrays sorted by (length, first rank)."""

    def __init__(self, packed: list[tuple[tuple[int, ...], int]]):
        rows, used, sequence = [], {}, 0
        for pattern, times in packed:
            offset = 0
            for length in pattern:
                first = used.get(length, 0)
                rows.append((length, first, sequence, offset))
                used[length] = first + times
                offset += length
            sequence += times
        rows.sort()
        self.sequences = sequence
        self.length, self.first, self.sequence, self.offset = (
            np.array([r[i] for r in rows], np.int64) for i in range(4))
        self.begin = {int(v): int(k) for v, k in zip(*np.unique(self.length, return_index=True), strict=True)}

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.lexsort((rank, length))
        sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
        values, starts = np.unique(length[order], return_index=True)
        for v, a, b in zip(values.tolist(), starts, [*starts[1:], len(order)], strict=True):
            if v not in self.begin:
                continue  # documents of full pieces only
            who = order[a:b]
            i = self.begin[v]
            j = i + int(np.searchsorted(self.length[i:], v, "right"))
            k = i + np.searchsorted(self.first[i:j], rank[who], "right") - 1
            sequence[who] = self.sequence[k] + rank[who] - self.first[k]
            offset[who] = self.offset[k]
        return sequence, offset


def _place(slots: Slots):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            get = lambda c: batch.column(c).to_numpy(zero_copy_only=False)  # noqa: E731, B023
            sequence, offset = slots.place(get("short"), get("rank"))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(sequence), pa.array(offset)], [*batch.schema.names, "_sequence", "_offset"])
    return place


def pack_documents(docs: DataFrame, tokenizer: str, size: int = 1024, end_id: int = 2, keep_ids: bool = False,
                   bucket_rows: int = 100_000) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids): one
    row per piece. ``tokenizer``: path of a byte-level vocabulary file."""
    ship_package(docs.sparkSession)
    kind = "doc_id long, n_ids long, crcs array<long>" + (", ids array<array<int>>" if keep_ids else "")
    rows = cut(docs.select("doc_id", "text").mapInArrow(_tokenize(tokenizer, end_id, size, keep_ids), kind))
    short = F.when(F.col("n_ids") < size, F.col("n_ids")).otherwise(F.col("n_ids") % size)
    full = F.when(F.col("n_ids") < size, 0).otherwise(F.floor(F.col("n_ids") / size))
    rows = rows.withColumns({"short": short, "full": full})
    histogram = {r["short"]: r["n"] for r in  # fewer than ``size`` rows
                 rows.where("short > 0").groupBy("short").agg(F.count(F.lit(1)).alias("n")).collect()}
    slots = Slots(plan(histogram, size))
    buckets = max(1, -(-rows.count() // bucket_rows))
    rows = rows.withColumn("_b", F.expr(f"pmod(xxhash64(doc_id, 3), {buckets})"))
    order = ["doc_id", "n_ids", "crcs"]
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    # One row per length and bucket, and one per bucket.
    ranks = (rows.groupBy("short", "_b").agg(F.count(F.lit(1)).alias("n"))
             .withColumn("_r0", F.coalesce(F.sum("n").over(before.partitionBy("short")), F.lit(0))).drop("n"))
    fulls = (rows.groupBy("_b").agg(F.sum("full").alias("n"))
             .withColumn("_f0", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n"))
    inside = Window.partitionBy("_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = (rows.withColumn("_f", F.coalesce(F.sum("full").over(inside), F.lit(0)))
            .withColumn("_r", F.row_number().over(Window.partitionBy("_b", "short").orderBy(*order)) - 1)
            .join(ranks, ["short", "_b"]).join(fulls, "_b")
            .withColumn("rank", F.col("_r0") + F.col("_r"))
            .withColumn("_first", F.lit(slots.sequences) + F.col("_f0") + F.col("_f")))
    columns = ["doc_id", "short", "rank", "_first", "crcs", *(["ids"] if keep_ids else [])]
    rows = rows.select(*columns)
    placed = rows.mapInArrow(_place(slots), rows.withColumns(
        {"_sequence": F.lit(0).cast("long"), "_offset": F.lit(0).cast("long")}).schema)
    head = (F.col("short") > 0).cast("int")
    is_short = (F.col("piece") == 0) & (F.col("short") > 0)
    out = placed.select("*", F.posexplode("crcs").alias("piece", "ids_crc32"))
    return out.select(
        "doc_id", "piece",
        F.when(F.col("piece") == 0, 0).otherwise(F.col("short") + (F.col("piece") - head) * size)
        .cast("long").alias("start"),
        F.when(is_short, F.col("short")).otherwise(size).cast("long").alias("length"), "ids_crc32",
        F.when(is_short, F.col("_sequence")).otherwise(F.col("_first") + F.col("piece") - head)
        .cast("long").alias("sequence_id"),
        F.when(is_short, F.col("_offset")).otherwise(0).cast("long").alias("offset"),
        *([F.get("ids", F.col("piece")).alias("ids")] if keep_ids else []))
