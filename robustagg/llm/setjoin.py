"""N-gram Jaccard join with set-relation skipping.

A document's set is its distinct word shingles. Two sets link when
100 * intersection >= threshold * union.

Index: of every distinct set only a prefix goes into index lists, the first
``n - ceil(t n) + 1`` shingles in one global order (shingles common in some
slice of the corpus last, by their summed counts; the rest by hash), so linked
sets share a list. Sets alone in their lists are done. A list is sorted by set size:
a set is compared with those behind it until one is too large, and the block
from there on is skipped. Comparing takes a fixed bitmap per set (parity of its
shingles per bit), whose distance never exceeds the sets' difference, so no
link is lost. What can link is joined to candidate cells (connected
components), each list giving a spanning set of its candidates only. No pair of sets is
ever a row.

Cells: each set comes once (``cell_shingles`` bounds a task; a larger cell is
cut by size and, if need be, into blocks that meet two by two). Inside, sets
go by size. A set that differs little from one just answered takes that set's
intersections and corrects them only by the lists of the shingles in which the
two differ; otherwise it reads its prefix lists, skipping by size and by
position, and intersects what is left. Both give exact intersections.

Equal sets are one class from the start, so copies cost one row each.

Defined cases: null or empty texts and texts without words have the empty set
and link with nothing; fewer words than a shingle are one shingle; repeated rows
are copies; rows with a null doc_id take part as copies but never name a
component (alone, their component is null); an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, cut, ship_package
from .words import LOWERED, find_words, mix, range_hashes, releasing, slices, windows

SLICE_BYTES, COUNTED_BYTES = 2 << 20, 12 << 20  # texts read at a time, texts whose shingles are counted together
HOT_IN_SLICE = 2
SMALL_SET = 1500  # larger sets get the long bitmap
SHORT, LONG = 512, 4096  # bits
LONG_LIST = 4096
HOT_KEPT = 1 << 20  # bound of the list of common shingles; it only shapes the order


def shingle_sets(column: pa.Array, k: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    w = find_words(column, LOWERED)
    grams = windows(w.hashes, k)
    short = range_hashes(w.hashes, w.first[:-1], w.first[1:])
    out = []
    for d, n in enumerate(w.counts.tolist()):
        a = w.first[d]
        out.append(np.unique(grams[a:a + n - k + 1]) if n >= k else short[d:d + 1] if n else grams[:0])
    return out


def prefix_length(n: int, t: int) -> int:
    return n - -(-t * n // 100) + 1


def _common(k: int):
    def shingles(batch: pa.RecordBatch) -> np.ndarray:
        return np.concatenate(shingle_sets(batch.column("text"), k))

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        every = np.concatenate([shingles(part) for part in slices([batch], "text", SLICE_BYTES)])
        every.sort()
        first = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]) if len(every) else every)
        counts = np.diff(first, append=len(every))
        often = counts >= HOT_IN_SLICE
        return pa.RecordBatch.from_arrays([pa.array(every[first[often]].view(np.int64)), pa.array(counts[often])],
                                          ["shingle", "n"])

    def common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from map(count, slices(batches, "text", COUNTED_BYTES))
    return common


def _prefixes(k: int, t: int, hot: np.ndarray):
    """``hot``: common shingles, most common first."""
    by_value = np.argsort(hot)
    values, rank = hot[by_value], len(hot) - by_value  # larger rank: more common, later in the order
    maybe = np.zeros(1 << 23, bool)
    maybe[hot & np.uint64(len(maybe) - 1)] = True

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE_BYTES):
            sizes, fp, tokens, bits = [], [], [], []
            for s in shingle_sets(batch.column("text"), k):
                digest = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
                fp.append(np.frombuffer(digest, np.int64))
                sizes.append(len(s))
                odd = np.bincount((mix(s) >> np.uint64(64 - 12)).astype(np.int64), minlength=LONG) & 1
                if len(s) <= SMALL_SET:
                    odd = odd.reshape(SHORT, -1).sum(axis=1) & 1
                bits.append(np.packbits(odd.astype(np.uint8)).tobytes())
                late = np.zeros(len(s), np.int64)
                check = np.flatnonzero(maybe[s & np.uint64(len(maybe) - 1)])
                if len(check) and len(values):
                    at = np.minimum(np.searchsorted(values, s[check]), len(values) - 1)
                    late[check] = np.where(values[at] == s[check], rank[at], 0)
                p = prefix_length(len(s), t) if len(s) else 0
                early = s[late == 0][:p]
                if len(early) < p:
                    more = np.flatnonzero(late)
                    early = np.append(early, s[more[np.argsort(late[more], kind="stable")[:p - len(early)]]])
                tokens.append(early.view(np.int64))
            fp = np.array(fp, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(np.ascontiguousarray(fp[:, 0])),
                 pa.array(np.ascontiguousarray(fp[:, 1])), pa.array(tokens, pa.list_(pa.int64())), pa.array(bits, pa.binary())],
                ["doc_id", "n", "c1", "c2", "tokens", "bits"])
    return prefixes


def _several(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by token: those whose token has another row."""
    last, given = None, False  # the row before, and whether it was given
    for batch in batches:
        if not batch.num_rows:
            continue
        token = batch.column("token").to_numpy(zero_copy_only=False)
        same = token[1:] == token[:-1]
        goes_on = last is not None and last.column("token")[0].as_py() == token[0]
        if goes_on and not given:
            yield last
        keep = np.concatenate([[goes_on], same]) | np.concatenate([same, [False]])
        yield batch.filter(pa.array(keep))
        last, given = batch.slice(batch.num_rows - 1), bool(keep[-1])


class _Bitmaps:
    """Parity of the shingles per bit: the distance of two bitmaps is at most the
    difference of the sets. A long bitmap's bytes fold to the bits of a short one."""

    def __init__(self, bits: list[bytes]):
        long = np.array([len(b) * 8 == LONG for b in bits], bool)
        self.long_at = np.cumsum(long) - 1
        self.long_at[~long] = -1
        raw = np.frombuffer(b"".join(b for b, x in zip(bits, long, strict=True) if x), np.uint8).reshape(-1, LONG // 8)
        self.long = raw.view(np.uint64)
        short = np.empty((len(bits), SHORT // 8), np.uint8)
        short[long] = np.packbits(np.bitwise_count(raw) & 1, axis=1)
        short[~long] = np.frombuffer(b"".join(b for b, x in zip(bits, long, strict=True) if not x),
                                     np.uint8).reshape(-1, SHORT // 8)
        self.short = short.view(np.uint64)

    def close(self, n: np.ndarray, i: np.ndarray, j: np.ndarray, t: int) -> np.ndarray:
        """Whether sets i and j can link."""
        total = n[i] + n[j]
        most = total - 2 * -(-t * total // (100 + t))  # largest difference of linked sets
        out = np.bitwise_count(self.short[i] ^ self.short[j]).sum(axis=1) <= most
        both = np.flatnonzero(out & (self.long_at[i] >= 0) & (self.long_at[j] >= 0))
        for part in np.array_split(both, 1 + len(both) // 20_000):
            a, b = self.long_at[i[part]], self.long_at[j[part]]
            out[part] = np.bitwise_count(self.long[a] ^ self.long[b]).sum(axis=1, dtype=np.int64) <= most[part]
        return out


def _list_links(t: int):
    """Links (a, b) that span the candidates of each index list. A list comes sorted
    by size; each set is compared with those behind it until a size is too large,
    and the block from there on is skipped. Lists longer than LONG_LIST are chained
    whole, which only makes cells larger."""
    def chain(token: np.ndarray, n: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        near = (token[1:] == token[:-1]) & (100 * n[:-1] >= t * n[1:])
        return c[:-1][near], c[1:][near]

    def span(token: np.ndarray, n: np.ndarray, c: np.ndarray, bits: _Bitmaps) -> tuple[np.ndarray, np.ndarray]:
        label, at, step = np.arange(len(token)), np.arange(len(token)), 1
        ends: list[tuple[np.ndarray, np.ndarray]] = []
        while True:
            at = at[at + step < len(token)]
            at = at[(token[at + step] == token[at]) & (100 * n[at] >= t * n[at + step])]
            if not len(at):
                break
            near = at[bits.close(n, at, at + step, t)]
            ends.append((near, near + step))
            step += 1
        if not ends:
            return c[:0], c[:0]
        i, j = (np.concatenate(x) for x in zip(*ends, strict=True))
        while True:  # smallest place of each component
            before = label.copy()
            low = np.minimum(label[i], label[j])
            np.minimum.at(label, i, low)
            np.minimum.at(label, j, low)
            label = label[label]
            if (label == before).all():
                break
        moved = np.flatnonzero(label != np.arange(len(label)))
        return c[label[moved]], c[moved]

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, long_token = None, None

        def give(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
            pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
            return pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["a", "b"])

        def columns(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
            return tuple(batch.column(x).to_numpy(zero_copy_only=False) for x in ("token", "n", "c1"))

        def whole(batch: pa.RecordBatch) -> pa.RecordBatch:
            return give(*span(*columns(batch), _Bitmaps(batch.column("bits").to_pylist())))

        for batch in batches:
            if held is not None:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            token, n, c = columns(batch)
            if not len(token):
                continue
            first = int(np.searchsorted(token, token[-1]))  # rows of the token that may go on
            begin = int(np.searchsorted(token, long_token, "right")) if long_token is not None else 0
            if begin:
                yield give(*chain(token[:begin], n[:begin], c[:begin]))
            if first > begin:
                yield whole(batch.slice(begin, first - begin))
            held, long_token = batch.slice(max(first, begin)), None
            if begin == len(token) or held.num_rows > LONG_LIST:
                tail = slice(max(first, begin) if begin < len(token) else len(token), None)
                yield give(*chain(token[tail], n[tail], c[tail]))
                held, long_token = batch.slice(len(token) - 1), token[-1]
        if held is not None and long_token is None and held.num_rows:
            yield whole(held)
    return links


class _Cell:
    """Exact join of the sets of one cell, taken by ascending size."""

    KEPT = 8  # answered sets that stay at hand

    def __init__(self, sets: list[np.ndarray], t: int):
        self.t, self.sizes = t, np.array([len(s) for s in sets])
        owner = np.repeat(np.arange(len(sets), dtype=np.int32), self.sizes)
        values, local, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        local = local.astype(np.int32)
        ends = np.cumsum(self.sizes)
        self.tokens = [local[e - n:e] for e, n in zip(ends, self.sizes, strict=True)]
        self.lists, self.list_at = owner[np.argsort(local, kind="stable")], np.concatenate([[0], np.cumsum(df)])
        self.df = df  # rare shingles first in the cell's own order
        self.mark = np.zeros(len(values), bool)
        self.prefix: dict[int, list[tuple[int, int]]] = {}
        self.answered: list[tuple[int, int, np.ndarray]] = []

    def _shared(self, y: int) -> int:
        return int(self.mark[self.tokens[y]].sum())

    def _holders(self, token: int, low: int, high: int) -> np.ndarray:
        part = self.lists[self.list_at[token]:self.list_at[token + 1]]  # by id, so by size
        return part[np.searchsorted(part, low):np.searchsorted(part, high)]

    def _derive(self, x: int, low: int) -> np.ndarray | None:
        """Intersections of x with low..x-1, from those of a set that x hardly differs from."""
        n, mine = int(self.sizes[x]), self.tokens[x]
        for y, y_low, known in reversed(self.answered):
            shared = self._shared(y)
            if y < low or 5 * (n + len(self.tokens[y]) - 2 * shared) > n:
                continue
            out = np.zeros(x - low, np.int64)
            out[:y - low] = known[low - y_low:]  # low >= y_low: sizes ascend
            for token in np.setdiff1d(mine, self.tokens[y], assume_unique=True).tolist():
                out[self._holders(token, low, y) - low] += 1
            for token in np.setdiff1d(self.tokens[y], mine, assume_unique=True).tolist():
                out[self._holders(token, low, y) - low] -= 1
            out[y - low] = shared
            for z in range(y + 1, x):
                out[z - low] = self._shared(z)
            return out
        return None

    def _probe(self, x: int, low: int, need: np.ndarray, head: list[int]) -> np.ndarray:
        """Intersections of x with the sets that its prefix lists leave; 0 for the others."""
        n, found = int(self.sizes[x]), set()
        for i, token in enumerate(head):
            for y, j in reversed(self.prefix.get(token, ())):
                if y < low:
                    break  # the rest of the list is too small
                if min(n - i, int(self.sizes[y]) - j) >= need[y - low]:
                    found.add(y)
        out = np.zeros(x - low, np.int64)
        for y in found:
            out[y - low] = self._shared(y)
        return out

    def links(self) -> Iterator[tuple[int, np.ndarray]]:
        """(x, the sets before x that link with it)."""
        for x, n in enumerate(self.sizes.tolist()):
            mine = self.tokens[x]
            low = int(np.searchsorted(100 * self.sizes, self.t * n))
            need = -(-self.t * (n + self.sizes[low:x]) // (100 + self.t))
            self.mark[mine] = True
            head = mine[np.argsort(self.df[mine], kind="stable")[:prefix_length(n, self.t)]]
            head = sorted(head.tolist(), key=lambda token: (self.df[token], token))
            shared = self._derive(x, low)
            derived = shared is not None
            if not derived:
                shared = self._probe(x, low, need, head)
            linked = low + np.flatnonzero(shared >= need)
            if len(linked) and not derived:  # answer in full, to serve the similar sets that follow
                shared = np.array([self._shared(z) for z in range(low, x)], np.int64)
            if len(linked):
                self.answered = [*self.answered[1 - self.KEPT:], (x, low, shared)]
            for i, token in enumerate(head):
                self.prefix.setdefault(token, []).append((x, i))
            self.mark[mine] = False
            yield x, linked


def _join_cell(rows: list[tuple], sets: list[np.ndarray], t: int) -> list[tuple[int, int, int]]:
    """(doc_id, component, links) of one task's share of a cell. rows: (doc_id,
    copies, size class, block, task's size class, its two blocks); a pair counts in one task only."""
    order = sorted(range(len(sets)), key=lambda i: (len(sets[i]), rows[i][0]))
    rows, sets = [rows[i] for i in order], [sets[i] for i in order]
    parent, links = list(range(len(sets))), [0] * len(sets)

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    copies, size_class, block = (np.array([r[i] for r in rows]) for i in (1, 2, 3))
    own_class, first, second = rows[0][4:7]
    for x, linked in _Cell(sets, t).links():
        linked = linked[np.minimum(size_class[linked], size_class[x]) == own_class]
        if first != second:
            linked = linked[block[linked] != block[x]]
        for y in linked.tolist():
            links[x] += int(copies[y])
            links[y] += int(copies[x])
            parent[root(y)] = root(x)
    least: dict[int, int] = {}
    for i, r in enumerate(rows):
        k = root(i)
        least[k] = min(least.get(k, r[0]), r[0])
    return [(r[0], least[root(i)], links[i]) for i, r in enumerate(rows)]


def _cells(k: int, t: int):
    """Rows sorted by part; each part is joined on its own."""
    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, rows, sets = None, [], []

        def flush() -> pa.RecordBatch:
            done = _join_cell(rows, sets, t)
            return pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], pa.int64()) for i in range(3)],
                                              ["doc_id", "component", "links"])

        for batch in slices(batches, "text", SLICE_BYTES):
            columns = [batch.column(c).to_pylist() for c in ("part", "doc_id", "copies", "size_class", "block", "own", "i", "j")]
            for one, own in zip(zip(*columns, strict=True), shingle_sets(batch.column("text"), k), strict=True):
                if one[0] != part and rows:
                    yield flush()
                    rows, sets = [], []
                part = one[0]
                if len(own):
                    rows.append(one[1:])
                    sets.append(own)
        if rows:
            yield flush()
    return cells


def jaccard_join(docs: DataFrame, k: int = 3, threshold: int = 90, cell_shingles: int = 1_500_000) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable over links,
    itself included) and n_links, one row per row of docs."""
    ship_package(docs.sparkSession)
    texts = docs.select("doc_id", "text")
    hot = (texts.mapInArrow(releasing(_common(k)), "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
           .orderBy(F.desc("n"), "shingle").limit(HOT_KEPT).select("shingle").toArrow()["shingle"].to_numpy())
    each = cut(texts.mapInArrow(releasing(_prefixes(k, threshold, np.ascontiguousarray(hot, np.int64).view(np.uint64))),
                                "doc_id long, n long, c1 long, c2 long, tokens array<long>, bits binary"))
    classes = cut(each.where("n > 0").groupBy("c1", "c2").agg(
        F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.count(F.lit(1)).alias("copies"),
        F.first("tokens").alias("tokens"), F.first("bits").alias("bits")))
    lists = classes.select("c1", "n", F.explode("tokens").alias("token"))
    shared = (lists.repartition("token").sortWithinPartitions("token")
              .mapInArrow(_several, lists.schema).join(classes.select("c1", "bits"), "c1"))
    near = (shared.repartition("token").sortWithinPartitions("token", "n", "c1")
            .mapInArrow(releasing(_list_links(threshold)), "a long, b long"))
    cells = components(near)
    members = (classes.select("c1", "rep", "n", "copies").where("rep is not null")
               .join(cells.select(F.col("id").alias("c1"), F.col("component").alias("cell")), "c1"))
    # A cell too large for a task is cut by size: linked sets are in one class of
    # sizes or in neighbouring ones, and a task gets two classes; what is still too
    # large is cut into blocks, and every two blocks meet in a task.
    weight = members.groupBy("cell").agg(F.sum("n").alias("w"), F.count(F.lit(1)).alias("m")).where("m > 1")
    size_class = F.floor(F.log("n") / F.log(F.lit(100.1 / threshold))).cast("int")
    members = (members.join(weight, "cell")
               .withColumn("size_class", F.when(F.col("w") <= cell_shingles, 0).otherwise(size_class))
               .withColumn("own", F.explode(F.when(F.col("w") <= cell_shingles, F.array(F.lit(0)))
                                            .otherwise(F.array(F.col("size_class") - 1, "size_class")))).drop("w", "m"))
    weight = members.groupBy("cell", "own").agg(F.sum("n").alias("w"), F.count(F.lit(1)).alias("m")).where("m > 1")
    blocks = F.ceil(F.col("w") / (cell_shingles / 2)).cast("int")
    blocks = F.when(F.col("w") <= cell_shingles, 1).otherwise(blocks)
    members = (members.join(weight.select("cell", "own", blocks.alias("blocks")), ["cell", "own"])
               .withColumn("block", F.expr("cast(pmod(xxhash64(c1, 17), blocks) as int)"))
               .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
               .select(F.col("rep").alias("doc_id"), "cell", "copies", "size_class", "block", "own",
                       F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")))
    part = F.concat_ws("/", "cell", "own", "i", "j").alias("part")
    found = cut(texts.join(members, "doc_id").select(part, "doc_id", "copies", "size_class", "block", "own", "i", "j", "text")
                .repartition("part").sortWithinPartitions("part")
                .mapInArrow(releasing(_cells(k, threshold)), "doc_id long, component long, links long"))
    joined = components(found.select(F.col("doc_id").alias("a"), F.col("component").alias("b")))
    links = found.groupBy("doc_id").agg(F.sum("links").alias("links")).withColumnRenamed("doc_id", "rep")
    known = (classes.select("c1", "c2", "rep", "copies")
             .join(joined.select(F.col("id").alias("rep"), "component"), "rep", "left")
             .join(links, "rep", "left")
             .select("c1", "c2", F.coalesce("component", "rep").alias("component_id"),
                     (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")))
    return (each.select("doc_id", "n", "c1", "c2").join(known, ["c1", "c2"], "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
                    F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")))
