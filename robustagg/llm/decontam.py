"""Benchmark decontamination with an FM-index per training shard.

Documents are cut into shards (slices of a partition, bounded bytes). A shard's
words become symbols - the benchmark's words, everything else (and every
document end) an own separator - and get a suffix array by prefix doubling, its
Burrows-Wheeler transform in a wavelet matrix, and sampled suffix positions. All
windows of the benchmark are searched backwards at once through the wavelet
ranks; occurrences are located by walking to the nearest sample, and the words
they cover are merged into removal spans.

The benchmark is the query set: it goes to the tasks in blocks of at most
``block_chars`` characters of whole items (a larger item is a block), one job per
block, and a document's findings are merged over the blocks.

Defined cases: null or empty text (or one without words) has no words and is
clean; an item without words has no window; items of fewer than ``n`` words are
one window; repeated documents and items are judged alike; a null item id is the
empty string; empty tables give no rows or clean documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, ship_package
from .words import ALNUM, Words, find_words, releasing, slices, spans_of

SHARD_BYTES = 3 << 20
SAMPLE = 8


class Phrases:
    """The distinct windows of a block of items, as symbols of the block's words."""

    def __init__(self, items: list[tuple[str, str]], n: int):
        w = find_words(pa.array([t for _, t in items], pa.string()), ALNUM)
        self.vocabulary = np.unique(w.hashes)
        symbols = np.searchsorted(self.vocabulary, w.hashes) + 1
        seen: dict[tuple, set[str]] = {}
        for k, (item, _) in enumerate(items):
            s = symbols[w.first[k]:w.first[k + 1]].tolist()
            for i in range(max(1, len(s) - n + 1) if s else 0):
                seen.setdefault(tuple(s[i:i + n]), set()).add(item)
        ordered = sorted(seen, key=len, reverse=True)
        self.lengths = np.array([len(p) for p in ordered], np.int64)
        width = int(self.lengths[0]) if ordered else 0
        self.symbols = np.zeros((len(ordered), width), np.int64)  # right-aligned
        for k, p in enumerate(ordered):
            self.symbols[k, width - len(p):] = p
        names = sorted({i for s in seen.values() for i in s})
        number = {i: k for k, i in enumerate(names)}
        self.names = np.array(names, object)
        owners = [sorted(number[i] for i in seen[p]) for p in ordered]
        self.owners = np.array([i for o in owners for i in o], np.int64)
        self.owner_at = np.concatenate([[0], np.cumsum([len(o) for o in owners])]).astype(np.int64)


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Of symbols >= 0 that end in 0; each 0 is smaller than all symbols and than every later 0."""
    n, zero = len(text), text == 0
    n_zero = int(zero.sum())
    key = np.where(zero, np.cumsum(zero) - 1, n_zero - 1 + text).astype(np.int32)
    sa = np.argsort(key)
    ordered = key[sa]
    fresh = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    start = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[sa] = start
    tied = ~(fresh & np.concatenate([fresh[1:], [True]]))
    active, k = sa[tied], 1
    while len(active):
        group = rank[active]
        both = group * n + rank[active + k]
        o = np.argsort(both)
        active, group, both = active[o], group[o], both[o]
        at = np.arange(len(active))
        new_group = np.concatenate([[True], group[1:] != group[:-1]])
        fresh = np.concatenate([[True], both[1:] != both[:-1]])
        head = np.maximum.accumulate(np.where(new_group, at, 0))
        sub = np.maximum.accumulate(np.where(fresh, at, 0))
        sa[group + at - head] = active
        rank[active] = group + sub - head
        tied = ~(fresh & np.concatenate([fresh[1:], [True]]))
        active, k = active[tied], k * 2
    return sa


class FMIndex:
    def __init__(self, text: np.ndarray, top: int):
        sa = suffix_array(text)
        self.last = text[sa - 1]  # the text ends in 0, so the first suffix is preceded by 0
        counts = np.bincount(text, minlength=top + 2)
        self.first = np.concatenate([[0], np.cumsum(counts)])
        # Sampled positions; also right after a separator, where the walk back has to end.
        self.marked = (sa % SAMPLE == 0) | (self.last == 0)
        self.sample_rank = np.cumsum(self.marked) - 1
        self.samples = sa[self.marked]
        self.bits = range(max(1, int(top).bit_length()) - 1, -1, -1)
        self.levels, row = [], self.last.astype(np.uint16 if top < 1 << 16 else np.uint32)
        for b in self.bits:
            zero = (row & row.dtype.type(1 << b)) == 0
            zeros = np.zeros(len(row) + 1, np.int32)
            np.cumsum(zero, dtype=np.int32, out=zeros[1:])
            self.levels.append((zeros, int(zeros[-1])))
            row = np.concatenate([row[zero], row[~zero]])
        self.origin = self._walk(np.arange(top + 1), np.zeros(top + 1, np.int64))

    def _walk(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for b, (zeros, n_zero) in zip(self.bits, self.levels, strict=True):
            low = zeros[at]
            at = np.where((symbol >> b) & 1, n_zero + at - low, low)
        return at

    def step(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """First row of the symbol's suffixes plus its occurrences above row ``at``."""
        return self.first[symbol] + self._walk(symbol, at) - self.origin[symbol]

    def search(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(phrase, low, high) of the right-aligned phrases that occur."""
        width = symbols.shape[1]
        who = np.arange(len(symbols))
        low, high = self.first[symbols[:, -1]], self.first[symbols[:, -1] + 1]
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for back in range(1, width + 1):
            alive = low < high
            who, low, high = who[alive], low[alive], high[alive]
            full = lengths[who] == back
            done.append((who[full], low[full], high[full]))
            who, low, high = who[~full], low[~full], high[~full]
            if not len(who):
                break
            c = symbols[who, width - 1 - back]
            low, high = self.step(c, low), self.step(c, high)
        return tuple(np.concatenate(x) for x in zip(*done, strict=True))

    def locate(self, rows: np.ndarray) -> np.ndarray:
        out, who, steps = np.empty(len(rows), np.int64), np.arange(len(rows)), 0
        while len(who):
            here = self.marked[rows]
            out[who[here]] = self.samples[self.sample_rank[rows[here]]] + steps
            who, rows = who[~here], rows[~here]
            rows = self.step(self.last[rows], rows)
            steps += 1
        return out


def _hits(w: Words, phrases: Phrases) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Flags of the hit words, and (document, item) pairs, sorted."""
    n_docs, none = len(w.first) - 1, np.zeros(0, np.int64)
    flags = np.zeros(len(w.hashes), bool)
    if not len(phrases.symbols) or not len(w.hashes):
        return flags, none, none
    at = np.minimum(np.searchsorted(phrases.vocabulary, w.hashes), len(phrases.vocabulary) - 1)
    symbol = np.where(phrases.vocabulary[at] == w.hashes, at + 1, 0)
    text = np.zeros(len(symbol) + n_docs, np.int64)
    text[np.arange(len(symbol)) + w.owner()] = symbol  # a separator after each document
    index = FMIndex(text, len(phrases.vocabulary))
    phrase, low, high = index.search(phrases.symbols, phrases.lengths)
    times = high - low
    if not times.sum():
        return flags, none, none
    begin = np.cumsum(times) - times
    rows = np.repeat(low - begin, times) + np.arange(times.sum())
    position, phrase = index.locate(rows), np.repeat(phrase, times)
    cover = np.zeros(len(text) + 1, np.int64)
    np.add.at(cover, position, 1)
    np.add.at(cover, position + phrases.lengths[phrase], -1)
    flags = np.cumsum(cover[:-1])[np.arange(len(symbol)) + w.owner()] > 0
    doc = np.searchsorted(w.first[:-1] + np.arange(n_docs), position, "right") - 1
    pair = np.unique(doc * len(phrases.symbols) + phrase)
    doc, phrase = pair // len(phrases.symbols), pair % len(phrases.symbols)
    n_owner = phrases.owner_at[phrase + 1] - phrases.owner_at[phrase]
    begin = np.cumsum(n_owner) - n_owner
    item = phrases.owners[np.repeat(phrases.owner_at[phrase] - begin, n_owner) + np.arange(n_owner.sum())]
    pair = np.unique(np.repeat(doc, n_owner) * len(phrases.names) + item)
    return flags, pair // len(phrases.names), pair % len(phrases.names)


def _runs(flags: np.ndarray, w: Words) -> pa.Array:
    """Runs of hit words of each document, as a list of (start, end) word numbers."""
    n_docs, base = len(w.first) - 1, w.first[:-1] + np.arange(len(w.first) - 1)
    padded = np.zeros(len(flags) + n_docs, bool)  # a free place between documents ends their runs
    padded[(np.arange(len(flags)) + w.owner())[flags]] = True
    start, end = spans_of(padded)
    doc = np.searchsorted(base, start, "right") - 1
    spans = pa.StructArray.from_arrays([pa.array(start - base[doc], pa.int64()), pa.array(end - base[doc], pa.int64())],
                                       ["start", "end"])
    offsets = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=n_docs))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), spans)


def _scan(phrases: Phrases, out: list[str]):
    """Adds this block's findings to the columns _words, _spans and _items; returns columns ``out``."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SHARD_BYTES):
            w = find_words(batch.column("text"), ALNUM)
            flags, doc, item = _hits(w, phrases)
            old_items = batch.column("_items").to_pylist()
            for d, spans in enumerate(batch.column("_spans").to_pylist()):
                for span in spans:
                    flags[w.first[d] + span["start"]:w.first[d] + span["end"]] = True
            for d, k in zip(doc.tolist(), item.tolist(), strict=True):
                old_items[d].append(phrases.names[k])
            own = {"_words": pa.array(w.counts, pa.int64()), "_spans": _runs(flags, w),
                   "_items": pa.array([sorted(set(x)) for x in old_items], pa.list_(pa.string()))}
            yield pa.RecordBatch.from_arrays([own[c] if c in own else batch.column(c) for c in out], out)
    return releasing(scan)


def benchmark_blocks(benchmark: DataFrame, n: int, block_chars: int) -> Iterator[tuple[Phrases, bool]]:
    """The benchmark's windows, block by block, and whether it is the last; each block is a bounded collect."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"),
                             F.coalesce("text", F.lit("")).alias("text"))
    blocks = max(1, -(-int(items.agg(F.sum(F.char_length("text") + 1)).first()[0] or 0) // block_chars))
    for b in range(blocks):
        yield Phrases([tuple(r) for r in items.where(
            F.expr(f"pmod(xxhash64(item_id, text), {blocks})") == b).distinct().collect()], n), b == blocks - 1


def find_leaks(docs: DataFrame, benchmark: DataFrame, n: int = 10, block_chars: int = 4 << 20,
               keep_text: bool = False) -> DataFrame:
    """docs (without the text unless ``keep_text``) plus _words (number of words), _spans (runs of
    hit words by start: start, end exclusive) and _items (ids of the items with
    occurring windows, sorted as strings). A column of docs with such a name is
    replaced."""
    ship_package(docs.sparkSession)
    found = docs.withColumns({"_words": F.lit(0).cast("long"),
                              "_spans": F.array().cast("array<struct<start:long,end:long>>"),
                              "_items": F.array().cast("array<string>")})
    for phrases, last in benchmark_blocks(benchmark, n, block_chars):
        out = [c for c in found.columns if c != "text" or keep_text or not last]
        found = found.mapInArrow(_scan(phrases, out), found.select(out).schema)
        if not last:  # findings so far are carried along; the next block gets its own job
            found = cut(found)
    return found


def remove_leaks(docs: DataFrame, benchmark: DataFrame, n: int = 10) -> DataFrame:
    """docs without the leaked passages: the text from the first to the last word
    of each removal span goes; a document with no other word goes whole. Other
    columns stay, whatever their names."""
    columns = docs.columns
    inner = ["text" if c == "text" else f"k{i}" for i, c in enumerate(columns)]
    named = docs.select(*(F.col(c).alias(k) for c, k in zip(columns, inner, strict=True)))

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SHARD_BYTES):
            w, spans = find_words(batch.column("text"), ALNUM), batch.column("_spans").to_pylist()
            texts, keep = batch.column("text").to_pylist(), np.ones(batch.num_rows, bool)
            for d, cuts in enumerate(spans):
                if not cuts:
                    continue
                keep[d] = sum(s["end"] - s["start"] for s in cuts) < w.counts[d]
                at, parts, begin = w.first[d], [], w.texts[d]
                for s in cuts:
                    parts.append(w.data[begin:w.starts[at + s["start"]]].tobytes())
                    begin = w.ends[at + s["end"] - 1]
                parts.append(w.data[begin:w.texts[d + 1]].tobytes())
                texts[d] = b"".join(parts).decode("utf-8")
            k = batch.schema.get_field_index("text")
            out = batch.set_column(k, "text", pa.array(texts, pa.string())).filter(pa.array(keep))
            yield out.select(inner)

    clean = releasing(clean)
    out = find_leaks(named, benchmark, n, keep_text=True).mapInArrow(clean, named.schema)
    return out.select(*(F.col(k).alias(c) for c, k in zip(columns, inner, strict=True)))
