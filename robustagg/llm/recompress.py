"""Substring dedup by recompression.

The words of a document are parsed in rounds. A pair round splits all names by
a bit of a hash into left and right and replaces each left-right pair by a
name derived from both; a run round replaces each run of one name by a name of
(name, length). Names depend on content only, so they are the same in every task
without an exchange, and equal substrings get equal symbols except near their ends.

Two pair rounds make symbols of at most four words, and whether one starts at
word p depends on words p-2 to p+1 alone. So every window of 13 words has symbol
starts among its words 2 to 9, known from the window itself; the start with the
smallest hash of its six words p-2 to p+3 names the window. Equal windows have
equal names, and a name that stays in one document rules its windows out.

Later rounds (runs and pairs) give symbols of a dozen words and more; one that
occurs in a document with a smaller id proves a long repeat at once, as does the
symbol of a whole document. Windows inside such repeats need no further look. Of
the windows left whose name two documents share, the hash of all words is
compared over the corpus; the first document with a window keeps it.

Exchanges carry (name, doc_id) pairs only. A task first settles its own slice:
of the documents of a slice that share a name, one asks for all, so a hot name
sends one row per slice. The text is exchanged once, by doc_id, for both later passes.
Names and hashes have 64 bits.

Defined cases: null or empty texts have no words and keep the empty string;
documents with fewer words than a window lose nothing; rows with the same doc_id
do not dedupe each other; a null doc_id is never compared and loses nothing; an
empty table gives no rows; other columns stay (names with a leading underscore
are reserved; ``n_words``, ``n_removed`` and
``kept`` are replaced).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship_package
from .words import PLAIN, Words, find_words, flat_list, mix, pairs_in, range_hashes, slices, windows

WINDOW = 13
SLICE_BYTES = 6 << 20
ROUNDS = 12
_A, _B = np.uint64(0xA24BAED4963EE407), np.uint64(0x9FB21C651E98DF25)
_ODD = np.uint64(1)


def _pair_round(names: np.ndarray, starts: np.ndarray, doc: np.ndarray, number: int) -> tuple:
    left = (mix(names + np.uint64(number)) & _ODD).astype(bool)
    joined = np.zeros(len(names), bool)
    joined[:-1] = left[:-1] & ~left[1:] & (doc[:-1] == doc[1:])
    at = np.flatnonzero(joined)
    names = names.copy()
    names[at] = mix(names[at] * _A + names[at + 1] * _B + np.uint64(number))
    keep = np.ones(len(names), bool)
    keep[at + 1] = False
    return names[keep], starts[keep], doc[keep]


def _run_round(names: np.ndarray, starts: np.ndarray, doc: np.ndarray) -> tuple:
    first = np.ones(len(names), bool)
    first[1:] = (names[1:] != names[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(first)
    times = np.diff(np.append(at, len(names))).astype(np.uint64)
    out = names[at]
    out = np.where(times > 1, mix(out * _B + times), out)
    return out, starts[at], doc[at]


class Parse:
    """Window names and long symbols of a slice of documents."""

    def __init__(self, w: Words):
        n, owner = len(w.hashes), w.owner()
        self.owner = owner
        state = (w.hashes, np.arange(n), owner)
        for number in (1, 2):
            state = _pair_round(*state, number)
        # Smallest name among the symbol starts at words 2..9 of each window.
        value = np.full(n, np.uint64(0xFFFFFFFFFFFFFFFF))
        context = windows(w.hashes, 6)
        starts = state[1]
        starts = starts[(starts >= 2) & (starts - 2 < len(context))]
        value[starts] = context[starts - 2]
        least = np.minimum(value[:-1], value[1:]) if n else value
        for step in (2, 4):
            least = np.minimum(least[:-step], least[step:]) if len(least) > step else least[:0]
        whole = max(0, n - WINDOW + 1)
        self.start = np.flatnonzero(owner[:whole] == owner[WINDOW - 1:]) if whole else np.zeros(0, np.int64)
        self.window_owner = owner[self.start]
        self.name = least[self.start + 2] & ~_ODD  # even: names of windows; odd: long symbols
        # Long symbols.
        for number in range(3, ROUNDS + 1):
            state = _pair_round(*_run_round(*state), number)
        names, starts, doc = state
        ends = np.append(starts[1:], n) if len(starts) else starts
        long = ends - starts >= WINDOW
        some = np.flatnonzero(w.counts >= WINDOW)
        all_of = range_hashes(w.hashes, w.first[some], w.first[some + 1])
        self.symbol = np.concatenate([names[long], mix(all_of + _A)]) | _ODD
        self.symbol_owner = np.concatenate([doc[long], some])
        self.symbol_start = np.concatenate([starts[long], w.first[some]])
        self.symbol_end = np.concatenate([ends[long], w.first[some + 1]])


def _settle(keys: np.ndarray, owners: np.ndarray, ids: np.ndarray, later: np.ndarray | bool) -> list[np.ndarray]:
    """Distinct (key, id) pairs of a slice: those to ask about (the smallest id of
    each key) and those already known to share their key (``later``: with a smaller id)."""
    order = np.lexsort((ids[owners], keys))
    keys, docs = keys[order], ids[owners][order]
    later = np.broadcast_to(later, keys.shape)[order] if isinstance(later, np.ndarray) else np.full(len(keys), later)
    new_key = np.concatenate([[True], keys[1:] != keys[:-1]])[:len(keys)]
    fresh = new_key | np.concatenate([[True], docs[1:] != docs[:-1]])[:len(keys)]
    keys, docs, new_key, later = keys[fresh], docs[fresh], new_key[fresh], later[fresh]
    group = np.cumsum(new_key) - 1
    several = (np.bincount(group) > 1)[group] if len(group) else new_key
    known = several & ~(later & new_key)
    return [keys[new_key], docs[new_key], keys[known], docs[known]]


PAIRS = "key long, doc_id long, known boolean"


def _pair_batch(settled: list[np.ndarray]) -> pa.RecordBatch:
    ask_key, ask_doc, known_key, known_doc = settled
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate([ask_key, known_key]).view(np.int64)),
         pa.array(np.concatenate([ask_doc, known_doc]), pa.int64()),
         pa.array(np.repeat([False, True], [len(ask_key), len(known_key)]))], ["key", "doc_id", "known"])


def _ids(batch: pa.RecordBatch) -> tuple[pa.RecordBatch, np.ndarray]:
    batch = batch.filter(batch.column("doc_id").is_valid())
    return batch, batch.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Window names and long symbols of each document."""
    for batch in slices(batches, "text", SLICE_BYTES):
        batch, ids = _ids(batch)
        p = Parse(find_words(batch.column("text"), PLAIN))
        keys = np.concatenate([p.name, p.symbol])
        if len(keys):
            yield _pair_batch(_settle(keys, np.concatenate([p.window_owner, p.symbol_owner]), ids,
                                      (keys & _ODD).astype(bool)))


def _proven(p: Parse, keys: np.ndarray, rows: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Spans of the long symbols that are known to occur in an earlier document."""
    hit = pairs_in(p.symbol, p.symbol_owner, keys, rows, n_docs)
    return p.symbol_start[hit], p.symbol_end[hit]


def _inside(n: int, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Flags of the places that the spans cover."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, begin, 1)
    np.add.at(step, end, -1)
    return np.cumsum(step[:-1]) > 0


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of the windows whose name is shared and that no long symbol has settled."""
    for batch in slices(batches, "text", SLICE_BYTES):
        batch, ids = _ids(batch)
        w = find_words(batch.column("text"), PLAIN)
        p = Parse(w)
        keys, rows = flat_list(batch.column("_names"))
        keys = keys.astype(np.int64).view(np.uint64)
        begin, end = _proven(p, keys, rows, batch.num_rows)
        settled = _inside(len(w.hashes), begin, np.maximum(begin, end - WINDOW + 1))
        open_ = pairs_in(p.name, p.window_owner, keys, rows, batch.num_rows) & ~settled[p.start]
        if open_.any():
            yield _pair_batch(_settle(windows(w.hashes, WINDOW)[p.start[open_]] | _ODD, p.window_owner[open_], ids, True))


def _remove(out: list[str]):
    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE_BYTES):
            w = find_words(batch.column("text"), PLAIN)
            p = Parse(w)
            keys, rows = flat_list(batch.column("_names"))
            begin, end = _proven(p, keys.astype(np.int64).view(np.uint64), rows, batch.num_rows)
            keys, rows = flat_list(batch.column("_repeats"))
            hit = pairs_in(windows(w.hashes, WINDOW)[p.start] | _ODD, p.window_owner,
                           keys.astype(np.int64).view(np.uint64), rows, batch.num_rows)
            gone = _inside(len(w.hashes), np.concatenate([begin, p.start[hit]]),
                           np.concatenate([end, p.start[hit] + WINDOW]))
            total = np.concatenate([[0], np.cumsum(gone)])
            n_removed = total[w.first[1:]] - total[w.first[:-1]]
            kept = []
            for d, text in enumerate(batch.column("text").to_pylist()):
                words = (text or "").encode().split()
                if n_removed[d]:
                    words = compress(words, (~gone[w.first[d]:w.first[d + 1]]).tolist())
                kept.append(b" ".join(words).decode())
            own = {"n_words": pa.array(w.counts, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()),
                   "kept": pa.array(kept, pa.string())}
            yield pa.RecordBatch.from_arrays([own[c] if c in own else batch.column(c) for c in out], out)
    return remove


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of pairs sorted by key and doc_id: those whose key has several documents
    (even keys) or a smaller one (odd keys). Between batches only the last key,
    its first document and whether that was given are kept."""
    last = None
    for batch in batches:
        keys, docs = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "doc_id"))
        if not len(keys):
            continue
        if last is not None:  # its first document stands for the key once more
            keys, docs = np.append(last[0], keys), np.append(last[1], docs)
        fresh = np.concatenate([[True], keys[1:] != keys[:-1]])
        head = np.flatnonzero(fresh)
        group = np.cumsum(fresh) - 1
        first, final = docs[head], docs[np.append(head[1:], len(keys)) - 1]
        several = (final > first)[group]
        give = several & ((docs > first[group]) | ((keys & 1) == 0))
        if last is not None and last[2]:
            give[0] = False
        given = bool(several[-1] and (keys[-1] & 1) == 0)
        last = (keys[-1], first[-1], given)
        give &= np.concatenate([[True], (keys[1:] != keys[:-1]) | (docs[1:] != docs[:-1])])
        yield pa.RecordBatch.from_arrays([pa.array(docs[give]), pa.array(keys[give])], ["doc_id", "key"])


def _answers(pairs: DataFrame, name: str) -> DataFrame:
    """(doc_id, array of keys) of the pairs that share their key as asked."""
    asked = pairs.where("not known").select("key", "doc_id").repartition("key").sortWithinPartitions("key", "doc_id")
    return (asked.mapInArrow(_shared, "doc_id long, key long")
            .unionByName(pairs.where("known").select("doc_id", "key"))
            .groupBy("doc_id").agg(F.collect_set("key").alias(name)))


def substring_dedup(docs: DataFrame) -> DataFrame:
    """docs plus n_words, n_removed and ``kept``: the words that no repeated
    window of 13 covers, joined by one space."""
    ship_package(docs.sparkSession)
    columns = [c for c in docs.columns if c not in ("n_words", "n_removed", "kept")]
    names = _answers(docs.select("doc_id", "text").mapInArrow(_index, PAIRS), "_names")
    base = docs.select(*columns)
    with_names = base.join(names, "doc_id", "left")
    # No filter here: the exchange of the texts is then the same as below, and made once.
    repeats = _answers(with_names.select("doc_id", "text", "_names").mapInArrow(_compare, PAIRS), "_repeats")
    out = [*columns, "n_words", "n_removed", "kept"]
    schema = base.withColumns({"n_words": F.lit(0).cast("long"), "n_removed": F.lit(0).cast("long"),
                               "kept": F.lit("")}).schema
    return with_names.join(repeats, "doc_id", "left").mapInArrow(_remove(out), schema)
