"""Quality rules with tokeniser fertility.

Base rules come from words and lines. The method measures how public
vocabularies take a text: characters per token and token entropy under a
byte-level vocabulary, and the share of byte-fallback tokens under one that
falls back to bytes.

Entropy depends on length, so it is taken as ``entropy_gap``: the bits that a
text's tokens stay below the most they could have (the logarithm of their
number), over the usual gap at that length (a curve through the upper quartiles
of the corpus's length classes, which noise among them moves little, as it lies low). Noise whose tokens hardly ever come back has a
small gap, at any length; a text that says one thing over and over a large one.

Each language (or script) has its own rejection band per measure, from the
corpus itself: the quartiles over all documents that pass the base rules,
widened by ``width`` times their distance, or by the measure's least reach if
that is more. A text outside the quartiles in several measures is rejected when the squares
of its shares of the reaches exceed one together. A language's quartiles are blended with the whole corpus's, which
weigh as ``least`` documents do (the distance of a few documents counts little),
so every row that passes the base rules is judged, at every size.

Quartiles are read from counts of fixed fine bins, which add up to
the same in any order. One pass computes all measures; bands are one row per
language and go to the rows (a broadcast of at most ``BROADCAST_ROWS`` counted
rows, a salted join of more): no row moves to its language.

Defined cases: null text has no words and fails the base rules, as does an
empty one; a null language is the language ""; equal rows are judged alike;
texts of any length are read whole; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from robustagg.sources.store import free_name

from .common import cut, ship_package
from .pieces import Pieces, byte_tokens, code_points, flat_ids, forget
from .words import PLAIN, find_words, mix, releasing, slices, windows

SLICE_BYTES = 1 << 18
SPACES = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MEASURES = ("chars_per_token", "byte_share", "token_entropy")
#: what is judged: bin width, bins, least reach below and above the quartiles, reach as a share of the quartile
BANDS = {"chars_per_token": (0.01, 5000, 0.16, 0.25, True), "byte_share": (0.001, 1001, 0.03, 0.03, False),
         "entropy_gap": (0.005, 4000, 0.28, 1.0, False)}
CLASSES = 2  # length classes per doubling of the tokens
GAP_BIN, GAP_BINS, LEAST_GAP = 0.01, 5000, 0.25
BROADCAST_ROWS, SALTS = 10_000, 16

_FALLBACK: dict[str, Pieces] = {}


def _fallback_pieces(path: str) -> Pieces:
    """Per word two numbers: tokens, and byte-fallback tokens among them."""
    if path not in _FALLBACK:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        byte = np.array([model.is_byte(i) for i in range(model.get_piece_size())], np.int64)

        def measure(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
            ids, counts = flat_ids(model.encode(words, num_threads=1))
            by_byte = per_text(byte[ids], np.concatenate([[0], np.cumsum(counts)]))
            return np.stack([counts, by_byte], axis=1).reshape(-1), np.full(len(words), 2)
        _FALLBACK[path] = Pieces(measure)
    return _FALLBACK[path]


def per_text(flags: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Sums of flags (or numbers) between the offsets."""
    total = np.concatenate([[0], np.cumsum(flags)])
    return total[texts[1:]] - total[texts[:-1]]


def _repeat_words(hashes: np.ndarray, first: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Words in 3-word windows that the text has twice or more."""
    covered = np.zeros(len(hashes) + 1, np.int64)
    grams = windows(hashes, 3)
    at = np.flatnonzero(owner[:len(grams)] == owner[len(owner) - len(grams):])
    keys = grams[at] + mix(owner[at].astype(np.uint64))
    order = np.argsort(keys)
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    np.add.at(covered, at[twice], 1)
    np.add.at(covered, at[twice] + 3, -1)
    return per_text(np.cumsum(covered[:-1]) > 0, first)


def _entropy(ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Bits per token of each text's token distribution."""
    owner = np.repeat(np.arange(len(counts)), counts)
    pair, n = np.unique(owner * (1 << 20) + ids, return_counts=True)
    owner = pair >> 20
    share = n / counts[owner]
    return np.bincount(owner, -share * np.log2(share), len(counts))


def _measure(byte_path: str, fallback_path: str, keep: list[str]):
    spaces, symbols = np.array([ord(c) for c in SPACES]), np.array([ord(c) for c in SYMBOLS])
    ascii_space, ascii_symbol = np.zeros(128, bool), np.zeros(128, bool)
    ascii_space[spaces], ascii_symbol[symbols] = True, True

    def measure(batch: pa.RecordBatch) -> pa.RecordBatch:
        fallback, column = _fallback_pieces(fallback_path), batch.column("text")
        w, (joined, points, texts) = find_words(column, PLAIN), code_points(column)
        low = np.minimum(points, 127)
        space = ascii_space[low] & (points < 128)
        # Words as code points, for the vocabulary that works word by word.
        edge = np.zeros(len(points) + 1, bool)
        edge[texts] = True
        begin = ~space & (edge[:-1] | np.concatenate([[True], space[:-1]])[:len(points)])
        stop = ~space & (edge[1:] | np.concatenate([space[1:], [True]])[:len(points)])
        slots = fallback.lookup(joined, points, np.flatnonzero(begin), np.flatnonzero(stop) + 1)
        tokens, by_byte = (fallback.ids[fallback.at[slots] + i].astype(np.int64) for i in (0, 1))
        n_tokens, n_bytes = per_text(tokens, w.first), per_text(by_byte, w.first)
        ids, n_ids = byte_tokens(byte_path).ids(column)
        dup_lines = []
        for text in column.to_pylist():
            lines = [x for x in (text or "").split("\n") if x.strip(SPACES)]
            dup_lines.append(len(lines) - len(set(lines)))
        return pa.RecordBatch.from_pydict({
            **{c: batch.column(c) for c in keep},
            "n_words": pa.array(w.counts, pa.int64()),
            "word_chars": pa.array(per_text(~space, texts), pa.int64()),
            "n_symbols": pa.array(per_text(ascii_symbol[low] & (points < 128), texts), pa.int64()),
            "n_dup_lines": pa.array(dup_lines, pa.int64()),
            "n_repeat_words": pa.array(_repeat_words(w.hashes, w.first, w.owner()), pa.int64()),
            "chars_per_token": pa.array(np.diff(texts) / np.maximum(1, n_ids), pa.float64()),
            "byte_share": pa.array(n_bytes / np.maximum(1, n_tokens), pa.float64()),
            "token_entropy": pa.array(_entropy(ids.astype(np.int64), n_ids), pa.float64())})

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:  # a slice's arrays go before the next slice's come
            yield from map(measure, slices(batches, "text", SLICE_BYTES))
        finally:  # models and tables of known words go: the worker goes on to other stages
            _FALLBACK.pop(fallback_path, None)
            forget(byte_path)
    return releasing(whole)


def measure_quality(docs: DataFrame, byte_path: str, fallback_path: str, keep: list[str]) -> DataFrame:
    """Columns ``keep`` plus the counts and the tokeniser measures of each row's text."""
    ship_package(docs.sparkSession)
    kept = docs.select(*keep)
    schema = kept.withColumns({**{c: F.lit(0).cast("long") for c in COUNTS},
                               **{c: F.lit(0.0) for c in MEASURES}}).schema
    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(_measure(byte_path, fallback_path, keep), schema)


def _at_shares(counts: DataFrame, keys: list[str], shares: dict[str, float]) -> DataFrame:
    """``keys``, n and the first bin up to which each share of the n of ``counts`` (keys, bin, n) lies."""
    so_far = Window.partitionBy(*keys).orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    rows = counts.withColumn("upto", F.sum("n").over(so_far)).withColumn("total", F.sum("n").over(Window.partitionBy(*keys)))
    return rows.groupBy(*keys).agg(F.max("total").alias("n"), *(
        F.min(F.when(F.col("upto") >= share * F.col("total"), F.col("bin"))).alias(name) for name, share in shares.items()))


def expected_gap(passed: DataFrame) -> list[float]:
    """Coefficients (highest power first) of the gap by doublings: a parabola (of texts
    that are nearly all as long as each other, a line or a constant) through
    the upper quartiles of the length classes, which weigh as many documents as they have."""
    kind = F.floor(F.col("_doublings") * CLASSES)
    bins = F.least(F.floor(F.col("_gap") / GAP_BIN), F.lit(GAP_BINS))
    counts = passed.groupBy(kind.alias("class"), bins.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    # At most some hundred rows: one per length class.
    found = sorted(_at_shares(counts, ["class"], {"upper": 0.75}).collect())
    if not found:
        return [1.0]
    at, n, upper = (np.array([r[c] for r in found], float) for c in ("class", "n", "upper"))
    spread = int(n.sum() ** 2 / (n ** 2).sum())  # as many classes of equal size
    return np.polyfit((at + 0.5) / CLASSES, (upper + 0.5) * GAP_BIN, min(2, spread - 1), w=np.sqrt(n)).tolist()


def _bands(passed: DataFrame, width: float, least: int) -> DataFrame:
    """_by and, per measure, the quartiles and the reach below and above them."""
    value = F.array(*(F.struct(F.lit(m).alias("measure"), F.least(F.floor(F.col(m) / step), F.lit(bins)).alias("bin"))
                      for m, (step, bins, *_) in BANDS.items()))
    counts = cut(passed.select("_by", F.inline(value)).groupBy("_by", "measure", "bin").agg(F.count(F.lit(1)).alias("n")))
    shares = {"q1": 0.25, "q3": 0.75}
    every = _at_shares(counts.groupBy("measure", "bin").agg(F.sum("n").alias("n")), ["measure"], shares)
    own = _at_shares(counts, ["_by", "measure"], shares).join(
        F.broadcast(every.select("measure", F.col("q1").alias("all1"), F.col("q3").alias("all3"))), "measure")  # a row per measure
    few = F.col("n") / (F.col("n") + least)
    limits = []
    for m, (step, _, below, above, relative) in BANDS.items():
        low, high = (step * (F.col(q) * few + F.col(a) * (1 - few) + 0.5) for q, a in (("q1", "all1"), ("q3", "all3")))
        reach = width * step * (F.col("q3") - F.col("q1")) * few * few  # few say little on spread
        below, above = (x * q if relative else F.lit(x) for x, q in ((below, low), (above, high)))
        for name, limit in (("low", low), ("high", high), ("below", F.greatest(reach, below)), ("above", F.greatest(reach, above))):
            limits.append(F.max(F.when(F.col("measure") == m, limit)).alias(f"_{name}_{m}"))
    return own.groupBy("_by").agg(*limits)


def judge(measured: DataFrame, by: str = "lang", width: float = 3.0, least: int = 20,
          broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """measured plus entropy_gap, base_failed and kept."""
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    tokens = F.when(F.col("chars_per_token") > 0, (F.col("word_chars") + F.col("n_words")) / F.col("chars_per_token"))
    rows = (measured.withColumn("base_failed", base).withColumn("_by", F.coalesce(F.col(by).cast("string"), F.lit("")))
            .withColumn("_doublings", F.log2(F.greatest(F.coalesce(tokens, F.lit(1.0)), F.lit(1.0))))
            .withColumn("_gap", F.greatest(F.col("_doublings") - F.col("token_entropy"), F.lit(0.0))))
    usual = F.lit(0.0)
    for c in expected_gap(rows.where("not base_failed")):
        usual = usual * F.col("_doublings") + F.lit(c)
    rows = rows.withColumn("entropy_gap", F.col("_gap") / F.greatest(usual, F.lit(LEAST_GAP)))
    bands = cut(_bands(rows.where("not base_failed"), width, least))
    if bands.count() <= broadcast_rows:
        joined = rows.join(F.broadcast(bands), "_by", "left")
    else:
        salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
        salt = F.pmod(F.xxhash64(*measured.columns), F.lit(SALTS)).cast("int")
        joined = rows.withColumn("_salt", salt).join(bands.withColumn("_salt", salts), ["_by", "_salt"], "left")
    out = F.lit(0.0)
    for m in BANDS:
        value, low, high, below, above = (F.col(x) for x in (m, f"_low_{m}", f"_high_{m}", f"_below_{m}", f"_above_{m}"))
        out = out + F.pow(F.greatest((low - value) / below, (value - high) / above, F.lit(0.0)), F.lit(2.0))
    return joined.withColumn("kept", ~F.col("base_failed") & F.coalesce(out <= 1, F.lit(False))).select(*measured.columns, "entropy_gap", "base_failed", "kept")


def quality_rules(docs: DataFrame, byte_path: str, fallback_path: str, by: str = "lang") -> DataFrame:
    """doc_id, the measures, base_failed and kept, one row per row of docs."""
    return judge(cut(measure_quality(docs, byte_path, fallback_path, ["doc_id", by])), by)


def keep_good(docs: DataFrame, byte_path: str, fallback_path: str, by: str = "lang") -> DataFrame:
    """docs without the rejected rows. Decisions are joined by doc_id and a hash of the row's
    language and text. Other columns stay, whatever their names."""
    key = F.xxhash64(F.col(by), F.col("text"))
    rows = docs.select("doc_id", F.col(by).alias("by"), "text", key.alias("row_key"))
    doc_id, good_key = free_name(docs, "id"), free_name(docs, "key")
    good = (judge(cut(measure_quality(rows, byte_path, fallback_path, ["doc_id", "by", "row_key"])), "by")
            .where("kept").select(F.col("doc_id").alias(doc_id), F.col("row_key").alias(good_key)).distinct())
    same = F.col("doc_id").eqNullSafe(F.col(doc_id)) & (key == F.col(good_key))
    return docs.join(good, same, "left_semi")
