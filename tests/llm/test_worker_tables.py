"""What the Arrow kernels hold in a worker, and how often they encode a piece."""

from __future__ import annotations

import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa

from robustagg.llm import packing, pieces, quality, setjoin
from robustagg.llm.queries import tokenizer_path


def test_a_piece_is_encoded_once():
    """More distinct words than the former table held, in two orders."""
    words, seen = [f"w{i}" for i in range(170_000)], Counter()

    def encode(some):
        seen.update(some)
        return pieces.flat_ids([[len(x), int(x[1:])] for x in some])
    table = pieces.Pieces(encode)
    for part in (words, words[::-1]):
        joined, points, texts = pieces.code_points(pa.array(part))
        slots = table.lookup(joined, points, texts[:-1], texts[1:])
        assert table.gather(slots).reshape(-1, 2).tolist() == [[len(x), int(x[1:])] for x in part]
    assert set(seen.values()) == {1} and len(seen) == len(words)


def test_a_full_table_starts_again():
    table = pieces.Pieces(lambda some: pieces.flat_ids([[int(x)] for x in some]), limit=100)
    r = random.Random(3)
    for _ in range(50):
        part = [str(r.randrange(300)) for _ in range(60)]
        joined, points, texts = pieces.code_points(pa.array(part))
        assert table.gather(table.lookup(joined, points, texts[:-1], texts[1:])).tolist() == [int(x) for x in part]
        assert table.n <= 100


def test_models_go_with_the_task():
    byte, back = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": ["a word or two", None]})
    assert sum(b.num_rows for b in quality._measure(byte, back, ["doc_id"])(iter([batch]))) == 2
    assert sum(b.num_rows for b in packing._tokenize(byte, 2, 1024, False)(iter([batch]))) == 2
    assert not pieces._TOKENS and not quality._FALLBACK and len(pieces._POINTS.up) == 1


def test_counting_shingles_reads_texts_piece_by_piece():
    """The same counts as over the whole slice, in less memory than that took."""
    r = random.Random(5)
    texts = [" ".join(str(r.randrange(10_000_000)) for _ in range(400)) for _ in range(1700)]
    texts += texts[:100] + [None, "", "one two"]
    batch = pa.RecordBatch.from_pydict({"text": texts})
    kernel = setjoin._common(5)
    tracemalloc.start()
    out = list(kernel(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    values, n = np.unique(np.concatenate(setjoin.shingle_sets(batch.column("text"), 5)), return_counts=True)
    assert [(s, c) for b in out for s, c in zip(b["shingle"].to_pylist(), b["n"].to_pylist(), strict=True)] == [
        (s, c) for s, c in zip(values.view(np.int64).tolist(), n.tolist(), strict=True) if c > 1]
    assert peak < 60e6, peak


def test_quality_reads_texts_piece_by_piece():
    """The same measures as text by text, in less memory than a megabyte of text at a time takes."""
    byte, back = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
    r = random.Random(1)
    words = ["".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 9))) for _ in range(3000)]
    texts = [" ".join(r.choice(words) for _ in range(700)) for _ in range(800)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(800)), "text": texts})
    tracemalloc.start()
    out = list(quality._measure(byte, back, ["doc_id"])(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    one = [x for i in range(0, 800, 40) for x in quality._measure(byte, back, ["doc_id"])(iter([batch.slice(i, 1)]))]
    assert [x for b in out for x in b.to_pylist()][::40] == [x for b in one for x in b.to_pylist()]
    assert peak < 45e6, peak
