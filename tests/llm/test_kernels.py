"""Streaming kernels give the same rows however their input is cut into batches."""

from __future__ import annotations

import random

import brute
import numpy as np
import pyarrow as pa
import pytest

from robustagg.llm import recompress, setjoin


def cuts(table: pa.Table, r: random.Random):
    at = 0
    while at < table.num_rows:
        n = r.choice([1, 1, 2, 3, 7, 50])
        yield from table.slice(at, n).combine_chunks().to_batches()
        at += n


def rows(batches):
    return [tuple(x) for b in batches for x in zip(*(c.to_pylist() for c in b.columns), strict=True)]


@pytest.mark.parametrize("seed", range(20))
def test_several(seed):
    r = random.Random(seed)
    token = sorted(r.choice([r.randrange(10), r.randrange(200)]) for _ in range(r.randrange(120)))
    table = pa.table({"c1": list(range(len(token))), "n": [1] * len(token), "token": token})
    got = rows(setjoin._several(cuts(table, r)))
    assert sorted(got) == [(i, 1, t) for i, t in enumerate(token) if token.count(t) > 1]


def bitmap(s, small):
    odd = np.bincount([x % setjoin.LONG for x in s], minlength=setjoin.LONG) & 1
    if small:
        odd = odd.reshape(setjoin.SHORT, -1).sum(axis=1) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


@pytest.mark.parametrize("seed", range(30))
def test_list_links_keep_every_link(seed, monkeypatch):
    """Sets that link and share a list end in one component."""
    r = random.Random(seed)
    if seed % 2:
        monkeypatch.setattr(setjoin, "LONG_LIST", 4)
    monkeypatch.setattr(setjoin, "SMALL_SET", 45)
    base = [set(r.sample(range(5000), r.choice([20, 40, 60]))) for _ in range(4)]
    sets = {}
    for c in range(60):
        s = set(r.choice(base))
        for _ in range(r.randrange(5)):
            s.discard(r.choice(sorted(s)))
            s.add(r.randrange(5000))
        sets[c] = s
    lists = [(r.randrange(12), len(sets[c]), c) for c in sets for _ in range(2)]
    lists = sorted(set(lists))
    table = pa.table({"c1": [x[2] for x in lists], "n": [x[1] for x in lists], "token": [x[0] for x in lists],
                      "bits": pa.array([bitmap(sets[x[2]], len(sets[x[2]]) <= 45) for x in lists], pa.binary())})
    u = brute.Union(sets)
    for a, b in rows(setjoin._list_links(80)(cuts(table, r))):
        u.join(a, b)
    for t, n, a in lists:
        for t2, n2, b in lists:
            if t == t2 and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                assert u.root(a) == u.root(b)


@pytest.mark.parametrize("seed", range(30))
def test_shared_pairs(seed):
    r = random.Random(seed)
    pairs = sorted({(r.randrange(-8, 8), r.randrange(6)) for _ in range(r.randrange(60))})
    pairs = sorted(pairs + [p for p in pairs if r.random() < 0.2])
    table = pa.table({"key": pa.array([p[0] for p in pairs], pa.int64()), "doc_id": pa.array([p[1] for p in pairs], pa.int64())})
    got = set(rows(recompress._shared(cuts(table, r))))
    want = set()
    for key, doc in pairs:
        docs = {d for k, d in pairs if k == key}
        if (doc > min(docs)) if key & 1 else len(docs) > 1:
            want.add((doc, key))
    assert got == want


def test_settled_slices_agree_with_one_slice():
    """Asking per slice and joining the answers is the same as seeing all at once."""
    r = random.Random(3)
    for _ in range(50):
        docs = np.arange(12)
        pairs = [(r.randrange(8) * 2 + odd, r.randrange(12)) for odd in (0, 1) for _ in range(15)]
        asked, known = set(), set()
        for part in (pairs[::2], pairs[1::2]):
            keys = np.array([k for k, _ in part], np.uint64)
            ak, ad, kk, kd = recompress._settle(keys, np.array([d for _, d in part]), docs, (keys & np.uint64(1)).astype(bool))
            asked |= set(zip(ak.tolist(), ad.tolist(), strict=True))
            known |= set(zip(kd.tolist(), kk.tolist(), strict=True))
        rows_ = sorted(asked)
        table = pa.table({"key": pa.array([p[0] for p in rows_], pa.int64()), "doc_id": pa.array([p[1] for p in rows_], pa.int64())})
        got = known | set(rows(recompress._shared(cuts(table, r))))
        want = {(d, k) for k, d in pairs if ((d > min(x for y, x in pairs if y == k)) if k & 1
                                             else len({x for y, x in pairs if y == k}) > 1)}
        assert got == want
