"""Cut edges of the balanced label propagation against a plain one, and large groups."""

import random
from collections import Counter, defaultdict

from robustagg.llm import shards

SHARDS = 8


def cut_rows(groups, where):
    """Linked rows outside the shard that holds most of their group."""
    return sum(len(ids) - max(Counter(where[i] for i in ids).values()) for ids in groups.values())


def plain_propagation(groups, n):
    """Rows dealt in turn; one group after another moves to the shard with most of its rows
    that has room for linked rows, three times."""
    where = {i: i % SHARDS for ids in groups.values() for i in ids}
    for _ in range(3):
        for ids in groups.values():
            have, load = Counter(where[i] for i in ids), Counter(where.values())
            best = max(range(SHARDS), key=lambda s: (load[s] + len(ids) - have[s] <= n // SHARDS, have[s], -load[s]))
            free = n // SHARDS - load[best]
            for i in ids:
                if where[i] != best and free > 0:
                    where[i], free = best, free - 1
    return cut_rows(groups, where)


def run(spark, groups, n, **kwargs):
    texts = {i: f"group {g}" for g, ids in groups.items() for i in ids}
    rows = [(i, texts.get(i, f"text {i}")) for i in range(n)]
    out = shards.balanced_shards(spark.createDataFrame(rows, "doc_id long, text string"), shards=SHARDS, **kwargs).collect()
    where = {r.doc_id: r.shard for r in out}
    counts = Counter(where.values())
    assert len(out) == n and max(counts.values()) - min(counts.values()) <= 1
    for s in range(SHARDS):
        assert sorted(r.slot for r in out if r.shard == s) == list(range(counts[s]))
    return where


def spread_groups(sizes, n, seed):
    ids = list(range(n))
    random.Random(seed).shuffle(ids)
    groups, at = defaultdict(list), 0
    for g, size in enumerate(sizes):
        groups[g] = ids[at:at + size]
        at += size
    return groups


def test_cut_against_plain_propagation(spark):
    r, n = random.Random(5), 2000
    groups = spread_groups([200, 150, 120] + [r.randint(2, 30) for _ in range(30)], n, 1)
    linked = sum(map(len, groups.values()))
    for bucket_rows in (100_000, 40):  # large hubs in one bucket, or in several
        cut = cut_rows(groups, run(spark, groups, n, bucket_rows=bucket_rows))
        assert cut <= plain_propagation(groups, n) + 0.05 * linked
        assert cut <= 0.1 * linked


def test_group_larger_than_a_shard(spark):
    """A third of all rows: whole shards and a rest; a group of nearly a shard stays whole."""
    n = 1600
    groups = spread_groups([533, 190], n, 2)
    where = run(spark, groups, n)
    spans = [sorted(Counter(where[i] for i in ids).values(), reverse=True) for ids in groups.values()]
    assert sum(spans[0][:3]) >= 0.9 * 533
    assert spans[1][0] >= 0.9 * 190


def test_repeated_ids_do_not_multiply(spark):
    rows = [(5, "same")] * 300 + [(None, "same")] * 5 + [(i, f"text {i}") for i in range(100, 200)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = shards.balanced_shards(df, shards=4).collect()
    assert len(out) == 405 and Counter(r.doc_id for r in out)[5] == 300
    assert all(r.hubs <= 1 for r in out)
    counts = Counter(r.shard for r in out)
    assert max(counts.values()) - min(counts.values()) <= 1
