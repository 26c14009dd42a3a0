"""Jobs done in whole: hot buckets and text without blanks in the line dedup, bands that reject and judge every row."""

from __future__ import annotations

import base64
import random
from collections import Counter

import brute
import pytest

from robustagg.llm import lines, quality
from robustagg.llm.queries import tokenizer_path


def spread(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(4)


def classes(df):
    return {r.doc_id: r.class_doc_id for r in lines.line_classes(df).collect()}


def test_near_copies_in_a_hot_bucket(spark):
    """Thousands of unlike lines around one template: each has a copy with one word changed."""
    r = random.Random(4)
    word = lambda: "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(3, 8)))
    template, rows = [word() for _ in range(23)], []
    for i in range(1500):
        first = template + [word() for _ in range(7)]
        second = first[:]
        second[r.randrange(23)] = word()
        rows += [(i, " ".join(first)), (5000 + i, " ".join(second))]
    texts = dict(rows)
    sets = {d: brute.line_shingles(x) for d, x in rows}
    similar = lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
    pairs = [i for i in range(1500) if similar(i, 5000 + i)]
    got = classes(spread(spark, rows))
    assert len(pairs) > 1400 and len(texts) == len(got)
    assert sum(got[i] == got[5000 + i] for i in pairs) >= 0.999 * len(pairs)
    assert max(Counter(got.values()).values()) < 100  # unlike lines stay apart


def test_hot_lines_against_all_pairs(spark):
    """Chains of near copies in one bucket: the exact way finds what all pairs give."""
    r = random.Random(5)
    word = lambda: f"{r.choice('bcdfg')}{r.randrange(30)}"
    template, rows = [f"common{i}" for i in range(14)], []
    for i in range(120):
        w = template + [word() for _ in range(8)]
        for _ in range(3):
            rows.append((len(rows), " ".join(w)))
            w = w[:]
            w[r.randrange(len(w))] = word()
    want = {}
    keys = [d for d, _ in rows]
    u, sets = brute.Union(keys), {d: brute.line_shingles(x) for d, x in rows}
    for a in keys:
        for b in keys[:a]:
            if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                u.join(a, b)
    want = {d: u.root(d) for d in keys}
    got = classes(spread(spark, rows))
    assert len(set(want.values())) > 10
    assert sum(got[d] == want[d] for d in keys) >= 0.99 * len(keys)
    assert all(want[got[d]] == want[d] for d in keys)


@pytest.mark.parametrize("kind", ["inserted", "deleted", "word", "long words"])
def test_recall_of_edited_lines(spark, kind):
    """True pairs (by every character run) that end in one class."""
    r, rows = random.Random(kind), []
    letters = "abcdefghijklmnopqrstuvwxyz"
    if kind == "long words":
        base = [" ".join("".join(r.choice(letters) for _ in range(r.randint(8, 16))) for _ in range(8)) for _ in range(200)]
    else:
        docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").orderBy("doc_id").limit(150).collect()
        base = sorted({x for d in docs for x in (d.text or "").split("\n") if len(x) > 60})[:400]
    for i, x in enumerate(base):
        if kind == "inserted" or kind == "deleted":
            y = list(x)
            for _ in range(max(1, len(x) // 120)):
                at = r.randrange(len(y))
                y[at:at + (kind == "deleted")] = [] if kind == "deleted" else [r.choice(letters)]
            y = "".join(y)
        else:
            w = x.split(" ")
            at = r.randrange(len(w))
            w[at] = r.choice(letters) + w[at] if kind == "long words" else "changed"
            y = " ".join(w)
        rows += [(i, x), (1000 + i, y)]
    sets = {d: brute.line_shingles(x) for d, x in rows}
    pairs = [i for i in range(len(base)) if len(sets[i] & sets[1000 + i]) >= 0.8 * len(sets[i] | sets[1000 + i])]
    got = classes(spread(spark, rows))
    found = sum(got[i] == got[1000 + i] for i in pairs)
    assert len(pairs) > 50 and found >= 0.95 * len(pairs), (found, len(pairs))


def test_repetitive_lines_of_unlike_length(spark):
    rows = [(1, "ab" * 60), (2, "ab" * 400), (3, "the the " * 30), (4, "the the " * 90)]
    assert classes(spread(spark, rows)) == {1: 1, 2: 1, 3: 3, 4: 3}


@pytest.mark.parametrize("kind", ["chinese", "tabs", "url"])
def test_lines_without_blanks(spark, kind):
    """One character put in near the start leaves the line a near copy."""
    r, rows = random.Random(kind), []
    for i in range(60):
        if kind == "chinese":
            x = "".join(chr(r.randrange(0x4E00, 0x9FA5)) for _ in range(r.choice([120, 300, 1000])))
        elif kind == "tabs":
            x = "\t".join("".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(40))
        else:
            x = "https://" + "/".join("".join(r.choice("abcdefgh0123") for _ in range(9)) for _ in range(20))
        rows += [(i, x), (1000 + i, x[:3] + "z" + x[3:])]
    got = classes(spread(spark, rows))
    assert sum(got[i] == got[1000 + i] == i for i in range(60)) >= 59


def test_line_dedup_runs_no_python(spark, monkeypatch):
    """Every step of it, hot buckets too, is DataFrame operations."""
    plans, cut = [], lines.cut

    def seen(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return cut(df)
    monkeypatch.setattr(lines, "cut", seen)
    r = random.Random(6)
    template = [f"common{i}" for i in range(20)]
    rows = [(i, " ".join([*template, *(f"w{r.randrange(40)}" for _ in range(4))]) + f"\nzeile für {i} größe") for i in range(60)]
    out = lines.dedup_lines(spread(spark, rows))
    assert out.count() > 0
    plans.append(out._jdf.queryExecution().executedPlan().toString())
    assert len(plans) > 8  # the exact way was taken
    assert not [p for p in plans if any(x in p for x in ("Python", "Pandas", "Arrow"))]


def test_lines_around_the_bound_of_chosen_runs(spark):
    """Copies on both sides of the sizes where a line's signature goes from all its runs to the chosen ones."""
    r, rows = random.Random(7), []
    for i in range(300):
        x = "".join(r.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(150 + 2 * i))
        at = r.randrange(len(x))
        rows += [(i, x), (1000 + i, x[:at] + "aeae" * (1 + len(x) // 60) + x[at:])]
    sets = {d: brute.line_shingles(x) for d, x in rows}
    pairs = [i for i in range(300) if len(sets[i] & sets[1000 + i]) >= 0.8 * len(sets[i] | sets[1000 + i])]
    got = classes(spread(spark, rows))
    assert len(pairs) > 250 and sum(got[1000 + i] == i for i in pairs) >= 0.97 * len(pairs)
    assert all(got[i] == i for i in range(300))


def noise(r):
    word = lambda letters: "".join(r.choice(letters) for _ in range(r.randint(3, 8)))
    return {"letters": " ".join(word("abcdefghijklmnopqrstuvwxyz") for _ in range(200)),
            "base64": " ".join(base64.b64encode(r.randbytes(24)).decode() for _ in range(80)),
            "symbols": " ".join(word("#*$%&|<>") for _ in range(200)),
            "numbers": " ".join(str(r.randrange(10 ** r.randint(2, 7))) for _ in range(200))}


@pytest.mark.parametrize(("size", "langs"), [("sf0.01", ["en", "de", "fr", "es"]), ("sf0.001", ["xx", None])])
def test_bands_reject_noise(spark, size, langs):
    """Noise goes at every size and under any language code, clean documents stay."""
    r = random.Random(2)
    docs = spark.read.parquet(f"/root/testdata/{size}/documents.parquet").selectExpr("cast(doc_id as string) doc_id", "lang", "text")
    rows = [(f"{kind} {lang}", lang, text) for lang in langs for kind, text in noise(r).items()]
    out = quality.quality_rules(docs.unionByName(spark.createDataFrame(rows, docs.schema)),
                                tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")).collect()
    added = {x[0] for x in rows}
    assert [x.doc_id for x in out if x.doc_id in added and (x.base_failed or x.kept)] == []
    clean = Counter((x.lang, x.kept) for x in out if x.doc_id not in added and not x.base_failed)
    for lang in {k for k, _ in clean}:
        assert clean[lang, False] <= 0.01 * clean[lang, True]
