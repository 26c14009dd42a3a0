"""Licence scan, Merkle manifest and conversation repair against plain versions and SQL."""

from __future__ import annotations

import hashlib
import random
import zlib

import brute
import duckdb
import pytest
from pyspark.sql import functions as F

from conftest import SF001
from robustagg.llm import licences, merkle, repair
from robustagg.llm.queries import ORACLES, QUERIES
from tools.check_oracles import compare

NEW = ["op11_licence_scan", "op12_merkle_manifest", "op13_repair_conversations"]


def same_as_sql(df, name, **tables):
    con = duckdb.connect()
    for table, path in tables.items():
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    cur = con.execute(ORACLES[name])
    return compare(df.collect(), df.columns, cur.fetchall(), [d[0] for d in cur.description])


@pytest.mark.parametrize("name", NEW)
def test_queries_match_sql(spark, name):
    tables = {t: f"{SF001}/{t}.parquet" for t in ("documents", "conversations")}
    assert same_as_sql(QUERIES[name](spark, SF001), name, **tables) is None


# ---------------------------------------------------------------- documents

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, tree string, cell long, at long, leaf string, "
          "proof string, matches int, `__at` int, part int")
MORE = ("t", 7, 8, "l", "p", 1, 2, 3)


def documents():
    r = random.Random(3)
    words = ["the", "license", "mit", "apache", "Software", "of", "permission", "é", "x1"]
    texts = [None, "", " \n", "MIT License", "mit-license MIT  LICENSE", "The Apache License, Version 2.0", "General public license",
             "a " * 70_000, "mit license " * 3000] + [t for _, t, _ in licences.TEMPLATES]
    for _, t, _ in licences.TEMPLATES:  # notices inside other words, with one more word, or cut short
        w = t.split(" ")
        at = r.randrange(len(w))
        texts += ["lead " * r.randrange(30) + t + " the end", " ".join(w[:at] + ["inserted"] + w[at:]), " ".join(w[:len(w) // 2])]
    texts += [" ".join(r.choice(words) for _ in range(r.randrange(60))) for _ in range(80)]
    rows = [(i, t, "en" if i % 3 else None, r.choice([None, "", "é", "hot", "hot"]), i if i % 4 else None, *MORE)
            for i, t in enumerate(texts)]
    return rows + [(None, "x", None, None, None, *MORE), (5, "again", "en", "hot", 1, *MORE), rows[4], rows[4]]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(documents(), SCHEMA).repartition(5)


def plain_licences(rows):
    low = [brute.ALNUM.findall((x[1] or "").translate(brute.LOWER)) for x in rows]
    templates = [(label, licences.words_of(t), [licences.words_of(k) for k in keys]) for label, t, keys in licences.TEMPLATES]
    often = {}
    for w in low:
        for x in set(w):
            often[x] = often.get(x, 0) + 1
    out = []
    for row, w in zip(rows, low, strict=True):
        places = [(i, label) for p, label in licences.BASE for i in range(len(w)) if w[i:i + len(p.split())] == p.split()]
        labels, best = {label for _, label in places}, 0.0
        for label, t, keys in templates:
            rare = sorted({x for x in t if x in set(w)}, key=lambda x: (often[x], x))[:licences.LOOKUP]
            votes = {}
            for x in rare:
                for s in {i - j for i in range(len(w)) if w[i] == x for j in range(len(t)) if t[j] == x}:
                    votes[s] = votes.get(s, 0) + 1
            at = [(next(j for j in range(len(t)) if t[j:j + len(k)] == k), k) for k in keys]
            found = [[i for i in range(len(w)) if w[i:i + len(k)] == k] for _, k in at]
            for s, n in votes.items():
                if n >= licences.VOTES and all(any(abs(i - s - j) <= licences.SLACK for i in f) for (j, _), f in zip(at, found, strict=True)):
                    labels.add(label)
                    best = max(best, sum(0 <= s + j < len(w) and w[s + j] == t[j] for j in range(len(t))) / len(t))
        starts = [i for i, _ in places]
        out.append((row[0], len(w), len(places), min(starts, default=None), max(starts, default=None),
                    sorted({x for _, x in places}), sorted(labels), best))
    return out


def test_licences(spark, docs):
    rows = [x for x in documents() if len(x[1] or "") < 50_000]
    got = licences.scan_licences(spark.createDataFrame(rows, SCHEMA).repartition(3))
    got = sorted((tuple(r)[:8] for r in got.collect()), key=str)
    assert got == sorted(plain_licences(rows), key=str)
    whole = licences.scan_licences(docs).collect()
    assert len(whole) == len(documents()) and max(r.n_base for r in whole) == 3000
    notices = {x[1] for x in rows} & {t for _, t, _ in licences.TEMPLATES}
    by_id = {r.doc_id: r for r in whole}
    for i, x in enumerate(documents()):
        if x[1] in notices:
            label = next(la for la, t, _ in licences.TEMPLATES if t == x[1])
            assert label in by_id[i].labels and any(m.score == 1.0 and m.label == label for m in by_id[i].matches)
    assert licences.scan_licences(spark.createDataFrame([], SCHEMA)).count() == 0


def H(*x):
    return hashlib.sha256("".join(x).encode()).hexdigest()


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        n = levels[-1]
        levels.append([H(*n[i:i + 16]) for i in range(0, len(n), 16)])
    return levels


def beside(levels, i):
    out = []
    for level in levels[:-1]:
        run = i - i % 16
        out.append(("".join(level[run:i]), "".join(level[i + 1:run + 16])))
        i //= 16
    return out


def plain_manifest(rows):
    leaf = lambda r: H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in r))
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    names = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    for k in names:
        groups[k].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = [tree([leaf(r) for r in groups[k]]) for k in names]
    top, out = tree([t[-1][0] for t in trees]), []
    for j, k in enumerate(names):
        for i, r in enumerate(groups[k]):
            proof = beside(trees[j], i) + beside(top, j)
            x = leaf(r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
                x = leaf((*r[:4], r[4] and r[4].translate(brute.LOWER)))
            for a, b in proof:
                x = H(a, x, b)
            out.append((r[0], leaf(r), trees[j][-1][0], top[-1][0], H(*(a + b for a, b in proof)), x, x == top[-1][0]))
    return out


def manifest(docs):
    hit = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    out = merkle.document_manifest(docs, ["doc_id", "source", "lang", "n_chars", "text"],
                                   F.when(hit, F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    folded = merkle.fold(F.coalesce("changed_leaf", "leaf"), F.col("proof"))
    return out.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("proof")).alias("p"),
                      folded.alias("f")).withColumn("v", F.col("f") == F.col("root"))


def test_manifest(spark, docs):
    rows = [(x[0], x[3], x[2], x[4], x[1]) for x in documents()]
    assert sorted(map(tuple, manifest(docs).collect()), key=str) == sorted(plain_manifest(rows), key=str)
    assert manifest(spark.createDataFrame([], SCHEMA)).collect() == []
    one = spark.createDataFrame([(1, "X", None, "s", None, *MORE)], SCHEMA)
    got = manifest(one).first()
    assert got.leaf == got.subroot == got.root and got.p == H("")


def test_manifest_of_a_group_over_several_cells_and_of_many_groups(spark):
    r = random.Random(1)
    rows = [(i, "hot" if i % 3 else r.choice([None, ""] + [f"s{q}" for q in range(300)]), None, i, f"T {i}") for i in range(9000)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(6)
    assert sorted(map(tuple, manifest(df).collect()), key=str) == sorted(plain_manifest(rows), key=str)


@pytest.mark.parametrize("cells", [1, 2, 15, 16, 17, 31, 33, 255, 256, 257, 300, 529])
def test_butterfly_rounds(spark, cells):
    """Every cell ends with the root and its whole upper proof, ragged last subtrees included."""
    roots = [H(str(i)) for i in range(cells)]
    state = spark.createDataFrame([("t", i, cells, x, []) for i, x in enumerate(roots)],
                                  f"tree string, cell long, cells long, root string, up {merkle.PROOF}")
    w = 1
    while w < cells:
        state, w = merkle._round(state, w), w * 16
    levels = tree(roots)
    got = state.collect()
    assert sorted(r.cell for r in got) == list(range(cells))
    for r in got:
        assert r.root == levels[-1][0] and [tuple(p) for p in r.up] == beside(levels, r.cell)


# ---------------------------------------------------------------- conversations

def plain_edits(codes):
    """Least (cost, audit) by plain recursion from the end."""
    n, best = len(codes), {}
    for i in range(n, -1, -1):
        now = {0: (0, ""), 3: (0, "")} if i == n else {}
        if i < n:
            for q in range(4):
                for w, c, j, p in repair._edges(codes, i, q):
                    if j == i + 1 and (j, p) in best:
                        x = (w + best[j, p][0], c + best[j, p][1])
                        now[q] = min(now.get(q, x), x)
        for _ in range(3):
            for q in range(4):
                if (p := repair.NEXT_ROLE[q]) in now:
                    x = (5 + now[p][0], "I" + now[p][1])
                    now[q] = min(now.get(q, x), x)
        best |= {(i, q): v for q, v in now.items()}
    return best[0, 0]


def test_bidirectional_search_and_joined_blocks():
    r = random.Random(4)
    for _ in range(1500):
        codes = "".join(r.choice("suaxSUAX-ua") for _ in range(r.randint(0, 12)))
        want = plain_edits(codes)
        cost, audits = repair.cheapest(codes)
        assert (cost, audits[0]) == want
        cuts = sorted(r.sample(range(len(codes) + 1), r.randint(0, min(3, len(codes)))))
        parts = [p for a, b in zip([0, *cuts], [*cuts, len(codes)], strict=True) if (p := codes[a:b])]
        if parts:
            total, joined = repair.join_blocks([repair.solve_block(p, False) for p in parts])
            assert (total, "".join(a for _, a in joined)) == want


def conversations():
    r = random.Random(6)
    said = ["Yes.", "no", "", " \t", "What?", "ok!", None, "A. b", "end. ", "é", "x" * 20_000 + "."]
    roles = ["user", "assistant", "system", "user", "assistant", None, "tool", "User", "sys"]
    rows = [(c, t if r.random() < 0.9 else None, r.choice(roles), r.choice(said), "e", 1, 2, "c", "k")
            for c in [None, *range(60)] for t in range(r.randint(0, 9))]
    # One conversation over several blocks, long runs of equal turns, gaps.
    rows += [(1000, i // 2 * (1 + (i > 300)), r.choice(roles[:5]), f"{i} {r.choice(['a.', 'b', 'c?'])}", "e", 1, 2, "c", "k") for i in range(700)]
    return rows + [rows[3]] * 3


CONV = "conv_id long, turn long, role string, text string, edit string, part int, seq int, codes string, k string"


def test_repair_against_sql(spark, tmp_path):
    df = spark.createDataFrame(conversations(), CONV).repartition(6)
    path = str(tmp_path / "conversations.parquet")
    df.coalesce(1).write.parquet(path)
    out = repair.repair_conversations(repair.damage(spark.read.parquet(path)))
    columns = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert out.columns == columns
    assert same_as_sql(out, NEW[2], conversations=f"{path}/*.parquet") is None


def test_repaired_turns_are_legal_and_give_the_digest(spark):
    fixed = repair.Repair(repair.damage(spark.createDataFrame(conversations(), CONV)))
    turns = {}
    for t in fixed.turns().orderBy("part", "seq", "position").collect():
        turns.setdefault(t.conv_id, []).append(t)
    for s in fixed.summary().collect():
        mine = turns.get(s.conv_id, [])
        roles = "".join(t.role[0] for t in mine)
        assert roles.removeprefix("s") == "ua" * (len(roles) // 2) and roles != "s"
        assert s.repaired_sha256 == brute.sha("\n".join(f"{t.role}:{t.text}" for t in mine))
        assert s.cost >= sum({"R": 1, "D": 2, "I": 5, "K": 0}[c] for c in s.audit)


def test_repair_of_nothing(spark):
    empty = spark.createDataFrame([], CONV)
    assert repair.repair_conversations(empty).collect() == []
    dropped = next(c for c in range(999) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    one = spark.createDataFrame([(dropped, 0, "user", "Hi.", "e", 1, 2, "c", "k")], CONV)
    assert [tuple(r) for r in repair.repair_conversations(repair.damage(one)).collect()] == [
        (dropped, 0, 0, 0, 0, 0, 0, "", brute.sha(""))]
