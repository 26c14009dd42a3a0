"""URL filter, chat formatting, components, SQL oracles and the pipeline."""

from __future__ import annotations

import os
import random
import sys

import brute
import duckdb
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline
from robustagg.llm import chat, queries, urls
from robustagg.llm.common import components

SF = "/root/testdata/sf0.001"


def test_components(spark):
    r = random.Random(1)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(400, 460)]
    edges += [(1000, 1000 + i) for i in range(1, 80)] + [(5, 5), (None, 3)]
    u = brute.Union({x for e in edges for x in e if x is not None})
    for a, b in edges:
        if a is not None:
            u.join(a, b)
    out = components(spark.createDataFrame(edges, "a long, b long")).collect()
    want = {x: u.root(x) for a, b in edges if a is not None and a != b for x in (a, b)}
    assert sorted(map(tuple, out)) == sorted(want.items())
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


RULES = [*queries.URL_RULES, ("bad.net", "/", "block"), ("good.net", "/", "allow")]


def page(url, canonical=None, refresh=None, i=[0]):  # noqa: B006
    i[0] += 1
    html = "<html><head>"
    html += f'<link href="{canonical}" rel="canonical">' if canonical else ""
    html += f"<META http-equiv='Refresh' content='0; URL={refresh}'>" if refresh else ""
    return (i[0], url, html if canonical or refresh or i[0] % 2 else None, "host")


def test_url_verdicts(spark):
    rows = [page("http://a.x/1", canonical="http://BAD.net/q"),  # alias of a blocked url that is no page
            page("https://a.x/2", refresh="/1"),  # alias of an alias, relative link
            page("http://a.x/3", canonical="http://good.net/z"), page("http://b.x/3#top", refresh="http://a.x/3"),
            page("http://b.x/4", canonical="http://bad.net/4"), page("http://c.x/4", canonical="http://b.x/4"),
            page("http://d.x/4", canonical="http://c.x/4"), page("http://good.net/4", refresh="http://d.x/4"),
            page("http://sub.Example.org/es/1?q=http://x"), page("http://example.org/en/12"), page("http://example.org/fr"),
            page("http://org"), page("http://org/"), page("no scheme"), page(None), page("http://a.com/de/1"),
            page("http://a.com/de/1"), page("://x.com/fr/?a#b"), page("http://z.x/9")]
    redirects = spark.createDataFrame([("http://z.x/9", "http://y.com/de/7"), (None, "http://bad.net/")], "src string, dst string")
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    out = {r.page_id: r for r in urls.url_verdicts(df, RULES, redirects).collect()}
    got = [(r.rule, r.verdict) for _, r in sorted(out.items())]
    assert got == [(None, "block"), (None, "block"), (None, "allow"), (None, "allow"),
                   (None, "allow"), (None, "allow"), (None, "allow"), ("good.net/", "allow"),  # allow goes before block
                   ("example.org/es/", "block"), ("example.org/en/1", "block"), ("org/", "allow"), (None, "allow"),
                   ("org/", "allow"), (None, "allow"), (None, "allow"), ("com/de/", "block"), ("com/de/", "block"),
                   ("com/fr/", "allow"), (None, "block")]
    first = out[min(out)]
    assert (out[min(out) + 8].host, out[min(out) + 8].path) == ("sub.example.org", "/es/1") and first.host == "a.x"
    assert urls.url_verdicts(df.limit(0), RULES).count() == 0


def test_reply_trees(spark):
    rows = [("t", 1, None, "system", "be kind", 0.0), ("t", 2, 1, "user", "hi", 1.0), ("t", 3, 2, "assistant", "yo", 1.0),
            ("t", 4, 2, "assistant", "hello", 5.0), ("t", 5, 3, "user", "deep", 9.0), ("t", 6, 1, "user", None, None),
            ("t", 6, 1, "user", None, None), ("t", 7, 99, "user", "orphan", 0.5), ("u", 1, None, "user", "solo", 0.0),
            ("c", 1, 2, "user", "loop", 0.0), ("c", 2, 1, "user", "loop", 0.0), (None, 1, None, "user", "x", 0.0)]
    nodes = spark.createDataFrame(rows, "tree string, node long, parent long, role string, text string, score double")
    paths = chat.reply_paths(nodes)
    out = {(r.tree, r.leaf): r for r in chat.format_paths(paths).withColumn("turns", chat.parse_turns(F.col("formatted")))
           .collect()}
    assert {k: r["rank"] for k, r in out.items()} == {("t", 5): 1, ("t", 4): 2, ("t", 7): 3, ("t", 6): 4, ("u", 1): 1}
    assert [(t.role, t.text) for t in out["t", 5].turns] == [("system", "be kind"), ("user", "hi"), ("assistant", "yo"),
                                                            ("user", "deep")]
    assert [s.text for s in out["t", 4].segments if s.loss] == ["hello"]
    best = chat.reply_paths(nodes, top=1).select("tree", "leaf").distinct().collect()
    assert sorted(map(tuple, best)) == [("t", 5), ("u", 1)]
    assert chat.format_paths(chat.reply_paths(nodes.limit(0))).count() == 0


def test_chat_round_trip(spark):
    r, bits = random.Random(9), ["</s>", "[INST]", "[/INST]", "<|im_end|>\n", "<|im_start|>", "\\", "<", "[", "é", "\n",
                                 "<s>", "<<SYS>>", "assistant\n", "|", "im_end", "$1", ""]
    rows = [(c, t, r.choice(["user", "assistant", "sy|s\\te\nm", None, "assistant"]),
             r.choice([None, "".join(r.choice(bits) for _ in range(r.randint(0, 12)))])) for c in range(40) for t in range(6)]
    rows += [(90, 0, "user", "same"), (90, 0, "user", "same"), (91, None, "assistant", "x" * 200_000), (None, 0, "user", "a")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat.format_paths(chat.reply_paths(chat.conversation_nodes(df)))
    out = out.withColumn("conv", chat.conversation_id(F.col("tree")))
    got = {x.conv: x for x in out.withColumn("turns", chat.parse_turns(F.col("formatted"))).collect()}
    want = {}
    for c, t, role, text in sorted(rows, key=lambda x: (x[1] is not None, x[1] or 0, x[2] or "", x[3] or "")):
        want.setdefault(c, []).append((role or "", text or ""))
    assert None in want
    assert got.keys() == want.keys()
    for c, turns in want.items():
        assert sorted((x.role, x.text) for x in got[c].turns) == sorted(turns)
        assert "".join(s.text for s in got[c].segments) == got[c].formatted
        for x in ("</s>", "[INST]", "[/INST]"):
            assert x not in got[c].formatted
    assert not any(x in out._jdf.queryExecution().executedPlan().toString() for x in ("Python", "Pandas", "Arrow"))


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracles(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "conversations"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    df = queries.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    want = con.sql(f"select {', '.join(columns)} from ({queries.ORACLES[name]})").fetchall()
    assert sorted(map(str, map(tuple, df.select(*columns).collect()))) == sorted(map(str, want))


def test_pipeline(spark):
    """Each stage on its predecessor's rows; its decisions take effect and copies go."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    start, stages = {r.doc_id: r for r in docs.collect()}, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), docs.schema)
        stages[name] = {r.doc_id: r.text for r in docs.collect()}
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    rules, deduped, joined, clean = stages.values()
    for d, r in start.items():
        want = brute.quality_counts(r.text)
        assert d not in rules or (want[0] >= 50 and 100 * want[4] <= 50 * want[0])
        if want[0] >= 50 and 100 * want[4] <= 50 * want[0]:
            assert rules[d] == r.text  # the bands leave these documents alone
    classes = brute.line_classes(sorted(rules.items()))
    for d, text in rules.items():
        kept = [x for i, x in enumerate(text.split("\n")) if classes.get((d, i), (d, i)) == (d, i)]
        assert (d in deduped) == any(classes.get((d, i)) == (d, i) for i in range(text.count("\n") + 1))
        assert d not in deduped or deduped[d] == "\n".join(kept)
    assert set(joined) == {c for _, _, c, _ in brute.jaccard_classes(sorted(deduped.items()), 5, 80)}
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for d, _, hit, _ in brute.leaks(sorted(joined.items()), items):
        assert (d in clean) != (bool(hit) and all(hit))
        assert any(hit) or clean[d] == joined[d]
    packed = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in packed} == set(clean) and all(0 < r.length <= 1024 for r in packed)
