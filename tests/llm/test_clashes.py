"""Every stage and operator on rows with nulls, repeats, long texts and columns named like those used inside."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from robustagg.llm import chat, lines, packing, quality, recompress, secrets, setjoin, shards, urls
from robustagg.llm.queries import URL_RULES, tokenizer_path

SF = "/root/testdata/sf0.001"
NAMES = ["_key", "_spans", "_class", "doc", "key", "_text", "_host", "_m", "_words", "_items", "_id", "_good", "_lost", "_gone",
         "__lost", "__key", "__id", "by", "row_key", "k0", "n", "id", "v", "line", "_class_verdict"]


def clashing(df):
    return df.select("*", *(F.lit(f"own {c}").alias(c) for c in NAMES))


@pytest.fixture(scope="module")
def docs(spark):
    r = random.Random(8)
    words = ["alpha", "beta", "über", "gamma", "delta", "zeta", "the", "of", "Ñandú"] + [f"word{i}" for i in range(300)]
    prose = lambda n: " ".join(r.choice(words) for _ in range(n))
    rows = [(i, prose(r.randint(60, 200)) + ".\n" + prose(20), r.choice(["en", "de", None]), f"s{i % 3}", i) for i in range(60)]
    rows += [(100, None, "en", None, None), (101, "", "en", "s", 0), (None, prose(80), None, None, None),
             (102, prose(20_000), "en", "s", 1), rows[3], rows[3], (103, rows[3][1], "en", "s", 2), (104, " \n \t", "de", "s", 3)]
    given = spark.read.parquet(f"{SF}/documents.parquet").schema
    return clashing(spark.createDataFrame(rows, given)).repartition(4)


@pytest.mark.parametrize("stage", range(4))
def test_stages_keep_columns_whatever_their_names(spark, docs, stage):
    out = corpus_pipeline.STAGES[stage][1](spark, docs, SF)
    assert out.columns == docs.columns
    rows = out.collect()
    assert rows and all(r[c] == f"own {c}" for r in rows for c in NAMES)
    plain = corpus_pipeline.STAGES[stage][1](spark, docs.drop(*NAMES), SF).collect()
    assert sorted(map(str, plain)) == sorted(str(r) for r in out.drop(*NAMES).collect())
    assert corpus_pipeline.STAGES[stage][1](spark, docs.limit(0), SF).collect() == []


def test_packing_and_the_other_operators(spark, docs):
    byte, back = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
    n = docs.count()
    assert packing.pack_documents(docs, byte).select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
    for out in (secrets.scan_secrets(docs), recompress.substring_dedup(docs), shards.balanced_shards(docs, 4),
                quality.quality_rules(docs, byte, back), setjoin.jaccard_join(docs)):
        assert out.count() == n
    assert lines.line_classes(docs).count() > 0


def test_urls_keep_columns_whatever_their_names(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    plain = urls.url_verdicts(pages, URL_RULES)
    out = urls.url_verdicts(clashing(pages), URL_RULES)
    assert sorted(map(str, out.select(plain.columns).collect())) == sorted(map(str, plain.collect()))
    assert all(r[c] == f"own {c}" for r in out.collect() for c in NAMES)


def test_conversations_without_an_id_are_formatted(spark):
    rows = [(None, 0, "user", "Hi"), (None, 1, "assistant", "Yo"), (0, 0, "user", "zero"), (3, None, None, None)]
    df = clashing(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    out = chat.format_paths(chat.reply_paths(chat.conversation_nodes(df)))
    out = out.select(chat.conversation_id(F.col("tree")).alias("c"), F.size(chat.parse_turns(F.col("formatted"))).alias("n"))
    assert sorted(map(tuple, out.collect()), key=str) == [(0, 1), (3, 1), (None, 2)]


def test_run_on_awkward_documents(spark, docs, tmp_path):
    for name, rows in (("some", docs), ("none", docs.limit(0))):
        folder = str(tmp_path / name)
        rows.write.parquet(f"{folder}/documents.parquet")
        spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{folder}/benchmark.parquet")
        out = corpus_pipeline.run(spark, folder)
        assert (out.count() > 0) == (name == "some")
