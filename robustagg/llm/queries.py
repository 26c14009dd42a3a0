"""The queries of this subpackage, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (chat, decontam, licences, lines, merkle, oracles, packing, quality, recompress, repair, secrets, setjoin,
               shards, urls)
from .common import ascii_lower, read_table

URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setjoin.jaccard_join(read_table(spark, sf_dir, "documents"), k=3, threshold=90)


def tokenizer_path(name: str) -> str:
    """Path of a public vocabulary file; the package is where the cluster keeps them."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op2_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"),
                                  size=1024, end_id=2)


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = secrets.scan_secrets(read_table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] != "token")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return out.select("doc_id", *map(count, secrets.BASE),
                      F.sha2(secrets.span_text(base), 256).alias("base_sha256"),
                      secrets.span_text(F.col("spans")).alias("spans"),
                      F.size(F.filter("spans", lambda s: s["specific"])).cast("long").alias("n_specific"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = recompress.substring_dedup(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.url_verdicts(read_table(spark, sf_dir, "pages"), URL_RULES).select(
        "page_id", "host", "path", "rule", "verdict")


def op6_token_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(read_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"),
                                 tokenizer_path("piece_bpe_32k.model")).drop("lang")


def op7_chat_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    out = chat.format_paths(chat.reply_paths(chat.conversation_nodes(rows.unionByName(extra)), top=1))
    turns = chat.parse_turns(F.col("formatted"))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: chat.unescape(s["text"]))
    return (out.withColumn("turns", turns).withColumn("loss", F.array_join(loss, ""))
            .select(chat.conversation_id(F.col("tree")).alias("conv_id"), F.size("turns").cast("long").alias("n_turns"),
                    F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
                    F.char_length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                    F.char_length("formatted").cast("long").alias("formatted_chars")))


def op8_balanced_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.balanced_shards(read_table(spark, sf_dir, "documents"), shards=16)


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontam.find_leaks(docs, read_table(spark, sf_dir, "benchmark"), n=10)
    n_hit = F.aggregate("_spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return found.select("doc_id", F.col("_words").alias("n_words"), n_hit.alias("n_hit"),
                        F.size("_items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("_items", ","), 256).alias("items_sha256"),
                        (F.size("_spans") > 0).alias("contaminated"))


def op10_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line with a word: its class (named by the line that is kept) and whether it stays."""
    out = lines.line_classes(read_table(spark, sf_dir, "documents"))
    return out.withColumn("kept", (F.col("doc_id") == F.col("class_doc_id"))
                          & (F.col("line_no") == F.col("class_line_no")))


def op11_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan_licences(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"), "score")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    hit = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    out = merkle.document_manifest(docs, ["doc_id", "source", "lang", "n_chars", "text"],
                                   F.when(hit, ascii_lower(F.col("text"))))
    folded = merkle.fold(F.coalesce("changed_leaf", "leaf"), F.col("proof"))
    return out.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("proof")).alias("proof_sha256"),
                      folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_repair_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair_conversations(repair.damage(read_table(spark, sf_dir, "conversations"))).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_ngram_join, op2_pattern_packing, op3_secret_scan, op4_substring_dedup, op5_url_filter, op6_token_fertility, op7_chat_trees, op8_balanced_shards, op9_decontaminate, op10_fuzzy_lines,
                               op11_licence_scan, op12_merkle_manifest, op13_repair_conversations)}

ORACLES: dict[str, str] = oracles.ORACLES
