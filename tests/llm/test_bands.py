"""The quality verdict against a plain computation of its bands, and on noise in every language."""

import math
import random
import string

import numpy as np
import pytest
from pyspark.sql import functions as F

from robustagg.llm import quality
from robustagg.llm.queries import tokenizer_path

SF = "/root/testdata/sf0.01"


def noise(lang, r, start):
    kinds = {"numbers": lambda: " ".join(str(r.randint(0, 10 ** r.randint(1, 9))) for _ in range(60)),
             "five digits": lambda: " ".join(str(r.randint(10_000, 99_999)) for _ in range(60)),
             "letters": lambda: " ".join("".join(r.choices(string.ascii_lowercase, k=5)) for _ in range(55))}
    return [(start + 10 * k + i, make(), lang, kind) for k, (kind, make) in enumerate(kinds.items()) for i in range(3)]


@pytest.fixture(scope="module")
def measured(spark):
    r = random.Random(12)
    extra = [x for n, lang in enumerate(("en", "de", "fr", "es")) for x in noise(lang, r, 10 ** 9 + 100 * n)]
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", F.lit("clean").alias("kind"))
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema)).repartition(8)
    return quality.cut(quality.measure_quality(docs, tokenizer_path("byte_bpe_50k.json"),
                                               tokenizer_path("piece_bpe_32k.model"), ["doc_id", "lang", "kind"]))


def share(values, q):
    return sorted(values)[max(0, math.ceil(q * len(values)) - 1)]


def plain_verdicts(rows, width=3.0, least=20):
    passed = [r for r in rows if r["n_words"] >= 50 and 100 * r["n_repeat_words"] <= 50 * r["n_words"]]
    for r in passed:
        r["x"] = math.log2(max(1, (r["word_chars"] + r["n_words"]) / r["chars_per_token"]))
        r["gap"] = max(0.0, r["x"] - r["token_entropy"])
    classes = {}
    for r in passed:
        classes.setdefault(math.floor(2 * r["x"]), []).append(math.floor(r["gap"] / 0.01))
    at = sorted(classes)
    curve = np.polyfit([(c + 0.5) / 2 for c in at], [(share(classes[c], 0.75) + 0.5) * 0.01 for c in at], 2,
                       w=[len(classes[c]) ** 0.5 for c in at])
    for r in passed:
        r["entropy_gap"] = r["gap"] / max(0.25, float(np.polyval(curve, r["x"])))
    kept = set()
    for lang in {r["lang"] for r in passed}:
        own = [r for r in passed if r["lang"] == lang]
        few = len(own) / (len(own) + least)
        out = dict.fromkeys((r["doc_id"] for r in own), 0.0)
        for m, step, below, above, relative in (("chars_per_token", 0.01, 0.16, 0.25, True), ("byte_share", 0.001, 0.03, 0.03, False),
                                                ("entropy_gap", 0.005, 0.28, 1.0, False)):
            bins = lambda some: [math.floor(r[m] / step) for r in some]  # noqa: B023, E731
            (q1, q3), (a1, a3) = ((share(bins(s), 0.25), share(bins(s), 0.75)) for s in (own, passed))
            low, high = (step * (q * few + a * (1 - few) + 0.5) for q, a in ((q1, a1), (q3, a3)))
            reach = width * step * (q3 - q1) * few * few
            below, above = max(reach, below * (low if relative else 1)), max(reach, above * (high if relative else 1))
            for r in own:
                out[r["doc_id"]] += max(0.0, (low - r[m]) / below, (r[m] - high) / above) ** 2
        kept |= {d for d, x in out.items() if x <= 1}
    return kept


def test_bands_are_the_plain_ones(measured):
    out = quality.judge(measured)
    rows = [r.asDict() for r in out.collect()]
    kept = {r["doc_id"] for r in rows if r["kept"]}
    assert kept == plain_verdicts([r for r in rows if not r["base_failed"]])
    salted = quality.judge(measured, broadcast_rows=0).where("kept").select("doc_id")
    assert {r.doc_id for r in salted.collect()} == kept
    clean = [r for r in rows if r["kind"] == "clean" and not r["base_failed"]]
    assert sum(not r["kept"] for r in clean) <= 0.01 * len(clean)
    for lang in ("en", "de", "fr", "es"):
        for kind in ("numbers", "five digits", "letters"):
            some = [r["kept"] for r in rows if r["lang"] == lang and r["kind"] == kind]
            assert len(some) == 3 and not any(some), (lang, kind)


def test_no_row_moves_to_its_language(measured):
    plan = quality.judge(measured)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
