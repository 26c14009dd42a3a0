"""Fuzzy line dedup by MinHash.

Lines are what ``\\n`` separates; lines without a word are left alone. Equal
lines are one from the start (128 bits of hash). A line's shingles are all its
character runs of ``K`` (a shorter line is one shingle); similarity is the exact
Jaccard of these sets.

Signature: ``HASHES`` MinHash values of 16 bits over runs of ``RUN`` bytes of the
line's UTF-8 form (in ASCII the shingles themselves). The values are those of one
hash in ``BANDS`` turned orders: in each the first ``ROWS`` from a further mark on, in a
circle. A line is signed over the runs that begin with one of the bytes ``BEGIN``
(about one in six, chosen by content, so that equal runs are chosen in every line);
one with fewer than ``MANY`` distinct ones of these is signed over all its runs, one
with ``SOME`` to ``MANY`` in both ways. Bands are the ``ROWS`` values of one order. Lines of a
band bucket of up to ``SMALL`` lines are all paired, those of a larger one with the
``SMALL`` lines before them (in the order of a further value) that share most
values and with the first; pairs whose values are less similar than ``AGREE`` are left
out. Pairs are verified over their whole sets. Lines of larger buckets then take an
exact way together: each is listed under its rarest shingles (prefix filter, so that
every linked pair shares a list), and all pairs of a list that sizes and places
allow, and that are not united already, are verified. Linked lines are united
(connected components). One line of each component stays: the first by (doc_id,
line number).

Defined cases: null text has no lines and stays null; an empty text or a blank
line is kept; rows with the same doc_id are one document here (equal lines at
equal places share their fate); rows with a null doc_id lose nothing; texts and
lines of any length are read whole; an empty table gives no rows; other columns
stay, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from robustagg.sources.store import free_name

from .common import components, cut, drop, settled

K = 8
RUN = 8  # bytes
BANDS, ROWS = 6, 3
HASHES = BANDS * ROWS
AGREE = 0.38
SMALL, CLOSE = 16, 12  # lines of a bucket compared in full; of a larger one, those before each that are
SOME, MANY = 24, 40  # distinct chosen runs from which on they sign a line, and from which on alone
WORD = r"[^\x20\x09-\x0D]"
BEGIN = "[aeAE16%/=|" + "".join(f"\\x{b:02X}" for b in range(0x80, 0x100) if b % 6 == 0) + "]"
_MARKS = [-(1 << 31) + (j << 32) // BANDS for j in range(BANDS)]


def distinct_lines(signed: DataFrame) -> DataFrame:
    """(h1, h2, doc_id, line_no, copies, whole, part): the first (doc_id, line_no) of each text of ``signatures``."""
    return signed.groupBy("h1", "h2").agg(
        F.min(F.struct("doc_id", "line_no")).alias("id"), F.count(F.lit(1)).alias("copies"),
        F.first("whole").alias("whole"), F.first("part").alias("part")).select("h1", "h2", "id.*", "copies", "whole", "part")


def _runs(text: Column, size: int, begin: str = ".") -> Column:
    """All runs of ``size`` characters that begin with one of ``begin``."""
    return F.regexp_extract_all(text, F.lit(f"(?s)(?=({begin}.{{{size - 1}}}))"), F.lit(1))


def _values(hashes: str) -> Column:
    """The ``HASHES`` MinHash values of a set: of its ordered hashes (twice over, ``<hashes>_circle``) the first from each
    mark on. ``<hashes>_marked`` has the marks among them, so that a mark's place tells how many are below it."""
    at = lambda j: F.array_position(f"{hashes}_marked", F.lit(_MARKS[j])).cast("int") - F.lit(j)
    return F.when(F.col(hashes).isNotNull(), F.concat(*(F.slice(f"{hashes}_circle", at(j), ROWS) for j in range(BANDS))))


def _worded(docs: DataFrame) -> DataFrame:
    """(doc_id, line_no, h1, h2, line) of all lines with a word, with 128 bits of hash."""
    lines = (docs.where("doc_id is not null and text is not null")
             .select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line")).where(F.col("line").rlike(WORD)))
    return lines.select("doc_id", "line_no", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"), "line")


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, line_no, h1, h2, whole, part) of all lines with a word: 128 bits of hash and
    the ``HASHES`` MinHash values over all runs and over the chosen ones (null if not used)."""
    # One character for each byte.
    text = F.when(F.octet_length("line") == F.char_length("line"), F.col("line")).otherwise(
        F.decode(F.col("line").cast("binary"), "ISO-8859-1"))
    hashed = lambda runs: F.sort_array(F.array_distinct(F.transform(runs, lambda g: F.hash(g))))
    every = F.when(F.char_length("text") < RUN, F.array(F.hash("text"))).otherwise(hashed(_runs(F.col("text"), RUN)))
    marked = lambda hashes: F.sort_array(F.concat(F.array(*map(F.lit, _MARKS)), F.col(hashes))).alias(f"{hashes}_marked")
    names = ["doc_id", "line_no", "h1", "h2"]
    sets = (_worded(docs).select(*names, text.alias("text"))
            .select(*names, "text", hashed(_runs(F.col("text"), RUN, BEGIN)).alias("chosen"))
            .select(*names, F.when(F.size("chosen") < MANY, every).alias("all"),
                    F.when(F.size("chosen") >= SOME, F.col("chosen")).alias("chosen")))
    circle = lambda hashes: F.concat(hashes, *[F.slice(hashes, 1, ROWS)] * ROWS).alias(f"{hashes}_circle")
    # The upper bits of a value are near its mark's: the lower ones are kept.
    low = lambda values: F.transform(values, lambda x: (x % (1 << 15)).cast("short")).alias(values)
    return (sets.select(*names, *(f(hashes) for hashes in ("all", "chosen") for f in (F.col, marked, circle)))
            .select(*names, _values("all").alias("whole"), _values("chosen").alias("part"))
            .select(*names, low("whole"), low("part")))


def _chosen_lines(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(v, line) of the ``wanted`` (v, doc_id, line_no)."""
    per_doc = wanted.groupBy("doc_id").agg(F.collect_set(F.struct("line_no", "v")).alias("wanted"))
    return (docs.select("doc_id", "text").join(per_doc.hint("shuffle_hash"), "doc_id")
            .select(F.split("text", "\n").alias("lines"), F.inline("wanted").alias("line_no", "v"))
            .select("v", F.get("lines", F.col("line_no")).alias("line")).where("line is not null"))


def _shingles(line: Column) -> Column:
    """All character runs of ``K``; a shorter line is one."""
    return F.when(F.char_length(line) < K, F.array(line)).otherwise(_runs(line, K))


def _shingle_set(line: Column) -> Column:
    """All character runs of ``K`` as a set of 32-bit hashes."""
    return F.array_distinct(F.transform(_shingles(line), lambda g: F.hash(g)))


def _candidates(signed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs (v, w) of line numbers from band buckets, v the one to compare with,
    and the lines (v) of buckets that are too large to be compared in full, as tables.
    ``signed``: v, whole, part."""
    def keys(way: str) -> Column:
        bin_of = lambda i: F.get(way, F.lit(i % HASHES))
        keyed = F.array(*(F.struct(F.xxhash64(F.lit(way), F.lit(k), *(bin_of(k + j) for j in range(ROWS))).alias("key"),
                                   bin_of(k + ROWS).alias("next")) for k in range(0, HASHES, ROWS)))
        return F.when(F.col(way).isNotNull(), keyed).otherwise(F.array().cast("array<struct<key:bigint,next:smallint>>"))
    rows = signed.select("v", F.inline(F.concat(keys("whole"), keys("part"))))
    # Most keys have one line: they are counted away before anything is sorted.
    often = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    rows = kept = cut(rows.join(often.hint("shuffle_hash"), "key"))
    large = rows.where(F.col("n") > SMALL).select("v").distinct()
    rows = rows.join(signed.hint("merge"), "v")
    bucket, line = Window.partitionBy("key").orderBy("next", "v"), F.struct("v", "whole", "part")
    rows = rows.select(*rows.columns, F.collect_list(line).over(bucket.rowsBetween(-SMALL, -1)).alias("near"),
                       F.first(line).over(bucket).alias("head"))
    same = lambda x, way: F.coalesce(F.size(F.array_intersect(way, x[way])) / F.size(F.array_union(way, x[way])), F.lit(0.0))
    agreed = lambda x: F.greatest(same(x, "whole"), same(x, "part"))
    others = F.filter(F.transform("near", lambda x: F.struct((-agreed(x)).alias("by"), x["v"].alias("w"))),
                      lambda x: x["by"] <= -AGREE)
    best = F.slice(F.sort_array(others), 1, F.when(F.col("n") <= SMALL, SMALL).otherwise(CLOSE))
    head = F.when((F.col("head")["v"] != F.col("v")) & (agreed(F.col("head")) >= AGREE), F.array(F.col("head")["v"]))
    pairs = rows.select("v", F.explode(F.array_distinct(F.concat(
        F.transform(best, lambda x: x["w"]), F.coalesce(head, F.array().cast("array<long>"))))).alias("w"))
    pairs = cut(pairs.select(F.greatest("v", "w").alias("w"), F.least("v", "w").alias("v")).distinct())
    large = cut(large)
    drop(kept)
    return pairs, large


def _similar(a: Column, b: Column, threshold: float) -> Column:
    """Whether two sets are so similar. Bound as lambda variables, each set and the
    intersection are computed once, wherever the optimizer moves the test."""
    enough = lambda x, y: F.exists(F.array(F.size(F.array_intersect(x, y))),
                                   lambda n: n >= threshold * (F.size(x) + F.size(y) - n))
    return F.exists(F.array(b), lambda y: enough(a, y))


def _verified(both: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose texts have sets of a Jaccard similarity of at least ``threshold``."""
    runs = lambda text: F.transform(_shingles(F.col(text)), lambda g: F.xxhash64(g))
    # Made in a generator, the runs of a text are listed once.
    listed = both.select("a", "b", F.inline(F.array(F.struct(runs("text_a").alias("ra"), runs("text_b").alias("rb")))))
    return listed.where(F.size(F.array_intersect("ra", "rb")) >= threshold * F.size(F.array_union("ra", "rb"))).select("a", "b")


def _hot_links(hot: DataFrame, united: DataFrame, threshold: float) -> DataFrame:
    """All links (a, b) between the ``hot`` lines (v, s) that ``united`` (v, class) leaves apart, as a table."""
    classes = united.withColumnRenamed("class", "c")
    shingles = hot.join(classes, "v", "left").select("v", F.coalesce("c", "v").alias("c"), F.size("s").alias("n"), F.explode("s").alias("h"))
    mixed = (shingles.groupBy("h").agg(F.count(F.lit(1)).alias("often"), F.min("c").alias("low"), F.max("c").alias("high"))
             .where("low < high").select("h", "often"))
    # Any one order of the shingles is right; with the rare ones first the lists are short.
    # First are those of one class only: no pair to be found shares them, so they are only counted.
    line = Window.partitionBy("v")
    lists = (shingles.join(mixed.hint("shuffle_hash"), "h")
             .select("v", "c", "n", "h", F.row_number().over(line.orderBy("often", "h")).alias("place"), F.count(F.lit(1)).over(line).alias("m"))
             .select("v", "c", "n", "h", (F.col("n") - F.col("m") + F.col("place") - 1).cast("int").alias("at"))
             .where(F.col("at") <= F.col("n") - F.ceil(threshold * F.col("n") - 1e-9)))
    lists = cut(lists)
    a, b = (lists.select("h", *(F.col(x).alias(f"{x}_{side}") for x in ("v", "c", "n", "at"))) for side in "ab")
    small, large = F.least("n_a", "n_b"), F.greatest("n_a", "n_b")
    # What a pair shares lies at or behind the first shingle that both lists of it have.
    most = F.least(F.col("n_a") - F.col("at_a"), F.col("n_b") - F.col("at_b"))
    fits = (small >= threshold * large - 1e-9) & ((1 + threshold) * most >= threshold * (F.col("n_a") + F.col("n_b")) - 1e-6)
    pairs = a.join(b, (a["h"] == b["h"]) & (F.col("c_a") < F.col("c_b")) & fits).select("v_a", "v_b").distinct()
    end = lambda side: hot.select(F.col("v").alias(f"v_{side}"), F.col("s").alias(f"s{side}"))
    more = cut(pairs.join(end("a"), "v_a").join(end("b"), "v_b").where(_similar(F.col("sa"), F.col("sb"), threshold)).select(
        F.col("v_a").alias("a"), F.col("v_b").alias("b")))
    drop(lists)
    return more


def line_classes(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """(doc_id, line_no, class_doc_id, class_line_no) of all lines with a word:
    the class of a line is named by its first line, the one that is kept."""
    texts = docs.select("doc_id", "text")
    # Distinct lines get 64-bit numbers; only numbers travel from here to the links.
    signed = cut(distinct_lines(signatures(docs)).withColumn("v", F.monotonically_increasing_id()))
    distinct = cut(signed.drop("whole", "part"))
    pairs, large = _candidates(signed.select("v", "whole", "part"))
    drop(signed)
    ends = pairs.select(F.col("v")).unionByName(pairs.select(F.col("w").alias("v"))).distinct()
    lines = cut(_chosen_lines(texts, ends.unionByName(large).distinct().join(distinct, "v").select("v", "doc_id", "line_no")))
    ends = [lines.select(F.col("v").alias(v), F.col("line").alias(text)) for v, text in (("v", "text_a"), ("w", "text_b"))]
    both = pairs.join(ends[0], "v").join(ends[1], "w").select(F.col("v").alias("a"), F.col("w").alias("b"), "text_a", "text_b")
    links = cut(_verified(both, threshold))
    drop(pairs)
    united = components(links)
    drop(links)
    if not large.isEmpty():
        hot = cut(lines.join(large, "v", "left_semi").select("v", _shingle_set(F.col("line")).alias("s")))
        more = _hot_links(hot, united.select(F.col("id").alias("v"), F.col("component").alias("class")), threshold)
        drop(hot)
        if not more.isEmpty():
            united = components(united.select(F.col("id").alias("a"), F.col("component").alias("b")).unionByName(more))
        drop(more)
    drop(lines, large)
    # Classes are named by their first line; a line that is alone names its own.
    members = distinct.join(united.withColumnRenamed("id", "v"), "v", "left").where("component is not null or copies > 1").select(
        "h1", "h2", F.struct("doc_id", "line_no").alias("id"), F.coalesce("component", "v").alias("component"))
    named = members.join(members.groupBy("component").agg(F.min("id").alias("class")), "component").select("h1", "h2", "class")
    # Equal rows fall together where the join left them, without another exchange.
    return _worded(docs).drop("line").join(named.hint("shuffle_hash"), ["h1", "h2"], "left").select(
        "h1", "h2", "doc_id", "line_no", F.coalesce("class.doc_id", "doc_id").alias("class_doc_id"),
        F.coalesce("class.line_no", "line_no").alias("class_line_no")).distinct().drop("h1", "h2")


def dedup_lines(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """docs without the lines that a kept line stands for; a document that loses
    all its lines with a word goes."""
    lost, every = free_name(docs, "lost"), free_name(docs, "every")
    other = (F.col("doc_id") != F.col("class_doc_id")) | (F.col("line_no") != F.col("class_line_no"))
    gone = settled(lambda: line_classes(docs, threshold).withColumn("gone", other).groupBy("doc_id").agg(
        F.map_from_entries(F.collect_set(F.when(F.col("gone"), F.struct("line_no", F.lit(True))))).alias(lost),
        F.every("gone").alias(every)).where(F.cardinality(lost) > 0))
    kept = F.filter(F.split("text", "\n"), lambda line, i: ~F.coalesce(F.map_contains_key(lost, i), F.lit(False)))
    return (docs.join(gone, "doc_id", "left").where(F.col(every).isNull() | ~F.col(every))
            .withColumn("text", F.when(F.coalesce(F.cardinality(lost), F.lit(0)) == 0, F.col("text"))
                        .otherwise(F.array_join(kept, "\n")))
            .select(*docs.columns))
