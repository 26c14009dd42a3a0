"""Secret scan with corpus-wide ownership frequency (DataFrame functions only).

Base spans per kind come from one pattern each: the text is split at the
pattern and the matches are extracted; the running lengths of pieces and matches
are the positions, in one linear pass each (code points).

Method: every candidate value is hashed, and hashes are aggregated by distinct
repositories and owners over the whole corpus. A value that occurs with many
owners is a widely copied example; one that stays with a single owner and in
few repositories is owner-specific. Base spans always stay (each with its
verdict); high-entropy looking tokens outside base spans (``token``: a run of
20+ characters of ``[A-Za-z0-9+/_=-]`` with a digit, a lower-case and an
upper-case letter) are added as spans only when owner-specific.

Counting is skew-proof: distinct (hash, owner, repository) first, counts of
repositories per (hash, owner) next, then per hash, all with map-side partial
aggregation; the join back is an equi-join that Spark may split.

Defined cases: null text is empty; a null owner or repository counts as one
owner or repository of its own; repeated rows are separate rows; an empty table
gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

# Pattern, group that holds the value, and least length of the match or value.
KINDS = {
    "assign": (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    "access": (r"AKIA[A-Z0-9]+", 0, 16),
    # A run of [0-9a-f] with 32 or more characters is the same span as the run [0-9a-f]+ kept when it has 32.
    "hex": (r"[0-9a-f]{32,}", 0, 32),
    "token": (r"[A-Za-z0-9+/_=-]{20,}", 0, 20),
}
BASE = ("assign", "access", "hex")


def pieces_of(text: Column, kind: str) -> Column:
    """array<struct(gap, size, value)> of the pattern's matches: code points
    between the last match and this one, code points of the match, and its value."""
    pattern, group, _ = KINDS[kind]
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else matches
    gaps = F.slice(F.split(text, pattern, -1), 1, F.size(matches))  # one gap more than matches
    sized = F.zip_with(gaps, matches, lambda g, m: F.struct(F.char_length(g).alias("gap"),
                                                            F.char_length(m).alias("size")))
    return F.zip_with(sized, values, lambda p, v: F.struct(p["gap"].alias("gap"), p["size"].alias("size"),
                                                           v.alias("value")))


def find_spans(docs: DataFrame) -> DataFrame:
    """One row per span: _rid, kind, kind_no, start, end, hash, owner, repository."""
    rows = None
    for no, kind in enumerate(KINDS):
        pieces = (docs.select("_rid", "_owner", "_repository", F.posexplode(f"_{kind}").alias("i", "p"))
                  .select("_rid", "_owner", "_repository", F.lit(kind).alias("kind"), F.lit(no).alias("kind_no"), "i",
                          "p.*"))
        rows = pieces if rows is None else rows.unionByName(pieces)
    so_far = Window.partitionBy("_rid", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    rows = (rows.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(so_far))
            .withColumn("start", F.col("end") - F.col("size")))
    long_enough = F.lit(False)
    for kind, (_, _, least) in KINDS.items():
        long_enough = long_enough | ((F.col("kind") == kind) & (F.char_length("value") >= least))
    looks_live = (F.col("kind") != "token") | (F.col("value").rlike("[0-9]") & F.col("value").rlike("[a-z]")
                                               & F.col("value").rlike("[A-Z]"))
    rows = rows.where(long_enough & looks_live)
    by_start = Window.partitionBy("_rid").orderBy("start", "end", "kind_no")
    base = F.col("kind") != "token"
    reach = F.max(F.when(base, F.col("end"))).over(by_start.rowsBetween(Window.unboundedPreceding, 0))
    ahead = F.min(F.when(base, F.col("start"))).over(by_start.rowsBetween(0, Window.unboundedFollowing))
    rows = rows.withColumn("_reach", reach).withColumn("_ahead", ahead)
    clear = base | ((F.coalesce("_reach", F.lit(0)) <= F.col("start"))
                    & (F.col("_ahead").isNull() | (F.col("_ahead") >= F.col("end"))))
    return rows.where(clear).select("_rid", "_owner", "_repository", "kind", "kind_no", "start", "end",
                                    F.sha2("value", 256).alias("hash"))


def ownership(spans: DataFrame) -> DataFrame:
    """(hash, n_owners, n_repositories) over the whole corpus."""
    return (spans.select("hash", "_owner", "_repository").distinct()
            .groupBy("hash", "_owner").agg(F.count(F.lit(1)).alias("r"))
            .groupBy("hash").agg(F.count(F.lit(1)).alias("n_owners"), F.sum("r").alias("n_repositories")))


def scan_secrets(docs: DataFrame, owner: str = "source", repository: str = "doc_id", max_owners: int = 1,
                 max_repositories: int = 3) -> DataFrame:
    """Per row: doc_id, spans array<struct(start, kind_no, end, kind, hash, n_owners,
    n_repositories, specific)> by start, then kind. Base kinds all stay;
    ``token`` spans only when owner-specific (``specific``)."""
    text = F.coalesce("text", F.lit(""))
    found = cut(docs.select(F.monotonically_increasing_id().alias("_rid"), "doc_id",
                            F.coalesce(F.col(owner).cast("string"), F.lit("")).alias("_owner"),
                            F.coalesce(F.col(repository).cast("string"), F.lit("")).alias("_repository"),
                            *(pieces_of(text, kind).alias(f"_{kind}") for kind in KINDS)))
    spans = cut(find_spans(found))
    specific = (F.col("n_owners") <= max_owners) & (F.col("n_repositories") <= max_repositories)
    judged = spans.join(ownership(spans), "hash").withColumn("specific", specific)
    per_row = (judged.where("specific or kind <> 'token'").groupBy("_rid").agg(F.sort_array(F.collect_list(F.struct(
        "start", "kind_no", "end", "kind", "hash", "n_owners", "n_repositories", "specific"))).alias("spans")))
    empty = F.array().cast(per_row.schema["spans"].dataType)
    return found.select("_rid", "doc_id").join(per_row, "_rid", "left").select(
        "doc_id", F.coalesce("spans", empty).alias("spans"))


def span_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
