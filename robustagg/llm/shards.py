"""Sharding by balanced label propagation (DataFrame functions only).

Documents with equal texts are linked (through a hub node per text, so a group
of n copies has n links, not n^2); more links can be given. Rows start on
shards dealt evenly by a hash. In each round every linked row votes for its hub
and the hub moves to the shard with most votes; a linked row then wants its
hub's shard. Shards with room for the whole hub go before others. Moves into a
shard are admitted up to its free quota, by rank; unlinked rows do not count
against it, since they give way at no cost.
At the end rows move from shards over their quota to shards under it, unlinked
rows first. Law ``rows``: counts differ by one at most. A group of copies larger
than a shard becomes hubs of a whole shard's rows and one of the rest, so that it
spans as few shards as it can.

Ranks never go through one window: rows are counted per (key, bucket of a
hash), the counts become offsets, and only rows of one bucket are numbered
together. Hubs of more than ``bucket_rows`` rows have several buckets of their own.

Defined cases: a null text has size 1 (no bytes), crc of the empty string, and
is linked with nothing; empty texts are equal texts, whatever their length;
repeated rows are separate rows (told apart by their order in a bucket); rows
that share a doc_id share its hubs; rows without a doc_id are linked with
nothing; other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut


def ranked(df: DataFrame, keys: list[str], order: list[str], bucket_rows: int, name: str = "rank",
           bucket: str = "_bucket") -> DataFrame:
    """0-based gapless rank inside ``keys``, by bucket then ``order``. ``bucket``
    is an existing column of buckets, equal for rows that must stay together."""
    sizes = df.groupBy(*keys, bucket).agg(F.count(F.lit(1)).alias("_n"))
    before = (F.sum("_n").over(Window.partitionBy(*keys).orderBy(bucket)
                               .rowsBetween(Window.unboundedPreceding, -1)))
    offsets = sizes.withColumn("_off", F.coalesce(before, F.lit(0))).drop("_n")
    inside = Window.partitionBy(*keys, bucket).orderBy(*order)
    return (df.withColumn("_r", F.row_number().over(inside)).join(offsets, [*keys, bucket])
            .withColumn(name, F.col("_off") + F.col("_r") - 1).drop("_off", "_r"))


def _plurality(votes: DataFrame, key: str, fits: Column | None = None) -> DataFrame:
    """(key, want): the shard with most votes, those that fit first; ties go by a hash of key and shard."""
    order = F.struct(F.lit(True) if fits is None else fits, "n", F.xxhash64(key, "shard"))
    return (votes.groupBy(key, "shard").agg(F.count(F.lit(1)).alias("n"), F.max("hub_rows").alias("hub_rows"))
            .groupBy(key).agg(F.max_by("shard", order).alias("want")))


def text_hubs(rows: DataFrame, n: int, shards: int) -> DataFrame:
    """(doc_id, hub, hub_rows) of documents whose text occurs more than once. A
    group larger than a shard is cut by a hash of doc_id into whole shards and the rest."""
    quota = max(2, n // shards)
    groups = (rows.where("text_key is not null and doc_id is not null").groupBy("text_key")
              .agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    part = F.expr(f"cast(pmod(xxhash64(doc_id), n) div {quota} as int)")
    return (rows.select("doc_id", "text_key").distinct().join(groups, "text_key").withColumn("part", part)
            .select("doc_id", F.concat_ws("/", "text_key", "part").alias("hub"),
                    F.least(F.lit(quota), F.col("n") - F.col("part") * quota).alias("hub_rows")))


def balanced_shards(docs: DataFrame, shards: int = 16, links: DataFrame | None = None, rounds: int = 3,
                    slack: float = 0.25, bucket_rows: int = 100_000) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, hubs (number of the row's hubs).

    ``links``: more links (a, b) between doc_ids; each is a hub of its two ends.
    ``slack``: how far a shard may be over its quota while labels move.
    """
    text = F.coalesce("text", F.lit(""))
    rows = cut(docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
                           F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
                           F.sha2(F.encode("text", "UTF-8"), 256).alias("text_key")))
    n = rows.count()
    buckets = max(1, -(-n // (bucket_rows * shards)))
    members = text_hubs(rows, n, shards)
    if links is not None:
        hub = F.concat_ws("-", F.lit("link"), F.least("a", "b"), F.greatest("a", "b"))
        members = members.unionByName(
            links.where("a <> b").select(F.explode(F.array("a", "b")).alias("doc_id"), hub.alias("hub"),
                                         F.lit(2).cast("long").alias("hub_rows")).distinct())
    members = cut(members)
    lead = members.groupBy("doc_id").agg(F.count(F.lit(1)).alias("hubs"), F.min(F.struct("hub", "hub_rows")).alias("lead")) \
        .select("doc_id", "hubs", "lead.*")
    spread = F.expr(f"pmod(xxhash64(doc_id, 7), {buckets * shards})")
    state = (rows.drop("text_key").join(lead, "doc_id", "left").fillna(0, ["hubs"])
             .withColumn("_all", F.lit(0)).withColumn("_bucket", spread))
    state = cut(ranked(state, ["_all"], ["doc_id", "text_crc32", "size"], bucket_rows, "rank")
                .withColumn("shard", F.expr(f"cast(rank % {shards} as int)")).drop("rank", "_bucket"))

    # Small hubs share buckets; a large one has several of its own, one behind the other.
    large = F.col("hub_rows") > bucket_rows
    linked_bucket = F.struct(
        F.expr(f"pmod(xxhash64(hub, 11), {buckets})").alias("no"), F.when(large, F.col("hub")).otherwise("").alias("hub"),
        F.when(large, F.pmod(F.xxhash64("doc_id", F.lit(17)), F.ceil(F.col("hub_rows") / bucket_rows))).otherwise(0).alias("part"))
    for _ in range(rounds):
        counts = dict(state.where("hubs > 0").groupBy("shard").count().collect())  # one row per shard
        room = [max(0, int((1 + slack) * n / shards) + 1 - counts.get(s, 0)) for s in range(shards)]
        here = members.join(state.select("doc_id", "shard"), "doc_id")
        fits = F.col("hub_rows") - F.col("n") <= F.element_at(F.array(*map(F.lit, room)), F.col("shard") + 1)
        hubs = _plurality(here, "hub", fits).withColumnRenamed("want", "shard")
        want = _plurality(members.join(hubs, "hub"), "doc_id")
        moving = state.join(want, "doc_id", "left").withColumn("_bucket", linked_bucket)
        movers = ranked(moving.where("want <> shard"), ["want"], ["hub", "doc_id", "text_crc32"], bucket_rows)
        moved = movers.withColumn("shard", F.when(F.col("rank") < F.element_at(
            F.array(*map(F.lit, room)), F.col("want") + 1), F.col("want")).otherwise(F.col("shard")))
        stay = moving.where("want is null or want = shard")
        state = cut(stay.select(*state.columns).unionByName(moved.select(*state.columns)))

    counts = dict(state.groupBy("shard").count().collect())
    quota = [n // shards + (s < n % shards) for s in range(shards)]
    ends, total = [], 0
    for s in range(shards):
        total += max(0, quota[s] - counts.get(s, 0))
        ends.append(total)
    pick = lambda values: F.element_at(F.array(*map(F.lit, values)), F.col("shard") + 1)
    alone = F.struct((buckets + F.expr(f"pmod(xxhash64(doc_id, 13), {buckets})")).alias("no"), F.lit("").alias("hub"),
                     F.lit(0).cast("long").alias("part"))
    by_link = F.when(F.col("hubs") > 0, linked_bucket).otherwise(alone)
    order = ["hub", "doc_id", "text_crc32", "size"]
    placed = cut(ranked(state.withColumn("_bucket", by_link), ["shard"], order, bucket_rows, "rank"))
    over = ranked(placed.where(F.col("rank") >= pick(quota)).drop("rank"), ["_all"], ["shard", *order], bucket_rows)
    over = over.withColumn("shard", F.size(F.filter(F.array(*map(F.lit, ends)), lambda e: e <= F.col("rank"))))
    final = placed.where(F.col("rank") < pick(quota)).select(*state.columns, "_bucket") \
        .unionByName(over.select(*state.columns, "_bucket"))
    return ranked(final, ["shard"], order, bucket_rows, "slot").select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), F.col("hubs").cast("long").alias("hubs"))
