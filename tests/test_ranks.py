import random

from pyspark.sql import functions as F

from robustagg.operators.ranks import with_rank


def test_rank_over_everything(spark):
    ids = [i * 8 - 400 for i in range(500)]
    random.Random(1).shuffle(ids)
    df = spark.createDataFrame([(i,) for i in ids], "id long").repartition(7)
    got = {r["id"]: r["rank"] for r in with_rank(df, ["id"]).collect()}
    assert got == {i: k for k, i in enumerate(sorted(ids))}


def test_rank_within_groups_nulls_ties_and_clashing_names(spark):
    r = random.Random(2)
    rows = [(r.choice([None, "a", "b"]), r.choice([None, 1, 2, 3]), i, "x") for i in range(300)]
    rows += [("a", 1, 7, "x")] * 40
    df = spark.createDataFrame(rows, "g string, v int, __at long, rank string").repartition(5)
    out = with_rank(df, ["v"], by=["g"]).collect()
    assert len(out) == len(rows) and set(out[0].asDict()) == {"g", "v", "__at", "rank"}
    for g in ("a", "b", None):
        mine = sorted((x for x in out if x["g"] == g), key=lambda x: x["rank"])
        assert [x["rank"] for x in mine] == list(range(len(mine)))
        vs = [-1 if x["v"] is None else x["v"] for x in mine]
        assert vs == sorted(vs)


def test_rank_of_nothing_and_of_a_skewed_group(spark):
    assert with_rank(spark.createDataFrame([], "id long"), ["id"]).collect() == []
    df = spark.range(4000).select(F.when(F.col("id") < 3900, 0).otherwise(F.col("id")).alias("g"), "id").repartition(8)
    got = with_rank(df, ["id"], by=["g"]).where("g = 0")
    assert got.where("rank <> id").count() == 0 and got.count() == 3900
