"""Columnar tables in the cluster's checkpoint folder.

``stored`` writes a DataFrame once as Parquet and goes on from the files: the
lineage ends, a lost executor costs a read, and only the columns asked for are
read back. ``store_points`` does it for points and takes their count, dimension
and id range as metrics of that one write, so that no later step scans the
input again to learn them.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from robustagg.session import ensure_checkpoint_dir


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    name = f"__{base}"
    while name.lower() in taken:
        name += "_"
    return name


def new_path(df: DataFrame) -> str:
    return f"{ensure_checkpoint_dir(df.sparkSession)}/table-{uuid.uuid4()}"


def stored(df: DataFrame, folders: str | None = None) -> DataFrame:
    """``df`` written as a Parquet table in the checkpoint folder, read back.
    With ``folders`` (a column of few values) each value has a folder of its own,
    so a filter on it leaves the other files unread."""
    path = new_path(df)
    (df.write.partitionBy(folders) if folders else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def features_column() -> Column:
    """``features`` as ``array<double>``, whatever the numeric element type of the input."""
    return F.col("features").cast("array<double>").alias("features")


@dataclass(frozen=True)
class PointStats:
    n: int
    dim: int
    id_low: int | None
    id_high: int | None
    id_sum: int | None

    @property
    def dense(self) -> bool:
        """Ids that fill their range: the rank of a point is its id less the first."""
        return (self.n > 0 and self.id_high - self.id_low + 1 == self.n
                and 2 * self.id_sum == self.n * (self.id_low + self.id_high))


def point_metrics() -> list[Column]:
    x = F.col("features")
    bad = x.isNull() | F.exists(x, lambda v: v.isNull() | F.isnan(v))
    return [F.count(F.lit(1)).alias("n"), F.min(F.size("features")).alias("dim_low"),
            F.max(F.size("features")).alias("dim_high"), F.min("point_id").alias("id_low"),
            F.max("point_id").alias("id_high"), F.sum(F.col("point_id").cast("decimal(38,0)")).alias("id_sum"),
            F.count(F.when(F.col("point_id").isNull(), 1)).alias("no_id"),
            F.count(F.when(bad, 1)).alias("bad")]


def check_points(seen: dict) -> PointStats:
    """The statistics of ``point_metrics``; raises on points that no job takes."""
    if seen["bad"] or seen["no_id"]:
        raise ValueError(f"{seen['bad']} points without features or with a null or NaN coordinate, "
                         f"{seen['no_id']} without an id")
    if seen["n"] and seen["dim_low"] != seen["dim_high"]:
        raise ValueError(f"points of unequal dimension ({seen['dim_low']} and {seen['dim_high']})")
    return PointStats(seen["n"], seen["dim_high"] or 0, seen["id_low"], seen["id_high"],
                      None if seen["id_sum"] is None else int(seen["id_sum"]))


def store_points(points: DataFrame) -> tuple[DataFrame, PointStats]:
    """``(point_id, features)`` written once, and its statistics. Lines that do
    not parse fail here, as do points without an id or features, with a null or
    NaN coordinate, or of unequal dimension."""
    seen = Observation("points")
    table = stored(points.select(F.col("point_id").cast("long").alias("point_id"), features_column())
                   .observe(seen, *point_metrics()))
    return table, check_points(seen.get)
