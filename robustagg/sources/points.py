"""Point sources: ``(point_id bigint, features array<double>)``.

Text form: one point per line, comma-separated doubles, no header. The
reference identifies a point by its position in the file; here every point
carries an explicit ``point_id`` so that results do not depend on how the
input was split. Lines read from files are numbered by their position (file,
block start, row in the block), whatever the splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from robustagg.sources.tables import read_table

# How the test tables map onto points (see FIXTURES.md).
NATION_SCALE = 400.0


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, name)


def customer_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").cast("long").alias("point_id"),
                    F.array(F.col("c_acctbal").cast("double"),
                            F.col("c_nationkey") * F.lit(NATION_SCALE)).alias("features"))


def supplier_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _table(spark, sf_dir, "supplier")
    return s.select(F.col("s_suppkey").cast("long").alias("point_id"),
                    F.array(F.col("s_acctbal").cast("double"),
                            F.col("s_nationkey") * F.lit(NATION_SCALE)).alias("features"))


def embedding_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").cast("long").alias("point_id"),
                    F.col("embedding").cast("array<double>").alias("features"))


POINT_TABLES = {
    "customer": customer_points,
    "supplier": supplier_points,
    "embeddings": embedding_points,
}


def points_from_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return POINT_TABLES[table](spark, sf_dir)


def customer_point_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text form of the customer points, ``(point_id, value)``: coordinates
    printed with two decimals so any engine writes the same characters."""
    c = _table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").cast("long").alias("point_id"),
        F.concat_ws(",", F.format_string("%.2f", F.col("c_acctbal")),
                    F.format_string("%.2f", F.col("c_nationkey") * F.lit(NATION_SCALE))
                    ).alias("value"))


def parse_vector(value: Column) -> Column:
    """A comma-separated line to ``array<double>``; trailing empty fields are
    dropped first, any other bad token fails the job (ANSI cast)."""
    stripped = F.rtrim(value, F.lit(","))
    return F.transform(F.split(stripped, ","), lambda t: t.cast("double"))


def parse_points(lines: DataFrame, value_col: str = "value", id_col: str = "point_id") -> DataFrame:
    return lines.select(F.col(id_col).cast("long").alias("point_id"),
                        parse_vector(F.col(value_col)).alias("features"))


def read_point_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(point_id, value)``: the lines of the files under ``path``, numbered from
    0 in the order (file, position in the file). One row per file block is
    counted and summed up; a block's rows keep the reader's order."""
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"),
        F.monotonically_increasing_id().alias("at"))
    blocks = lines.groupBy("f", "b").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    before = Window.orderBy("f", "b").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("f", "b", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    return lines.join(starts, ["f", "b"]).select((F.col("at") + F.col("shift")).alias("point_id"), "value")


def read_points(spark: SparkSession, path: str) -> DataFrame:
    return parse_points(read_point_lines(spark, path))


def dimension(points: DataFrame) -> int:
    """Number of coordinates of one point (0 without points); all points must have as many."""
    first = points.select(F.size("features").alias("d")).first()
    return max(0, first["d"] or 0) if first else 0


def checked_features(dim: int) -> Column:
    """``features``, or a failed job where a point has none, a null or NaN
    coordinate, or a number of coordinates other than ``dim``."""
    x = F.col("features")
    bad = x.isNull() | (F.size(x) != dim) | F.exists(x, lambda v: v.isNull() | F.isnan(v))
    fail = F.raise_error(F.lit(f"a point has no features, a null or NaN coordinate, or a dimension other than {dim}"))
    return F.when(bad, fail.cast("array<double>")).otherwise(x).alias("features")
