"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import shutil
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from robustagg.session import ensure_checkpoint_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package (once per application), so that the Arrow
    functions can be imported there, with their per-worker tables."""
    context = spark.sparkContext
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if context.applicationId in _SHIPPED or not os.path.isdir(package):
        return
    folder = os.path.realpath(tempfile.mkdtemp(prefix="package-"))
    name = os.path.basename(package)
    context.addPyFile(shutil.make_archive(os.path.join(folder, name), "zip", os.path.dirname(package), name))
    _SHIPPED.add(context.applicationId)


def ascii_lower(col: Column) -> Column:
    """A-Z only, as the contracts ask (``lower`` also maps other scripts)."""
    return F.translate(col, UPPER, LOWER)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Inside, a query's shuffle files go when it ends. Else they stay until the
    driver happens to collect its garbage, and a long job keeps those of all its queries."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


_MADE = threading.local()  # .lists: for each ``settled`` that runs, the tables made in it


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` as a Parquet table in the cluster's checkpoint folder and go
    on from there: the lineage ends, and a lost executor costs a read. (Columns
    pack better than the rows of ``checkpoint()``, and only the columns asked
    for are read back.)"""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/table-{uuid.uuid4()}"
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.cut_path = path
    for tables in getattr(_MADE, "lists", []):
        tables.append(table)
    return table


def drop(*tables: DataFrame) -> None:
    """Delete tables of ``cut`` that nothing will read any more."""
    for table in tables:
        context = table.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(table.cut_path)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def settled(make: Callable[[], DataFrame]) -> DataFrame:
    """The result of ``make`` as a table of ``cut``; the tables cut on the way to it are deleted."""
    lists = _MADE.__dict__.setdefault("lists", [])
    lists.append(made := [])
    try:
        result = cut(make())
    finally:
        lists.pop()
    drop(*(table for table in made if table is not result))
    return result


def _star_step(edges: DataFrame, large: bool) -> DataFrame:
    """One half step over edges (u > v). Large: every larger neighbour of u
    moves to u's smallest neighbour. Small: u and its smaller neighbours do."""
    both = edges if not large else edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m"))
    moved = both.join(low, "u")
    if large:
        moved = moved.where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
    else:
        moved = moved.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .unionByName(low.select("u", F.col("m").alias("v")))
    return moved.where("u <> v").distinct()


def components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """Connected components of ``edges`` (a, b; any orderable type).

    Alternating large-star and small-star steps, each a pre-aggregated minimum
    and a join, until the edges form stars around the smallest id; O(log n)
    rounds, state checkpointed each round. Returns (id, component) for every id
    on an edge between different ids. Nulls and self-links are ignored.
    """
    ensure_checkpoint_dir(edges.sparkSession)
    with shuffles_dropped(edges.sparkSession):
        return _components(edges, max_rounds)


def _components(edges: DataFrame, max_rounds: int) -> DataFrame:
    state = (edges.where("a is not null and b is not null and a <> b")
                .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct().checkpoint())
    mark = F.struct(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")))
    seen = state.agg(mark).first()[0]
    for _ in range(max_rounds):
        if seen[0] == 0:
            break
        state = _star_step(_star_step(state, True), False).checkpoint()
        now = state.agg(mark).first()[0]
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return state.select(F.col("u").alias("id"), F.col("v").alias("component")) \
        .unionByName(state.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
