"""Distance expressions over ``array<double>`` columns.

All built from Spark's higher-order functions: they stay in the JVM but are
interpreted per element, so passes over all points use the Arrow kernels of
``robustagg.operators.balls`` instead. Squared differences are summed in
coordinate order starting from 0.0; every other engine used to check results
(DuckDB's ``list_distance``, numpy column loops in the farthest-first
traversal) sums in the same order, so equal inputs give bit-equal distances
and ties break identically.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sqdist(a: Column, b: Column) -> Column:
    """Squared Euclidean distance. Arrays of unequal length give null: check a
    common dimension before relying on it."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)),
                       F.lit(0.0), lambda acc, v: acc + v)


def euclidean(a: Column, b: Column) -> Column:
    return F.sqrt(sqdist(a, b))


def euclidean_sql(a: str, b: str) -> str:
    """``euclidean`` as SQL text over two column names (one JVM-side parse
    instead of building the lambdas call by call)."""
    return (f"sqrt(aggregate(zip_with({a}, {b}, (x, y) -> (x - y) * (x - y)), 0D, "
            f"(acc, v) -> acc + v))")


def nearest(point: Column, center_features: Column, center_ids: Column) -> Column:
    """``struct(distance, center)`` of the closest center.

    ``center_features`` is an ``array<array<double>>`` and ``center_ids`` the
    parallel array of ids, both usually literals or a broadcast row. The
    minimum is taken over ``(distance, position)``, so ties go to the center
    listed first.
    """
    return F.array_min(F.transform(
        center_features,
        lambda c, i: F.struct(euclidean(point, c).alias("distance"),
                              i.alias("pos")))).alias("nearest")


def nearest_with_id(point: Column, center_features: Column, center_ids: Column) -> Column:
    n = nearest(point, center_features, center_ids)
    return F.struct(n["distance"].alias("distance"),
                    F.element_at(center_ids, n["pos"] + 1).alias("center_id"))
