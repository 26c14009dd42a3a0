"""Column expressions (no Python UDFs)."""

from robustagg.functions.distance import euclidean, nearest, nearest_with_id, sqdist

__all__ = ["euclidean", "nearest", "nearest_with_id", "sqdist"]
