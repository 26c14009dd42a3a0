"""robustagg: robust aggregation and robust clustering as Spark DataFrame jobs.

Two workloads:

* product popularity over a transaction log (``robustagg.operators.popularity``):
  filter, distinct product-customer pairs, customers per product (plain or
  salted two-round aggregation), the full list by product or the top H;
* k-center clustering with z outliers (``robustagg.operators``): farthest-first
  coresets per part, a weighted greedy cover with a doubling radius search, and
  the objective that ignores the z farthest points.

Everything is expressed with DataFrame operators; the one Python function is
the per-part farthest-first traversal (``applyInArrow``).
"""

from robustagg.session import build_session, ensure_checkpoint_dir

__all__ = ["build_session", "ensure_checkpoint_dir"]
