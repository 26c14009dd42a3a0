"""Exact ranks of distributed rows.

One range shuffle sorts the rows; every (partition, group) then holds a run of
consecutive ranks, so its row count is all that has to be added up: one small
row per partition and group, summed by a window, joined back. No task ever sees
more than its own partition, and a group (or the whole table) may span any
number of partitions.

The sorted rows are stored in the checkpoint folder first, so the partition that
a row was counted in is the one it is read back from, whatever is lost and
computed again. Equal rows get distinct ranks in any order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from robustagg.sources.store import free_name, stored

#: ``monotonically_increasing_id`` counts the rows of a partition in its low bits.
_ROW_BITS = 33


def with_rank(df: DataFrame, order: Sequence[str], by: Sequence[str] = (), name: str = "rank") -> DataFrame:
    """``df`` plus ``name`` (long): the position from 0 of each row in ``order``
    (columns, ascending, nulls first), within its group of ``by`` if given.

    Defined cases: nulls in ``by`` form a group, nulls in ``order`` come first;
    an empty table stays empty; other columns keep their names, except that a
    column called ``name`` is replaced."""
    df = df.drop(name)
    at, pid, first, shift = (free_name(df, x) for x in ("at", "pid", "first", "shift"))
    keys = [*by, *order]
    rows = stored(df.repartitionByRange(*keys).sortWithinPartitions(*keys)
                  .withColumn(at, F.monotonically_increasing_id()))
    rows = rows.withColumn(pid, F.shiftright(at, _ROW_BITS))
    runs = rows.groupBy(pid, *by).agg(F.count(F.lit(1)).alias("n"), F.min(at).alias(first))
    # One row per partition (and group): without groups a single task adds them up.
    before = Window.partitionBy(*by).orderBy(pid).rowsBetween(Window.unboundedPreceding, -1)
    keyed = {c: free_name(df, f"key_{c}") for c in (pid, *by)}
    runs = runs.select(*(F.col(c).alias(k) for c, k in keyed.items()),
                       (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col(first)).alias(shift))
    same = F.lit(True)
    for c, k in keyed.items():
        same = same & F.col(c).eqNullSafe(F.col(k))
    return rows.join(runs, same).withColumn(name, F.col(at) + F.col(shift)).select(*df.columns, name)
