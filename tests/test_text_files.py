"""Lines written as text files: no task gets a fixed share of all lines."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from robustagg.sources import points as pts
from robustagg.sources import text


def files(spark, path):
    return spark.read.text(path).select(F.col("_metadata.file_path")).distinct().count()


@pytest.mark.parametrize("partitions", [2, 16])
def test_each_partition_is_written_where_it_is(spark, partitions):
    lines = spark.range(0, 2000, 1, partitions).select(F.format_string("line %d", "id").alias("value"))
    path = text.write_lines(lines)
    assert files(spark, path) == partitions
    assert sorted(r.value for r in spark.read.text(path).collect()) == sorted(f"line {i}" for i in range(2000))


def test_ordered_files_grow_with_the_lines(spark, monkeypatch):
    monkeypatch.setattr(text, "FILE_BYTES", 1000, raising=False)
    lines = spark.range(0, 2000, 1, 3).select((1999 - F.col("id")).alias("n"), F.format_string("line %d", 1999 - F.col("id")).alias("value"))
    path = text.write_lines(lines, order="n")
    assert files(spark, path) >= 15
    got = pts.read_point_lines(spark, path).orderBy("point_id").collect()
    assert [(r.point_id, r.value) for r in got] == [(i, f"line {i}") for i in range(2000)]


def test_no_lines(spark):
    for order in (None, "value"):
        path = text.write_lines(spark.createDataFrame([], "value string"), order=order)
        assert spark.read.text(path).count() == 0
