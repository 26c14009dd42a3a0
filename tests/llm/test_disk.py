"""What the line dedup leaves on disk while it runs: shuffle files go with their query, tables with their last reader."""

from __future__ import annotations

import os
import time

import brute
import pytest
from pyspark.sql import functions as F

from robustagg.llm import common, lines
from robustagg.session import ensure_checkpoint_dir

ROWS = [(i, "\n".join(f"line {j} of a text that is {'quite' if (i + j) % 3 else 'rather'} like others, group {(i * j) % 7}"
                      for j in range(12)) + f"\nonly here {i} and nowhere else {i * i}") for i in range(40)]


def documents(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string").repartition(4)


def tables(spark):
    folder = ensure_checkpoint_dir(spark).removeprefix("file:")
    return {x for x in os.listdir(folder) if x.startswith("table-")}


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle_")}


def new_shuffle_files(spark, before):
    """They are deleted in the background."""
    end = time.time() + 10
    while (left := shuffle_files(spark) - before) and time.time() < end:
        time.sleep(0.1)
    return left


def test_cut_and_components_leave_no_shuffle_files(spark):
    before, was = shuffle_files(spark), spark.conf.get(common._CLEANUP)
    edges = spark.range(300).select(F.col("id").alias("a"), (F.col("id") - F.col("id") % 7).alias("b"))
    table = common.cut(edges.groupBy("b").agg(F.max("a").alias("a")).repartition(3, "a"))
    found = common.components(edges)
    assert not new_shuffle_files(spark, before)
    assert spark.conf.get(common._CLEANUP) == was
    assert table.count() == 43 and found.where("component = id - id % 7").count() == 300  # both can still be read


def test_settings_of_the_session_come_back(spark):
    for value in ("true", "false"):
        spark.conf.set(common._CLEANUP, value)
        common.cut(spark.range(3))
        assert spark.conf.get(common._CLEANUP) == value
    with pytest.raises(Exception, match="broken"):
        common.cut(spark.range(3).select(F.raise_error(F.lit("broken"))))
    assert spark.conf.get(common._CLEANUP) == "false"
    spark.conf.unset(common._CLEANUP)


def test_line_classes_keeps_one_table(spark):
    """Its result reads the distinct lines only; signatures, texts, pairs and links are gone."""
    kept, files = tables(spark), shuffle_files(spark)
    out = lines.line_classes(documents(spark))
    assert len(tables(spark) - kept) == 1
    assert not new_shuffle_files(spark, files)
    want = brute.line_classes(ROWS)
    assert {(r.doc_id, r.line_no): (r.class_doc_id, r.class_line_no) for r in out.collect()} == want


def test_dedup_lines_keeps_one_table(spark):
    """Only the lost lines, one row per document that loses any, are joined to the documents."""
    kept, files = tables(spark), shuffle_files(spark)
    out = lines.dedup_lines(documents(spark))
    (left,) = tables(spark) - kept
    assert not new_shuffle_files(spark, files)
    classes = brute.line_classes(ROWS)
    lost = {d for (d, i), first in classes.items() if first != (d, i)}
    table = spark.read.parquet(f"{ensure_checkpoint_dir(spark)}/{left}")
    assert {r.doc_id for r in table.collect()} == lost and len(lost) < len(ROWS)
    want = {d: "\n".join(x for i, x in enumerate(t.split("\n")) if classes[d, i] == (d, i)) for d, t in ROWS}
    assert {r.doc_id: r.text for r in out.collect()} == want


def test_settled_deletes_what_was_cut_on_the_way(spark):
    kept = tables(spark)

    def make():
        first = common.cut(spark.range(10))
        inner = common.settled(lambda: common.cut(first.where("id > 2")).where("id > 4"))
        assert len(tables(spark) - kept) == 2
        return inner.unionByName(first)
    out = common.settled(make)
    assert len(tables(spark) - kept) == 1 and out.count() == 15
    with pytest.raises(ZeroDivisionError):
        common.settled(lambda: common.cut(spark.range(1 // 0)))
    assert not common._MADE.lists
