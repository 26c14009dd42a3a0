"""Declared schemas of the input tables (the columns this library reads).

Reading with a declared schema skips footer inference (one Spark job per
read) and reads only the listed columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Column names and types of the test tables that are read.
SCHEMAS = {
    "lineitem": ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                 "l_quantity double, l_returnflag string, l_linestatus string"),
    "orders": "o_orderkey bigint, o_custkey bigint",
    "customer": "c_custkey bigint, c_nationkey int, c_acctbal double",
    "nation": "n_nationkey int, n_name string",
    "supplier": "s_suppkey bigint, s_nationkey int, s_acctbal double",
    "embeddings": "vec_id bigint, embedding array<float>",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in SCHEMAS:
        reader = reader.schema(SCHEMAS[name])
    return reader.parquet(f"{sf_dir}/{name}.parquet")
