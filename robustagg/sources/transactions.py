"""Transaction sources.

A transaction is a header-less, comma-separated text line with eight fields,
counted from 0 (no quoting):

    0 invoice | 1 product_id | 2 (free) | 3 quantity | 4 (free) | 5 (free)
    6 customer_id | 7 country

Only fields 1, 3, 6 and 7 are read. Two entry points produce the same record:

* ``read_transaction_lines`` / ``transaction_lines_from_tables``: the text
  form, one ``value`` string per line; ``split_transactions`` turns it into a
  ``tokens`` array that the popularity filter reads lazily, so that a field is
  only parsed on the rows that need it (quantity on every row, country only
  where quantity > 0, customer only on kept rows);
* ``transactions_from_tables``: the typed record built from the TPC-H-like
  test tables with ordinary equi-joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from robustagg.sources.tables import read_table

# Positions of the fields the reference reads.
PRODUCT_FIELD = 1
QUANTITY_FIELD = 3
CUSTOMER_FIELD = 6
COUNTRY_FIELD = 7


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, name)


def _joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The dimensions are resolved on the order side first (orders -> customer
    # -> nation), so the fact table meets one pre-joined side once; a country
    # filter is pushed to nation and shrinks that side before the big join.
    # Catalyst prunes unused columns at the scans; sides are broadcast only
    # when their measured size is under the broadcast threshold (AQE), and the
    # big join is otherwise a sort-merge join with skew splitting.
    # The declared schemas (robustagg.sources.tables) list exactly the
    # columns read, so no projection is needed before the joins.
    li = _table(spark, sf_dir, "lineitem")
    orders = _table(spark, sf_dir, "orders")
    customer = _table(spark, sf_dir, "customer")
    nation = _table(spark, sf_dir, "nation")
    buyers = (orders.join(customer, orders.o_custkey == customer.c_custkey)
                    .join(nation, customer.c_nationkey == nation.n_nationkey))
    return li.join(buyers, li.l_orderkey == buyers.o_orderkey)


def _signed_quantity() -> Column:
    # Returned lines carry a negative quantity, so that the quantity filter of
    # the popularity job has something to remove.
    return (F.when(F.col("l_returnflag") == "R", -F.col("l_quantity"))
             .otherwise(F.col("l_quantity")).cast("int"))


def transactions_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed transactions: product_id string, quantity int, customer_id int,
    country string."""
    return _joined(spark, sf_dir).select(
        F.col("l_partkey").cast("string").alias("product_id"),
        _signed_quantity().alias("quantity"),
        F.col("o_custkey").cast("int").alias("customer_id"),
        F.col("n_name").alias("country"),
    )


def transaction_lines_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text form (``value`` string) of the same transactions."""
    return _joined(spark, sf_dir).select(
        F.concat_ws(
            ",",
            F.col("l_orderkey").cast("string"),
            F.col("l_partkey").cast("string"),
            F.col("l_linestatus"),
            _signed_quantity().cast("string"),
            F.col("l_linenumber").cast("string"),
            F.col("l_suppkey").cast("string"),
            F.col("o_custkey").cast("string"),
            F.col("n_name"),
        ).alias("value"))


def read_transaction_lines(spark: SparkSession, path: str) -> DataFrame:
    """Header-less transaction text file(s); the scan splits itself, so no
    repartition is needed."""
    return spark.read.text(path)


def split_transactions(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Split each line on commas, dropping trailing empty fields first (as a
    Java ``split(",")`` does). Indexing the result is strict under ANSI mode:
    a needed field that is missing fails the job instead of becoming null."""
    stripped = F.regexp_replace(F.col(value_col), ",+$", "")
    return lines.select(F.split(stripped, ",").alias("tokens"))


def token(i: int) -> Column:
    return F.col("tokens")[i]


def parse_transactions(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Every line typed (strict: all four read fields must parse)."""
    return split_transactions(lines, value_col).select(
        token(PRODUCT_FIELD).alias("product_id"),
        token(QUANTITY_FIELD).cast("int").alias("quantity"),
        token(CUSTOMER_FIELD).cast("int").alias("customer_id"),
        token(COUNTRY_FIELD).alias("country"),
    )
