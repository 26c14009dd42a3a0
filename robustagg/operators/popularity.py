"""Product popularity: the number of distinct customers per product.

Input is either the typed record (``product_id, quantity, customer_id,
country``) or the split text form (a ``tokens`` array, see
``robustagg.sources.transactions``). Plans:

* filter -> ``distinct`` on (product, customer): a hash aggregate that
  dedupes map-side, then shuffles on both columns, so a product bought by
  many customers is spread over all reducers;
* ``product_popularity``: ``groupBy(product).count()``. Partial counts are
  combined before the shuffle, so even a product holding a third of all pairs
  sends at most one row per map task;
* ``product_popularity_salted``: the two-round variant: count per (product,
  salt) and sum per product; the salt is a deterministic hash of the customer
  (a re-run task salts the same way);
* ``popularity_top_h``: ``orderBy(...).limit(H)``, planned as
  ``TakeOrderedAndProject`` (each task keeps H rows); the rank is numbered on
  those H rows only;
* ``popularity_by_product``: a distributed range sort, no collect.

Ties on popularity are ordered by product id, so results are deterministic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from robustagg.params import check_salts, check_top, is_all_countries
from robustagg.sources.transactions import (
    COUNTRY_FIELD, CUSTOMER_FIELD, PRODUCT_FIELD, QUANTITY_FIELD, token,
)


def _is_text(df: DataFrame) -> bool:
    return "tokens" in df.columns


def _quantity(df: DataFrame) -> Column:
    return token(QUANTITY_FIELD).cast("int") if _is_text(df) else F.col("quantity")


def _country(df: DataFrame) -> Column:
    return token(COUNTRY_FIELD) if _is_text(df) else F.col("country")


def transaction_predicate(df: DataFrame, country: str | None = None) -> Column:
    """quantity > 0, and the country equal to ``country`` ignoring case unless
    it is ``None`` / ``all``. The country is only looked at on rows whose
    quantity is positive (a short rejected row never fails)."""
    q = _quantity(df)
    if is_all_countries(country):
        return q > 0
    same = F.lower(_country(df)) == F.lit(country.lower())
    if not _is_text(df):
        # Typed records always have a country: a plain conjunction lets
        # Catalyst push each side of it to its own table (the country test
        # reaches the dimension before the join).
        return (q > 0) & same
    return F.when(q > 0, same).otherwise(F.lit(False))


def keep_transactions(df: DataFrame, country: str | None = None) -> DataFrame:
    return df.where(transaction_predicate(df, country))


def _pair_columns(df: DataFrame) -> list[Column]:
    if _is_text(df):
        # The customer is parsed after the filter: only kept rows need one.
        return [token(PRODUCT_FIELD).alias("product_id"),
                token(CUSTOMER_FIELD).cast("int").alias("customer_id")]
    return [F.col("product_id"), F.col("customer_id")]


def product_customer_pairs(df: DataFrame, country: str | None = None) -> DataFrame:
    """Distinct (product_id, customer_id) pairs of the kept transactions."""
    return keep_transactions(df, country).select(*_pair_columns(df)).distinct()


def product_popularity(pairs: DataFrame) -> DataFrame:
    """(product_id, popularity bigint) from distinct pairs."""
    return pairs.groupBy("product_id").agg(F.count(F.lit(1)).alias("popularity"))


def product_popularity_salted(pairs: DataFrame, salts: int) -> DataFrame:
    """Same result as ``product_popularity`` in two rounds: per (product,
    salt) then per product, salt = pmod(xxhash64(customer_id), K)."""
    check_salts(salts)
    salt = F.pmod(F.xxhash64("customer_id"), F.lit(int(salts)))
    per_salt = (pairs.groupBy("product_id", salt.alias("salt"))
                     .agg(F.count(F.lit(1)).alias("partial")))
    return per_salt.groupBy("product_id").agg(F.sum("partial").cast("long").alias("popularity"))


def _popularity_order() -> list[Column]:
    return [F.col("popularity").desc(), F.col("product_id").asc()]


def popularity_top_h(popularity: DataFrame, h: int) -> DataFrame:
    """The H most popular products with their rank (1 = most popular)."""
    check_top(h)
    top = popularity.orderBy(*_popularity_order()).limit(int(h))
    # The window runs over the H rows left by the limit, not over the input.
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*_popularity_order())))


def popularity_by_product(popularity: DataFrame) -> DataFrame:
    """All products ordered by product id (string order)."""
    return popularity.orderBy("product_id")


def row_count(df: DataFrame, name: str = "n") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))
