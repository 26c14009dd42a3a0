"""The popularity report: transactions -> distinct pairs -> popularity ->
the full list by product (H = 0) or the top H (H > 0)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from robustagg.operators.popularity import (
    popularity_by_product, popularity_top_h, product_customer_pairs,
    product_popularity, product_popularity_salted,
)


def popularity_report(transactions: DataFrame, h: int, country: str | None = None,
                      salts: int | None = None) -> DataFrame:
    """``transactions`` is the typed record or the split text form. With
    ``salts`` the popularity is computed by the salted two-round plan."""
    if h < 0:
        raise ValueError("H must be >= 0 (0 = the full list by product)")
    pairs = product_customer_pairs(transactions, country)
    pop = product_popularity_salted(pairs, salts) if salts else product_popularity(pairs)
    return popularity_by_product(pop) if h == 0 else popularity_top_h(pop, h)
