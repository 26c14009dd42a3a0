"""Sources: transaction lines / records and point tables."""

from robustagg.sources.points import (
    customer_point_lines, parse_points, points_from_table, read_points,
)
from robustagg.sources.transactions import (
    parse_transactions, read_transaction_lines, split_transactions,
    transaction_lines_from_tables, transactions_from_tables,
)

__all__ = [
    "customer_point_lines", "parse_points", "points_from_table", "read_points",
    "parse_transactions", "read_transaction_lines", "split_transactions",
    "transaction_lines_from_tables", "transactions_from_tables",
]
