from ledgerlift.operators.exact import exact_sums
from ledgerlift.operators.gold import (
    balance,
    category_spend,
    expense_rows,
    preview,
    schema_report,
    share_of_total,
    top_k,
    user_totals,
)
from ledgerlift.operators.silver import clean_rows, is_complete, quality_counts, to_silver

__all__ = [
    "balance",
    "category_spend",
    "clean_rows",
    "exact_sums",
    "expense_rows",
    "is_complete",
    "preview",
    "quality_counts",
    "schema_report",
    "share_of_total",
    "to_silver",
    "top_k",
    "user_totals",
]
