"""Money expressions over an invoice row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SALES = "SALES"
RETURNS = "RETURNS"


def _kind(column: str = "invoice_type") -> Column:
    return F.col(column)


def is_sale_or_return() -> Column:
    return _kind().isin(SALES, RETURNS)


def signed(sale: Column, refund: Column | None = None) -> Column:
    """``sale`` on sales, minus ``refund`` (by default the same column) on returns, else 0."""
    taken_back = sale if refund is None else refund
    return F.when(_kind() == SALES, sale).when(_kind() == RETURNS, -taken_back).otherwise(F.lit(0))


def only_on(kind: str, amount: Column) -> Column:
    return F.when(_kind() == kind, amount).otherwise(F.lit(0))


def or_zero(amount: Column) -> Column:
    return F.coalesce(amount, F.lit(0))


def with_tax() -> Column:
    """Net amount plus tax, a missing tax counting as none."""
    return F.col("net_amount") + or_zero(F.col("tax"))
