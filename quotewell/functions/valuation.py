"""Company valuation ratios. A zero or missing denominator, or a result too wide for its type, gives NULL."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _ratio(a: Column, b: Column, decimal: str) -> Column:
    return F.try_divide(a.cast("double"), b.cast("double")).try_cast(decimal)


def market_cap(shares: Column, close: Column) -> Column:
    return F.try_multiply(shares.cast("decimal(20,0)"), close).try_cast("decimal(20,2)")


def price_earnings(cap: Column, net_profit: Column) -> Column:
    return _ratio(cap, net_profit, "decimal(10,4)")


def return_on_equity(net_profit: Column, equity: Column) -> Column:
    return _ratio(net_profit, equity, "decimal(10,6)")


def dividend_yield(trailing: Column, close: Column) -> Column:
    return _ratio(trailing, close, "decimal(10,6)")


def ev_ebitda(cap: Column, gross_debt: Column, ebitda: Column) -> Column:
    """Enterprise value here is market cap plus gross debt; the model holds no cash column."""
    return _ratio(cap + F.coalesce(gross_debt, F.lit(0)), ebitda, "decimal(10,4)")
