"""Relational operators of the job, each a function returning a lazy DataFrame."""

from .commission import commission_tracker, daily_store_sales, half_month_sales, sales_with_tier
from .portfolio import (
    bonus_detail,
    bonus_detail_all,
    portfolio_sales,
    portfolio_totals,
    portfolio_totals_all,
    store_graduation,
)
from .sales import sales_by_order, valid_sales, valid_sales_after

__all__ = [
    "bonus_detail", "bonus_detail_all", "commission_tracker", "daily_store_sales", "half_month_sales",
    "portfolio_sales", "portfolio_totals", "portfolio_totals_all", "sales_by_order", "sales_with_tier",
    "store_graduation", "valid_sales", "valid_sales_after",
]
