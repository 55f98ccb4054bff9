"""Sales-incentive analytics on Spark DataFrames.

From sales lines, store portfolios, buyers, monthly store tiers and a store
register this computes which buyers earn a store a bonus mark, which stores
graduate, each advisor's graduated share, the payout and next target of a step
ladder, and a daily commission tracker with half-month totals.
"""

from .params import DEFAULT, NEW, OLD, Ladder, Params, Population
from .sources.tables import Sources

__all__ = ["DEFAULT", "NEW", "OLD", "Ladder", "Params", "Population", "Sources"]
