"""Job parameters: month, thresholds, populations and their rate ladders.

Every constant of the incentive scheme is a parameter here; the defaults are the
values of the December 2022 scheme. Money thresholds and ladder rungs are
``Decimal`` so that shares and targets are compared and multiplied exactly.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace
from decimal import Decimal


@dataclass(frozen=True)
class Rung:
    """One step of a ladder: from ``threshold`` (inclusive) on, pay ``rate``."""

    threshold: Decimal
    rate: int


@dataclass(frozen=True)
class Ladder:
    """Ascending step ladder of (share threshold, unit rate)."""

    rungs: tuple[Rung, ...]

    def __post_init__(self) -> None:
        if not self.rungs:
            raise ValueError("a ladder needs at least one rung")
        ths = [r.threshold for r in self.rungs]
        if any(not isinstance(t, Decimal) for t in ths):
            raise TypeError("ladder thresholds must be Decimal, never float")
        if ths != sorted(ths) or len(set(ths)) != len(ths):
            raise ValueError("ladder thresholds must be strictly ascending")

    @classmethod
    def of(cls, *pairs: tuple[str | Decimal, int]) -> "Ladder":
        """Ladder from (threshold, rate) pairs; thresholds as text or Decimal, never float."""
        if any(isinstance(t, float) for t, _ in pairs):
            raise TypeError("give ladder thresholds as text or Decimal; a float is not exact")
        if any(int(r) != r for _, r in pairs):
            raise ValueError("ladder rates must be whole numbers")
        return cls(tuple(Rung(Decimal(t), int(r)) for t, r in pairs))

    @property
    def lowest(self) -> Rung:
        return self.rungs[0]

    @property
    def top(self) -> Rung:
        return self.rungs[-1]


# ---------------------------------------------------------------------------
# Fixed values of the December 2022 scheme (must equal the original job):
#   old stores: share 0.03 -> 40, 0.06 -> 50, 0.10 -> 60, 0.15 -> 70, 0.20 -> 85, 0.25 -> 100
#   new stores: share 0.02 -> 60, 0.04 -> 75, 0.07 -> 90, 0.11 -> 100, 0.14 -> 130, 0.18 -> 150
#   a buyer earns a bonus mark at a month spend of 100; a store graduates at 5 marks
#   valid sales exclude order status CANCEL and OPEN
#   commission label: created on/after 2022-07-01 'De 5% a 10%', before 'De 8% a 15%', else ''
#   the next-target text at the top of a ladder is 'max'
# ---------------------------------------------------------------------------
OLD_LADDER = Ladder.of(
    ("0.03", 40), ("0.06", 50), ("0.10", 60), ("0.15", 70), ("0.20", 85), ("0.25", 100)
)
NEW_LADDER = Ladder.of(
    ("0.02", 60), ("0.04", 75), ("0.07", 90), ("0.11", 100), ("0.14", 130), ("0.18", 150)
)
BONUS_MIN_SPEND = Decimal("100")
GRADUATE_MIN_BONUSES = 5
EXCLUDED_STATUSES = ("CANCEL", "OPEN")
COMMISSION_CUT_DATE = dt.date(2022, 7, 1)
COMMISSION_LABEL_ON_OR_AFTER = "De 5% a 10%"
COMMISSION_LABEL_BEFORE = "De 8% a 15%"
COMMISSION_LABEL_UNKNOWN = ""
TOP_TARGET_TEXT = "max"
REPORT_MONTH = dt.date(2022, 12, 1)
TRACKER_AFTER_MONTH = dt.date(2022, 11, 1)


@dataclass(frozen=True)
class Population:
    """A store population: its name in the portfolio, its size column, its ladder."""

    name: str
    size_col: str
    ladder: Ladder


OLD = Population("old", "cartera", OLD_LADDER)
NEW = Population("new", "cartera_nuevos", NEW_LADDER)
POPULATIONS = (OLD, NEW)


@dataclass(frozen=True)
class Params:
    """All knobs of the portfolio chain and the commission tracker."""

    month: dt.date = REPORT_MONTH
    bonus_min: Decimal = BONUS_MIN_SPEND
    graduate_min: int = GRADUATE_MIN_BONUSES
    excluded_statuses: tuple[str, ...] = EXCLUDED_STATUSES
    retention_value: int = 0
    # month partition column of the sales table, if any: the month filters are then
    # applied to it as well, pruning partitions. A date (first of the month), a whole
    # number yyyymm, a text in sales_month_format, or two columns "year,month"
    sales_month_col: str | None = None
    sales_month_format: str = "yyyy-MM"
    # commission tracker
    tracker_after_month: dt.date = TRACKER_AFTER_MONTH
    cut_date: dt.date = COMMISSION_CUT_DATE
    label_on_or_after: str = COMMISSION_LABEL_ON_OR_AFTER
    label_before: str = COMMISSION_LABEL_BEFORE
    label_unknown: str = COMMISSION_LABEL_UNKNOWN
    # the month in the tracker's WHERE names the tier table's column, so a sale
    # without a tier row for its month is dropped; False keeps it with a null tier
    tier_required: bool = True
    # ORDER BY creation_date DESC places missing creation dates first
    nulls_first: bool = True
    # division by a zero portfolio: null share (False) or raise (True)
    strict_division: bool = False
    # size bound for broadcasting a dimension; above it the join shuffles
    broadcast_max_bytes: int = 64 * 1024 * 1024
    broadcast_max_rows: int = 2_000_000
    # a key with more rows than this is spread over salts in a shuffle join
    heavy_key_rows: int = 100_000
    top_text: str = TOP_TARGET_TEXT
    populations: tuple[Population, ...] = POPULATIONS

    def __post_init__(self) -> None:
        # frozen and hashable: accept any sequence of populations, keep a tuple
        object.__setattr__(self, "populations", tuple(self.populations))
        object.__setattr__(self, "excluded_statuses", tuple(self.excluded_statuses))
        object.__setattr__(self, "bonus_min", Decimal(str(self.bonus_min)))

    def with_(self, **kw) -> "Params":
        return replace(self, **kw)

    @classmethod
    def from_json(cls, given: dict) -> "Params":
        """Parameters from a JSON object: names as here, dates as text, populations as a list of
        {"name", "size_col", "ladder": [["0.03", 40], ...]}. Unknown names raise ``TypeError``."""
        kw = dict(given)
        for k in ("month", "tracker_after_month", "cut_date"):
            if k in kw:
                kw[k] = dt.date.fromisoformat(kw[k])
        if "populations" in kw:
            kw["populations"] = tuple(Population(p["name"], p["size_col"], Ladder.of(*map(tuple, p["ladder"])))
                                      for p in kw["populations"])
        return cls(**kw)

    def population(self, name: str) -> Population:
        for p in self.populations:
            if p.name == name:
                return p
        raise KeyError(f"unknown population {name!r}; known: {[p.name for p in self.populations]}")


DEFAULT = Params()
