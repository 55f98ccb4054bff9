"""Scalar column functions: dates, half months, flags, shortfalls, exact shares.

All are built from ``pyspark.sql.functions``; they stay inside whole-stage
codegen and need no Python at run time.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_D38 = T.DecimalType(38, 0)


def sale_date(ts: Column) -> Column:
    """Calendar day of a wall-clock (``timestamp_ntz``) timestamp."""
    return F.to_date(ts)


def month_start(day: Column) -> Column:
    """First day of the month, as a date (``trunc`` keeps the date type)."""
    return F.trunc(day, "month")


def next_month(month: dt.date) -> dt.date:
    return dt.date(month.year + month.month // 12, month.month % 12 + 1, 1)


def as_month(day: dt.date) -> dt.date:
    return dt.date(day.year, day.month, 1)


def month_bounds(month: dt.date) -> tuple[dt.datetime, dt.datetime]:
    """Half-open ``[start, end)`` wall-clock range of a month.

    A range on the raw timestamp is what reaches the Parquet reader as
    ``PushedFilters`` (and row-group statistics); ``trunc(to_date(ts)) = month``
    would not push down.
    """
    m = as_month(month)
    return dt.datetime.combine(m, dt.time()), dt.datetime.combine(next_month(m), dt.time())


def ts_literal(value: dt.datetime) -> Column:
    """A wall-clock timestamp literal. Built from text: a Python datetime literal
    would pass through the process's and the session's time zones."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def half_month(day: Column) -> Column:
    """1 for days 1-15, else 2 (a missing day gives 2, as in a CASE's else)."""
    return F.when(F.dayofmonth(day) <= 15, F.lit(1)).otherwise(F.lit(2))


def flag_at_least(value: Column, threshold) -> Column:
    """0/1 flag ``value >= threshold``; a null value gives 0."""
    return F.when(value >= F.lit(threshold), F.lit(1)).otherwise(F.lit(0))


def shortfall(total: Column, target: Decimal) -> Column:
    """Whole amount still missing to ``target``; 0 at or above it and for null.

    Rounded half away from zero, so a total of 99.70 gives 0 even though it is
    below the target.
    """
    t = F.lit(Decimal(target))
    return F.when(total < t, F.round(t - total, 0)).otherwise(F.lit(0)).cast(_D38)


def truncate_to(x: Column, digits: int) -> Column:
    """Cut a decimal to ``digits`` places toward zero, ``truncate(x, n)`` (Spark has
    no two-argument numeric truncate; ``floor``/``ceil`` with a scale do it)."""
    return F.when(x < 0, F.ceil(x, F.lit(digits))).otherwise(F.floor(x, F.lit(digits)))


def _floor_div(a: Column, b: Column) -> Column:
    """Exact integer division for a >= 0, b > 0 (bigint in, bigint out).

    ``a - a % b`` is a multiple of ``b``, so the decimal quotient is an exact
    integer; no double is involved.
    """
    return ((a - a % b).cast(_D38) / b.cast(_D38)).cast("bigint")


def share(numerator: Column, denominator: Column, digits: int = 4, division_scale: int = 6,
          strict: bool = False) -> Column:
    """``truncate(numerator / denominator, digits)`` for integer inputs, exactly.

    The quotient of two integers is first rounded half away from zero to
    ``division_scale`` places (the scale of integer division in the warehouse
    dialect), then cut toward zero to ``digits`` places. Computed in integer
    arithmetic, so no double and no double rounding: 57 / 100 is 0.5700.

    A zero denominator gives null, or raises when ``strict``; a null input gives null.
    """
    if digits > division_scale:
        raise ValueError("digits must not exceed division_scale")
    n = numerator.cast("bigint")
    d = denominator.cast("bigint")
    if strict:
        d = F.when(d == 0, F.raise_error(F.lit("DIVIDE_BY_ZERO: portfolio size is 0"))).otherwise(d)
    else:
        d = F.when(d != 0, d)
    negative = (n < 0) != (d < 0)
    an, ad = F.abs(n), F.abs(d)
    scale = 10 ** division_scale
    rounded = _floor_div(an * F.lit(2 * scale) + ad, ad * F.lit(2))
    cut = _floor_div(rounded, F.lit(10 ** (division_scale - digits)))
    signed = F.when(negative, -cut).otherwise(cut)
    unit = F.lit(Decimal(1).scaleb(-digits))
    return (signed.cast(_D38) * unit).cast(T.DecimalType(18, digits))


def scheme_label(created: Column, cut: dt.date, on_or_after: str, before: str, unknown: str) -> Column:
    """Label by a cut date: ``on_or_after`` from the cut on, ``before`` earlier, ``unknown`` for null."""
    return (
        F.when(created >= F.lit(cut), F.lit(on_or_after))
        .when(created < F.lit(cut), F.lit(before))
        .otherwise(F.lit(unknown))
    )
