"""Valid sales and the per-order aggregate.

A sale counts when it has a creation time, is not cancelled and its status is
neither excluded nor missing. The month filter is a half-open range on the raw
wall-clock timestamp, so it reaches the Parquet scan as pushed filters (and as
partition pruning when the table is partitioned on that column's month).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import as_month, month_bounds, month_start, next_month, sale_date, ts_literal
from ..params import DEFAULT, Params
from ..sources.schemas import INSTANT, sum_money

ORDER_KEYS = ["calendar_date", "calendar_month", "store_url", "leader_name", "dynamo_customer_id", "order_number"]


def _status_ok(params: Params) -> Column:
    # NOT IN drops a null status as well: null NOT IN (...) is null
    return F.col("order_status").isNotNull() & ~F.col("order_status").isin(*params.excluded_statuses)


def _valid(sales: DataFrame, params: Params, time_filter: Column) -> DataFrame:
    return (
        sales.filter(
            F.col("create_date_time").isNotNull()
            & F.col("cancel_date_time_tz").isNull()
            & _status_ok(params)
            & time_filter
        )
        .withColumn("calendar_date", sale_date(F.col("create_date_time_tz")))
        .withColumn("calendar_month", month_start(F.col("calendar_date")))
        .drop(INSTANT)
    )


#: No zone is further from UTC; the exact wall-clock range stays on top of the widened one.
_ZONE_SLACK = dt.timedelta(days=1)


def _instant(wall: dt.datetime, slack: dt.timedelta) -> Column:
    return F.lit((wall + slack).replace(tzinfo=dt.timezone.utc))


def _instants(sales: DataFrame, lo: dt.datetime, hi: dt.datetime | None) -> Column:
    """A range on the raw instants of zoned sale times (pushed to the scan), wide enough for every zone."""
    if INSTANT not in sales.columns:
        return F.lit(True)
    raw = F.col(INSTANT)
    cond = raw >= _instant(lo, -_ZONE_SLACK)
    return cond if hi is None else cond & (raw < _instant(hi, _ZONE_SLACK))


def month_columns(name: str | None) -> list[str]:
    """The partition columns that ``Params.sales_month_col`` names: none, one, or year and month."""
    return [c.strip() for c in name.split(",")] if name else []


#: Java date pattern of a text month -> strftime pattern of its bounds; year first, so that texts sort like months.
MONTH_FORMATS = {"yyyy-MM": "%Y-%m", "yyyyMM": "%Y%m", "yyyy/MM": "%Y/%m", "yyyy_MM": "%Y_%m", "yyyy-MM-dd": "%Y-%m-01", "yyyyMMdd": "%Y%m01"}


def _partition_filter(sales: DataFrame, params: Params, first: dt.date, last: dt.date | None) -> Column:
    """Months ``first`` to ``last`` (None: no end) on the month partition column(s), in whatever form they are stored."""
    cols = month_columns(params.sales_month_col)
    if not cols or not set(cols) <= set(sales.columns):
        return F.lit(True)
    if len(cols) == 2:
        year, month = (F.col(c) if isinstance(sales.schema[c].dataType, T.IntegralType) else F.col(c).cast("int") for c in cols)
        from_ = (year > first.year) | (year == first.year) & (month >= first.month)
        if last == first:
            return (year == first.year) & (month == first.month)
        return from_ if last is None else from_ & ((year < last.year) | (year == last.year) & (month <= last.month))
    kind = sales.schema[cols[0]].dataType
    if isinstance(kind, T.DateType):
        bound = F.lit
    elif isinstance(kind, T.IntegralType):
        bound = lambda m: F.lit(m.year * 100 + m.month)
    elif isinstance(kind, T.StringType):
        if params.sales_month_format not in MONTH_FORMATS:
            raise ValueError(f"sales_month_format {params.sales_month_format!r} is none of {sorted(MONTH_FORMATS)}")
        bound = lambda m: F.lit(m.strftime(MONTH_FORMATS[params.sales_month_format]))
    else:
        raise ValueError(f"the month column {cols[0]} is {kind.simpleString()}; a date, whole number yyyymm or text is needed")
    c = F.col(cols[0])
    if last == first:
        return c == bound(first)
    return c > bound(as_month(first - dt.timedelta(days=1))) if last is None else c.between(bound(first), bound(last))


def partition_month(sales: DataFrame, params: Params) -> Column:
    """The month that the partition column(s) say, as the date of its first day."""
    cols = month_columns(params.sales_month_col)
    if len(cols) == 2:
        return F.make_date(F.col(cols[0]).cast("int"), F.col(cols[1]).cast("int"), F.lit(1))
    kind = sales.schema[cols[0]].dataType
    if isinstance(kind, T.DateType):
        return F.col(cols[0])
    if isinstance(kind, T.IntegralType):
        return F.make_date((F.col(cols[0]) / 100).cast("int"), F.col(cols[0]).cast("int") % 100, F.lit(1))
    return F.trunc(F.to_date(F.col(cols[0]), params.sales_month_format), "month")


def valid_sales(sales: DataFrame, params: Params = DEFAULT, month: dt.date | None = None) -> DataFrame:
    """Valid sale lines of one month, with ``calendar_date`` and ``calendar_month``."""
    m = as_month(month or params.month)
    lo, hi = month_bounds(m)
    ts = F.col("create_date_time_tz")
    if INSTANT in sales.columns:
        # partitions may follow another zone's months than the wall clock: take the neighbours too
        around = (as_month(m - dt.timedelta(days=1)), next_month(m))
        part = _partition_filter(sales, params, *around)
    else:
        part = _partition_filter(sales, params, m, m)
    return _valid(sales, params, part & _instants(sales, lo, hi) & (ts >= ts_literal(lo)) & (ts < ts_literal(hi)))


def valid_sales_after(sales: DataFrame, params: Params = DEFAULT, after_month: dt.date | None = None) -> DataFrame:
    """Valid sale lines of every month strictly after ``after_month``."""
    after = as_month(after_month or params.tracker_after_month)
    start = dt.datetime.combine(next_month(after), dt.time())
    zoned = INSTANT in sales.columns
    part = _partition_filter(sales, params, after if zoned else start.date(), None)
    return _valid(sales, params, part & _instants(sales, start, None) & (F.col("create_date_time_tz") >= ts_literal(start)))


def misplaced_sales(sales: DataFrame, params: Params) -> DataFrame:
    """Sales whose month partition is not their local month: (partition, month, rows).

    Without a zone the month filters rely on the partition column following the
    local month; this check shows where it does not.
    """
    month = month_start(sale_date(F.col("create_date_time_tz")))
    part = partition_month(sales, params)
    return (sales.select(part.alias("partition"), month.alias("month")).where("not (partition <=> month)")
            .groupBy("partition", "month").agg(F.count(F.lit(1)).alias("rows")))


def sales_by_order(sales: DataFrame, params: Params = DEFAULT, month: dt.date | None = None,
                   stores: DataFrame | None = None) -> DataFrame:
    """Sum of ``net_value`` per day, month, store, leader, buyer and order (one month).

    ``stores``: a small frame whose only column is the stores to keep, before anything is shuffled.
    """
    v = valid_sales(sales, params, month)
    if stores is not None:
        v = v.join(F.broadcast(stores), v.store_url == F.col(stores.columns[0]), "left_semi")
    return v.groupBy(*ORDER_KEYS).agg(F.sum("net_value").cast(sum_money(v, "net_value")).alias("total"))
