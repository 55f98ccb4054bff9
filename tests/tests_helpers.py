"""Small in-memory inputs for golden tests (explicit schemas, no inference)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from incentiva.sources import schemas
from incentiva.sources.tables import Sources, from_frames


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def d(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def money(x) -> Decimal | None:
    return None if x is None else Decimal(str(x)).quantize(Decimal("0.01"))


def sale(created: str, store: str, value, buyer=1, leader="L", order=1, status="PAID",
         has_create_time=True, cancelled=False) -> tuple:
    t = ts(created)
    return (t, t if has_create_time else None, t if cancelled else None, status, store, leader, buyer, order,
            money(value))


def sources(spark, sales=(), portfolio=(), portfolio_size=(), buyers=(), tier=(), stores=()) -> Sources:
    def df(rows, name):
        return spark.createDataFrame(list(rows), schemas.SCHEMAS[name])

    return from_frames(
        sales=df(sales, "sales"), portfolio=df(portfolio, "portfolio"),
        portfolio_size=df(portfolio_size, "portfolio_size"), buyers=df(buyers, "buyers"),
        tier=df(tier, "tier"), stores=df(stores, "stores"),
    )
