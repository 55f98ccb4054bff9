"""Golden cases: one per trap of the original SQL (FIXTURES.md section 3)."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from incentiva.operators import commission as C
from incentiva.operators import portfolio as P
from incentiva.operators import sales as S
from incentiva.params import DEFAULT
from incentiva.sources import schemas
from tests_helpers import d, money, sale, sources


def test_valid_sales_december(spark):
    rows = [
        sale("2022-12-01 00:00:00", "plain", 1, order=1),
        sale("2022-12-31 23:59:59", "last-second", 1, order=2),
        sale("2022-12-10 00:00:00", "open", 1, order=3, status="OPEN"),
        sale("2022-12-10 00:00:00", "cancel", 1, order=4, status="CANCEL"),
        sale("2022-12-10 00:00:00", "null-status", 1, order=5, status=None),
        sale("2022-12-10 00:00:00", "no-create-time", 1, order=6, has_create_time=False),
        sale("2022-12-10 00:00:00", "cancelled-later", 1, order=7, cancelled=True),
        sale("2022-11-30 23:59:59", "month-before", 1, order=8),
        sale("2023-01-01 00:00:00", "month-after", 1, order=9),
    ]
    src = sources(spark, sales=rows)
    kept = {r.store_url for r in S.valid_sales(src.sales, DEFAULT).collect()}
    assert kept == {"plain", "last-second"}


def test_sales_by_order_groups_per_order_and_day(spark):
    rows = [
        sale("2022-12-05 10:00:00", "s", 10, order=1),
        sale("2022-12-05 18:00:00", "s", 5, order=1),
        sale("2022-12-06 09:00:00", "s", 7, order=1),
        sale("2022-12-05 10:00:00", "s", None, order=2),
    ]
    got = {(r.calendar_date, r.order_number): r.total for r in S.sales_by_order(sources(spark, sales=rows).sales).collect()}
    assert got == {(d("2022-12-05"), 1): money(15), (d("2022-12-06"), 1): money(7), (d("2022-12-05"), 2): None}


@pytest.mark.parametrize(
    "total, flag, falta",
    [("100.00", 1, 0), ("100.01", 1, 0), ("99.70", 0, 0), ("99.50", 0, 1), ("99.49", 0, 1),
     ("0.00", 0, 100), ("-20.00", 0, 120), (None, 0, 0)],
)
def test_bonus_flag_and_shortfall(spark, total, flag, falta):
    src = sources(
        spark,
        sales=[sale("2022-12-03 12:00:00", "s1", total, buyer=7)],
        portfolio=[("s1", "m", "o", 0, "old")],
        buyers=[(7, "Ana")],
    )
    rows = P.bonus_detail(src, "old").collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.total_cliente, r.flag_bono, r.falta) == (money(total), flag, Decimal(falta))
    assert r.customer_name == "Ana"


def test_portfolio_join_is_inner_and_filters_population_and_retention(spark):
    src = sources(
        spark,
        sales=[sale("2022-12-03 12:00:00", s, 150, buyer=1) for s in ("old-kept", "new", "retained", "unknown", "nullflag")],
        portfolio=[("old-kept", "m", "o", 0, "old"), ("new", "m", "o", 0, "new"), ("retained", "m", "o", 1, "old"),
                   ("nullflag", "m", "o", None, "old")],
    )
    assert [r.store_url for r in P.bonus_detail(src, "old").collect()] == ["old-kept"]
    assert [r.store_url for r in P.bonus_detail(src, "new").collect()] == ["new"]
    assert [r.store_url for r in P.portfolio_sales(src, "old").collect()] == ["old-kept"]


def test_graduation_counts_bonus_rows_not_distinct_buyers(spark):
    detail = spark.createDataFrame(
        [("m", "o", "s", "L1", 1, "n", money(120), 1), ("m", "o", "s", "L2", 1, "n", money(130), 1),
         ("m", "o", "s", "L1", 2, "n", money(100), 1), ("m", "o", "s", "L1", 3, "n", money(100), 1),
         ("m", "o", "s", "L1", None, None, money(150), 1), ("m", "o", "s", "L1", 4, "n", money(99), 0),
         ("m", "o", "r", "L", 1, "n", money(100), 1), ("m", "o", "r", "L", 2, "n", money(100), 1),
         ("m", "o", "r", "L", 3, "n", money(100), 1), ("m", "o", "r", "L", 4, "n", money(100), 1)],
        "mentora string, orientador string, store_url string, leader_name string, dynamo_customer_id bigint, "
        "customer_name string, total_cliente decimal(38,2), flag_bono int",
    )
    got = {r.store_url: (r.clientes, r.clientes_bono, r.flag_graduado) for r in P.store_graduation(detail).collect()}
    assert got == {"s": (4, 5, 1), "r": (4, 4, 0)}


def test_buyer_fanout_is_kept(spark):
    # two names for one id: two rows, each with the full total; same name twice: one row, twice the total
    base = dict(sales=[sale("2022-12-03 12:00:00", "s1", 60, buyer=1), sale("2022-12-04 12:00:00", "s1", 10, buyer=2)],
                portfolio=[("s1", "m", "o", 0, "old")])
    src = sources(spark, buyers=[(1, "Ana"), (1, "Ann"), (2, "Bo"), (2, "Bo")], **base)
    got = sorted((r.dynamo_customer_id, r.customer_name, r.total_cliente) for r in P.bonus_detail(src, "old").collect())
    assert got == [(1, "Ana", money(60)), (1, "Ann", money(60)), (2, "Bo", money(20))]


def test_buyer_without_name_and_without_id(spark):
    src = sources(
        spark,
        sales=[sale("2022-12-03 12:00:00", "s1", 60, buyer=1), sale("2022-12-03 12:00:00", "s1", 70, buyer=None),
               sale("2022-12-09 12:00:00", "s1", 40, buyer=None)],
        portfolio=[("s1", "m", "o", 0, "old")],
    )
    got = sorted((str(r.dynamo_customer_id), r.customer_name, r.total_cliente, r.flag_bono)
                 for r in P.bonus_detail(src, "old").collect())
    assert got == [("1", None, money(60), 0), ("None", None, money(110), 1)]


def test_duplicate_portfolio_rows_multiply(spark):
    src = sources(
        spark,
        sales=[sale("2022-12-03 12:00:00", "s1", 60, buyer=1)],
        portfolio=[("s1", "m", "o", 0, "old"), ("s1", "m", "o", 0, "old"), ("s1", "m2", "o", 0, "old")],
    )
    got = sorted((r.mentora, r.total_cliente) for r in P.bonus_detail(src, "old").collect())
    assert got == [("m", money(120)), ("m2", money(60))]


def _tracker_sources(spark):
    rows = [
        sale("2022-12-10 08:00:00", "s1", 10), sale("2022-12-10 20:00:00", "s1", 5), sale("2022-12-15 12:00:00", "s1", 20),
        sale("2022-12-16 12:00:00", "s1", 7), sale("2023-01-10 12:00:00", "s1", 3), sale("2022-11-30 12:00:00", "s1", 50),
        sale("2022-12-20 12:00:00", "s2", 4), sale("2022-12-02 12:00:00", "s3", 9),
    ]
    tier = [("s1", d("2022-11-01"), "T0"), ("s1", d("2022-12-01"), "T1"), ("s2", d("2022-12-01"), "T2")]
    from tests_helpers import ts
    stores = [("s1", ts("2022-07-01 00:00:00")), ("s3", ts("2022-06-30 23:59:59"))]
    return sources(spark, sales=rows, tier=tier, stores=stores)


def _row(r):
    return (r.creation_date, r.calendar_date, r.quincena, r.store_url, r.tier_net_lm, r.total, r.venta_quincenal,
            r.comision)


EXPECTED_TRACKER = [
    (None, d("2022-12-20"), 2, "s2", "T2", money(4), money(4), ""),
    (d("2022-07-01"), d("2022-12-10"), 1, "s1", "T1", money(15), money(35), "De 5% a 10%"),
    (d("2022-07-01"), d("2022-12-15"), 1, "s1", "T1", money(20), money(35), "De 5% a 10%"),
    (d("2022-07-01"), d("2022-12-16"), 2, "s1", "T1", money(7), money(7), "De 5% a 10%"),
]
ALL_STORES_EXTRA = [
    (d("2022-07-01"), d("2023-01-10"), 1, "s1", None, money(3), money(3), "De 5% a 10%"),
    (d("2022-06-30"), d("2022-12-02"), 1, "s3", None, money(9), money(9), "De 8% a 15%"),
]


def test_commission_tracker_tier_required(spark):
    rows = [_row(r) for r in C.commission_tracker(_tracker_sources(spark)).collect()]
    assert rows == EXPECTED_TRACKER  # sorted: missing creation date first, then by keys


def test_commission_tracker_all_stores(spark):
    rows = [_row(r) for r in C.commission_tracker(_tracker_sources(spark), DEFAULT.with_(tier_required=False)).collect()]
    assert sorted(rows, key=str) == sorted(EXPECTED_TRACKER + ALL_STORES_EXTRA, key=str)
    assert rows[0][0] is None  # nulls first under ORDER BY creation_date DESC
    dates = [r[0] for r in rows[1:]]
    assert dates == sorted(dates, reverse=True)


def test_commission_tracker_nulls_last_option(spark):
    rows = C.commission_tracker(_tracker_sources(spark), DEFAULT.with_(nulls_first=False)).collect()
    assert rows[-1].creation_date is None


def test_half_month_sales(spark):
    got = {(r.store_url, r.calendar_month, r.quincena): r.venta_quincenal
           for r in C.half_month_sales(_tracker_sources(spark)).collect()}
    assert got == {
        ("s1", d("2022-12-01"), 1): money(35), ("s1", d("2022-12-01"), 2): money(7),
        ("s1", d("2023-01-01"), 1): money(3), ("s2", d("2022-12-01"), 2): money(4),
        ("s3", d("2022-12-01"), 1): money(9),
    }


def test_sales_with_tier_both_readings(spark):
    src = _tracker_sources(spark)
    inner = C.sales_with_tier(src)
    left = C.sales_with_tier(src, DEFAULT.with_(tier_required=False))
    assert inner.count() == 5 and left.count() == 7  # Dec s1 x4 + s2; plus s1 January and s3
    assert inner.filter(F.col("tier_net_lm").isNull()).count() == 0


def test_source_schema_check(spark):
    bad = spark.createDataFrame([("s",)], "store_url string")
    with pytest.raises(schemas.SchemaError):
        schemas.conform(bad, "stores")


def test_dimension_duplicates_and_strict_mode(spark):
    from incentiva.sources.tables import DuplicateKeyError, dimension_duplicates, require_unique_dimensions

    clean = sources(spark, portfolio=[("s1", "m", "o", 0, "old")], buyers=[(1, "Ana")])
    require_unique_dimensions(clean)
    dup = sources(spark, portfolio=[("s1", "m", "o", 0, "old"), ("s1", "m2", "o", 0, "old")],
                  buyers=[(1, "Ana"), (1, "Ann"), (2, "Bo")])
    got = sorted((r.dimension, r.key, r.copies) for r in dimension_duplicates(dup).collect())
    assert got == [("buyers", "1", 2), ("portfolio", "s1", 2)]
    with pytest.raises(DuplicateKeyError):
        require_unique_dimensions(dup)


def test_month_bounds_do_not_move_with_the_session_zone(spark):
    rows = [sale("2022-12-01 00:00:00", "first", 1, order=1), sale("2022-11-30 23:30:00", "before", 1, order=2),
            sale("2022-12-31 23:30:00", "last", 1, order=3)]
    src = sources(spark, sales=rows)
    prev = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("America/Lima", "Asia/Tokyo", "UTC"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            kept = {r.store_url for r in S.valid_sales(src.sales).collect()}
            assert kept == {"first", "last"}, tz
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)


def test_string_ids_work_end_to_end(spark):
    from incentiva.sources.tables import from_frames

    base = sources(spark, sales=[sale("2022-12-03 12:00:00", "s1", 60, buyer=1), sale("2022-12-04 12:00:00", "s1", 50,
                                                                                     buyer=None)],
                   portfolio=[("s1", "m", "o", 0, "old")], buyers=[(1, "Ana")])
    text_sales = (base.sales.withColumn("dynamo_customer_id", F.col("dynamo_customer_id").cast("string"))
                  .withColumn("order_number", F.col("order_number").cast("string")))
    text_buyers = base.buyers.withColumn("dynamo_customer_id", F.col("dynamo_customer_id").cast("string"))
    # ids as text in both tables, and as text in one and numbers in the other
    for sales_df, buyers_df in ((text_sales, text_buyers), (text_sales, base.buyers), (base.sales, text_buyers)):
        frames = {"sales": sales_df, "buyers": buyers_df}
        src = from_frames(**{k: frames.get(k, getattr(base, k)) for k in
                             ("sales", "portfolio", "portfolio_size", "buyers", "tier", "stores")})
        for params in (DEFAULT, DEFAULT.with_(broadcast_max_rows=0)):
            got = sorted((str(r.dynamo_customer_id), r.customer_name, r.total_cliente)
                         for r in P.bonus_detail(src, "old", params).collect())
            assert got == [("1", "Ana", money(60)), ("None", None, money(50))]


def test_a_third_population_with_its_own_ladder(spark):
    from incentiva.params import NEW, OLD, Ladder, Population

    vip = Population("vip", "cartera", Ladder.of(("0.50", 1000)))
    params = DEFAULT.with_(populations=(OLD, NEW, vip))
    rows = [sale("2022-12-03 12:00:00", f"v{i}", 150, buyer=b) for i in range(2) for b in range(1, 6)]
    src = sources(spark, sales=rows, portfolio=[("v0", "m", "o", 0, "vip"), ("v1", "m", "o", 0, "vip")],
                  portfolio_size=[("o", 3, 0)], buyers=[(b, f"n{b}") for b in range(1, 6)])
    t = P.portfolio_totals(src, "vip", params).collect()
    assert [(r.total_graduados, r.porc_graduados, r.ganancia_unitaria, r.ganancia, r.porc_meta) for r in t] == [
        (2, Decimal("0.6666"), 1000, 2000, "max")]
    both = P.bonus_detail_all(src, params, ["old", "vip"]).select("population").distinct().collect()
    assert [r.population for r in both] == ["vip"]


def test_zoned_timestamps_read_as_wall_clock_of_a_named_zone(spark):
    from incentiva.sources.tables import from_frames

    # 2022-12-01 03:30 UTC is 2022-11-30 22:30 in Lima: a November sale there
    base = sources(spark, sales=[sale("2022-12-01 03:30:00", "s1", 10), sale("2022-12-01 06:00:00", "s2", 10)])
    prev = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        zoned = base.sales
        for c in ("create_date_time_tz", "create_date_time", "cancel_date_time_tz"):
            zoned = zoned.withColumn(c, F.col(c).cast("timestamp"))  # instants, read as UTC wall clock
        with pytest.raises(schemas.SchemaError):
            from_frames(sales=zoned, portfolio=base.portfolio, portfolio_size=base.portfolio_size,
                        buyers=base.buyers, tier=base.tier, stores=base.stores)
        src = from_frames(zone="America/Lima", sales=zoned, portfolio=base.portfolio,
                          portfolio_size=base.portfolio_size, buyers=base.buyers, tier=base.tier, stores=base.stores)
        for tz in ("UTC", "Asia/Tokyo", "America/Lima"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            assert {r.store_url for r in S.valid_sales(src.sales).collect()} == {"s2"}, tz
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)
