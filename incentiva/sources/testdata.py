"""Build the six inputs from the driver's TPC-H-like test tables.

The test tables have none of the job's columns, so each input is a view derived
from them by a fixed rule (FIXTURES.md section 2): a store is a part, a buyer is
a customer, an advisor is a brand, and sale days are spread from the order key
over November 2022 - January 2023. The modulo rules only shape the fixture
(some stores without a portfolio, some buyers without a name, ...); every view
covers its whole source table and grows with it.

The same views are written in SQL for the DuckDB oracle (``incentiva.oracle``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .schemas import MONEY
from .tables import Sources, from_frames

# Fixed values of the fixture mapping (FIXTURES.md section 2)
SALE_DAY_ZERO = dt.date(2022, 11, 1)
SALE_DAY_SPREAD = 92
STORE_CREATED_DAY_ZERO = dt.date(2022, 1, 1)
TIER_MONTHS = (dt.date(2022, 11, 1), dt.date(2022, 12, 1), dt.date(2023, 1, 1))
NET_VALUE_FACTOR = "0.0017"
LAST_SECOND = 86_399
BRAND_WITHOUT_SIZE = "Brand#25"
OLD_MAX_PART_SIZE = 25


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _store(key: Column) -> Column:
    return F.concat(F.lit("store-"), key.cast("string"))


def _days_after(day0: dt.date, n: Column) -> Column:
    return F.date_add(F.lit(day0), n.cast("int"))


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_extendedprice", "l_discount", "l_returnflag", "l_shipdate"
    )
    orders = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    part = _read(spark, sf_dir, "part").select("p_partkey", "p_name")
    j = li.join(orders, li.l_orderkey == orders.o_orderkey).join(part, li.l_partkey == part.p_partkey)
    key = F.col("o_orderkey")
    line = key + F.col("l_partkey")
    second = F.when(key % 31 == 0, LAST_SECOND).otherwise((key * 7919) % 86_400)
    created = _days_after(SALE_DAY_ZERO, key % SALE_DAY_SPREAD).cast("timestamp_ntz") + F.make_dt_interval(secs=second.cast("decimal(18,6)"))
    status = (
        F.when(F.col("o_orderstatus") == "O", F.lit("OPEN"))
        .when((F.col("o_orderstatus") == "P") & (key % 7 == 0), F.lit("CANCEL"))
        .when((F.col("o_orderstatus") == "P") & (key % 7 == 1), F.lit(None).cast("string"))
        .otherwise(F.lit("PAID"))
    )
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    discount = F.col("l_discount").cast("decimal(4,2)")
    net = (price * (F.lit(1) - discount) * F.lit(NET_VALUE_FACTOR).cast("decimal(4,4)")).cast(MONEY)
    return j.select(
        created.alias("create_date_time_tz"),
        F.when(key % 97 == 0, F.lit(None)).otherwise(created).alias("create_date_time"),
        F.when((F.col("l_returnflag") == "R") & (key % 10 == 0), F.col("l_shipdate").cast("timestamp_ntz"))
        .alias("cancel_date_time_tz"),
        status.alias("order_status"),
        F.when(line % 37 != 0, _store(F.col("l_partkey"))).alias("store_url"),
        F.when(F.col("o_custkey") % 2 == 0, F.col("p_name")).otherwise(F.concat("p_name", F.lit(" B"))).alias("leader_name"),
        F.when(key % 23 != 0, F.col("o_custkey")).alias("dynamo_customer_id"),
        key.alias("order_number"),
        F.when(line % 41 != 0, net).alias("net_value"),
    )


def portfolio(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _read(spark, sf_dir, "part").filter(F.col("p_partkey") % 13 != 12)
    p = p.unionByName(p.filter(F.col("p_partkey") % 101 == 0))
    return p.select(
        _store(F.col("p_partkey")).alias("emprendedor"),
        F.when(F.col("p_partkey") % 11 == 0, F.lit("mentor-shared"))
        .otherwise(F.concat(F.lit("mentor-of-"), F.col("p_brand")))
        .alias("mentora"),
        F.col("p_brand").alias("orientador"),
        F.when(F.col("p_partkey") % 10 == 9, 1).otherwise(0).cast("int").alias("flag_retencion"),
        F.when(F.col("p_size") <= OLD_MAX_PART_SIZE, F.lit("old")).otherwise(F.lit("new")).alias("flag_emprendedor"),
    )


def portfolio_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _read(spark, sf_dir, "part").filter(F.col("p_brand") != BRAND_WITHOUT_SIZE)
    n = p.groupBy(F.col("p_brand").alias("orientador")).agg(
        F.count(F.when(F.col("p_size") <= OLD_MAX_PART_SIZE, 1)).alias("a"),
        F.count(F.when(F.col("p_size") > OLD_MAX_PART_SIZE, 1)).alias("b"),
    )
    # sizes divided by 1, 5, 9, 13 or 17, so that shares reach every rung of the ladders
    share = 1 + 4 * (F.substring("orientador", -1, 1).cast("int") % 5)
    sizes = n.select("orientador", *[F.ceil(F.col(c) / share).cast("int").alias(o) for c, o in (("a", "cartera"), ("b", "cartera_nuevos"))])
    return sizes.unionByName(sizes.filter(F.col("orientador") == "Brand#11"))


def buyers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _read(spark, sf_dir, "customer").filter(F.col("c_custkey") % 50 != 49)
    c = c.select(F.col("c_custkey").alias("dynamo_customer_id"), F.col("c_name").alias("customer_name"))
    again = c.filter(F.col("dynamo_customer_id") % 89 == 0)
    return c.unionByName(again.withColumn("customer_name", F.concat("customer_name", F.lit(" II"))))


def tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _read(spark, sf_dir, "part").filter(F.col("p_partkey") % 4 != 3)
    p = p.unionByName(p.filter(F.col("p_partkey") % 97 == 0))
    months = F.array(*[F.lit(m) for m in TIER_MONTHS])
    return p.select(
        _store(F.col("p_partkey")).alias("store_url"),
        F.explode(months).alias("calendar_month"),
        F.concat(F.lit("T"), (F.col("p_size") % 3).cast("string")).alias("tier_net_lm"),
    )


def stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _read(spark, sf_dir, "part").filter(F.col("p_partkey") % 17 != 16)
    day = F.col("p_partkey") % 365
    both = F.when(F.col("p_partkey") % 103 == 0, F.array(day, day + 200)).otherwise(F.array(day))
    return p.select("p_partkey", F.explode(both).alias("day")).select(
        _store(F.col("p_partkey")).alias("store_url"),
        _days_after(STORE_CREATED_DAY_ZERO, F.col("day")).cast("timestamp_ntz").alias("create_date_tz"),
    )


def load(spark: SparkSession, sf_dir: str) -> Sources:
    """All six inputs for one test-data directory."""
    return from_frames(
        sales=sales(spark, sf_dir),
        portfolio=portfolio(spark, sf_dir),
        portfolio_size=portfolio_size(spark, sf_dir),
        buyers=buyers(spark, sf_dir),
        tier=tier(spark, sf_dir),
        stores=stores(spark, sf_dir),
    )
