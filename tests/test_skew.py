"""Hot keys: a third of the sales without a buyer id, a third in one store."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from incentiva.operators import commission as C
from incentiva.operators import joins
from incentiva.operators import portfolio as P
from incentiva.params import DEFAULT
from incentiva.sources.tables import from_frames

N = 30_000
PARTS = 16


@pytest.fixture(scope="module")
def skewed(spark):
    ids = F.col("id")
    sales = spark.range(N).select(
        F.make_timestamp_ntz(F.lit(2022), F.lit(12), (ids % 28 + 1).cast("int"), F.lit(12), F.lit(0), F.lit(0))
        .alias("create_date_time_tz"),
        F.lit(None).cast("timestamp_ntz").alias("cancel_date_time_tz"),
        F.lit("PAID").alias("order_status"),
        F.when(ids % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("s"), (ids % 500).cast("string"))).alias("store_url"),
        F.concat(F.lit("L"), (ids % 7).cast("string")).alias("leader_name"),
        F.when(ids % 3 == 1, F.lit(None)).otherwise(ids % 2000).cast("bigint").alias("dynamo_customer_id"),
        ids.alias("order_number"),
        (F.lit(1) + ids % 50).cast("decimal(18,2)").alias("net_value"),
    ).withColumn("create_date_time", F.col("create_date_time_tz"))
    stores = ["hot"] + [f"s{i}" for i in range(500)]
    portfolio = spark.createDataFrame([(s, "m", f"o{i % 5}", 0, "old") for i, s in enumerate(stores)],
                                      "emprendedor string, mentora string, orientador string, flag_retencion int, "
                                      "flag_emprendedor string")
    buyers = spark.range(2000).select(F.col("id").alias("dynamo_customer_id"),
                                      F.concat(F.lit("b"), F.col("id").cast("string")).alias("customer_name"))
    empty = spark.createDataFrame([], "orientador string, cartera int, cartera_nuevos int")
    tier = spark.createDataFrame([], "store_url string, calendar_month date, tier_net_lm string")
    reg = spark.createDataFrame([], "store_url string, create_date_tz timestamp_ntz")
    return from_frames(sales=sales, portfolio=portfolio, portfolio_size=empty, buyers=buyers, tier=tier, stores=reg)


def _max_share(df, *cols) -> float:
    sizes = df.repartition(PARTS, *cols).groupBy(F.spark_partition_id()).count().collect()
    return max(r["count"] for r in sizes) / sum(r["count"] for r in sizes)


def test_salt_spreads_missing_buyers(skewed):
    # buyer-store spend rows as they reach the buyer join
    spend = (skewed.sales.groupBy("store_url", "leader_name", "dynamo_customer_id").agg(F.sum("net_value"))
             .withColumn("__salt", P.buyer_salt()))
    assert spend.filter(F.col("dynamo_customer_id").isNull()).count() > 0
    by_id = _max_share(spend, "dynamo_customer_id")
    by_id_and_salt = _max_share(spend, "dynamo_customer_id", "__salt")
    assert by_id > 0.15  # every missing buyer lands on one reducer
    assert by_id_and_salt < 2.5 / PARTS  # spread evenly


def test_skewed_inputs_same_result_under_both_strategies(spark, skewed):
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = P.bonus_detail(skewed, "old", DEFAULT.with_(broadcast_max_rows=0))
        measured = P.bonus_detail(skewed, "old")
        assert shuffled.exceptAll(measured).count() == 0 and measured.exceptAll(shuffled).count() == 0
        hot = measured.filter(F.col("store_url") == "hot")
        # the hot store's lines collapse to one row per (leader, buyer); missing buyers per leader
        assert hot.count() == hot.select("leader_name", "dynamo_customer_id").distinct().count()
        want = skewed.sales.agg(F.sum("net_value")).first()[0]
        assert measured.agg(F.sum("total_cliente")).first()[0] == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)


def test_aqe_splits_a_hot_store_in_the_portfolio_shuffle_join(spark, skewed):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1024",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4096",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    prev = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df = P.bonus_detail(skewed, "old", DEFAULT.with_(broadcast_max_rows=0))
        df.collect()  # runs this DataFrame's own adaptive plan to its final form
        from incentiva.plans.inspect import explain_string

        final = explain_string(df, "simple")
        assert "isFinalPlan=true" in final
        assert re.search(r"SortMergeJoin\(skew=true\) \[store_url#\d+\]", final), final
    finally:
        for k, v in prev.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_aqe_splits_a_hot_known_buyer_in_the_salted_join(spark):
    """One known buyer in a third of all (store, leader) pairs: AQE splits its reducer."""
    ids = F.col("id")
    sales = spark.range(N).select(
        F.make_timestamp_ntz(F.lit(2022), F.lit(12), (ids % 28 + 1).cast("int"), F.lit(12), F.lit(0), F.lit(0))
        .alias("create_date_time_tz"),
        F.lit(None).cast("timestamp_ntz").alias("cancel_date_time_tz"),
        F.lit("PAID").alias("order_status"),
        F.concat(F.lit("s"), (ids % 997).cast("string")).alias("store_url"),
        F.concat(F.lit("L"), (ids % 13).cast("string")).alias("leader_name"),
        F.when(ids % 3 == 0, F.lit(7)).otherwise(ids % 3000).cast("bigint").alias("dynamo_customer_id"),
        ids.alias("order_number"),
        (F.lit(1) + ids % 50).cast("decimal(18,2)").alias("net_value"),
    ).withColumn("create_date_time", F.col("create_date_time_tz"))
    portfolio = spark.range(997).select(F.concat(F.lit("s"), F.col("id").cast("string")).alias("emprendedor"),
                                        F.lit("m").alias("mentora"), F.lit("o").alias("orientador"),
                                        F.lit(0).alias("flag_retencion"), F.lit("old").alias("flag_emprendedor"))
    buyers = spark.range(3000).select(F.col("id").alias("dynamo_customer_id"),
                                      F.concat(F.lit("b"), F.col("id").cast("string")).alias("customer_name"))
    src = from_frames(sales=sales, portfolio=portfolio, buyers=buyers,
                      portfolio_size=spark.createDataFrame([], "orientador string, cartera int, cartera_nuevos int"),
                      tier=spark.createDataFrame([], "store_url string, calendar_month date, tier_net_lm string"),
                      stores=spark.createDataFrame([], "store_url string, create_date_tz timestamp_ntz"))
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1024",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4096",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    prev = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df = P.bonus_detail(src, "old", DEFAULT.with_(broadcast_max_rows=0))
        rows = df.collect()
        from incentiva.plans.inspect import explain_string

        final = explain_string(df, "simple")
        assert re.search(r"SortMergeJoin\(skew=true\) \[dynamo_customer_id#\d+L, __salt#\d+L\]", final), final
        hot = [r for r in rows if r.dynamo_customer_id == 7]
        assert len(hot) == len({(r.store_url, r.leader_name) for r in hot}) > 1000  # one row per store, leader
        assert sum(r.total_cliente for r in rows) == sales.agg(F.sum("net_value")).first()[0]
    finally:
        for k, v in prev.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


NO_AQE_SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.enabled": "false",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": str(PARTS),
}


@pytest.fixture
def no_aqe_skew(spark):
    prev = {k: spark.conf.get(k, None) for k in NO_AQE_SKEW}
    for k, v in NO_AQE_SKEW.items():
        spark.conf.set(k, v)
    yield
    for k, v in prev.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _largest_task(df) -> float:
    """Share of the rows of a join's largest output partition."""
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    return max(sizes) / sum(sizes)


def test_a_hot_known_buyer_is_spread_without_aqe(spark, no_aqe_skew):
    ids = F.col("id")
    spend = spark.range(N).select(F.concat(F.lit("s"), (ids % 997).cast("string")).alias("store_url"), F.concat(F.lit("L"), ids.cast("string")).alias("leader_name"),
                                  F.when(ids % 3 == 0, 7).when(ids % 3 == 1, None).otherwise(ids % 3000).cast("bigint").alias("dynamo_customer_id"),
                                  F.lit(1).cast("decimal(28,2)").alias("total"))
    known = spark.range(3000).select(ids.alias("dynamo_customer_id"), F.concat(F.lit("b"), ids.cast("string")).alias("customer_name"))
    known = known.union(known.where(F.col("dynamo_customer_id") == 7))
    keys, spread = ["dynamo_customer_id"], ["store_url", "leader_name"]
    salted = joins.salted_join(spend, known, keys, spread, "left", "__salt", 1000, F.col("total"))
    plain = spend.join(known, keys, "left")
    assert salted.drop("__salt").select(plain.columns).exceptAll(plain).count() == 0 and salted.count() == plain.count()
    assert _largest_task(plain) > 0.4 and _largest_task(salted) < 2 / PARTS
    light = joins.salted_join(spend, known, keys, spread, "left", "__salt", 10 ** 6, F.col("total"))
    assert light.count() == plain.count() and _largest_task(light) > 0.3  # what the measured count is for


def test_lines_of_a_hot_or_missing_store_are_spread_in_the_tier_join(spark, no_aqe_skew):
    ids = F.col("id")
    sales = spark.range(N).select(
        F.make_timestamp_ntz(F.lit(2022), F.lit(12), (ids % 28 + 1).cast("int"), F.lit(12), F.lit(0), F.lit(0)).alias("create_date_time_tz"),
        F.lit(None).cast("timestamp_ntz").alias("cancel_date_time_tz"), F.lit("PAID").alias("order_status"),
        F.when(ids % 3 == 0, F.lit("hot")).when(ids % 3 == 1, None).otherwise(F.concat(F.lit("s"), (ids % 500).cast("string"))).alias("store_url"),
        F.lit("L").alias("leader_name"), F.lit(1).cast("bigint").alias("dynamo_customer_id"), ids.alias("order_number"),
        F.lit(1).cast("decimal(18,2)").alias("net_value")).withColumn("create_date_time", F.col("create_date_time_tz"))
    stores = ["hot", "hot"] + [f"s{i}" for i in range(0, 500, 2)]
    tier = spark.createDataFrame([(s, dt.date(2022, 12, 1), f"T{i}") for i, s in enumerate(stores)], "store_url string, calendar_month date, tier_net_lm string")
    empty = spark.createDataFrame([], "store_url string, create_date_tz timestamp_ntz")
    src = from_frames(sales=sales, tier=tier, stores=empty,
                      portfolio=spark.createDataFrame([], "emprendedor string, mentora string, orientador string, flag_retencion int, flag_emprendedor string"),
                      buyers=spark.createDataFrame([], "dynamo_customer_id bigint, customer_name string"),
                      portfolio_size=spark.createDataFrame([], "orientador string, cartera int, cartera_nuevos int"))
    for required in (True, False):
        small = C.sales_with_tier(src, DEFAULT.with_(tier_required=required))
        large = C.sales_with_tier(src, DEFAULT.with_(tier_required=required, broadcast_max_rows=0, heavy_key_rows=500))
        assert large.columns == small.columns
        assert large.exceptAll(small).count() == 0 and large.count() == small.count()
        plain = C.valid_sales_after(src.sales).join(tier, ["store_url", "calendar_month"], "inner" if required else "left")
        assert _largest_task(plain) > 0.4 and _largest_task(large) < 3 / PARTS, required


def test_half_month_totals_of_a_store_with_very_many_leaders(spark, no_aqe_skew):
    ids = F.col("id")
    daily = spark.range(N).select(
        F.lit(None).cast("date").alias("creation_date"), F.make_date(F.lit(2022), F.lit(12), (ids % 30 + 1).cast("int")).alias("calendar_date"),
        F.when(ids % 30 < 15, 1).otherwise(2).alias("quincena"), F.lit(dt.date(2022, 12, 1)).alias("calendar_month"),
        F.when(ids % 10 < 5, "hot").when(ids % 10 < 9, None).otherwise(F.concat(F.lit("s"), (ids % 100).cast("string"))).alias("store_url"),
        F.concat(F.lit("L"), ids.cast("string")).alias("leader_name"), F.when(ids % 2 == 0, "T").alias("tier_net_lm"),
        (ids % 7).cast("decimal(38,2)").alias("total"))
    got = C.with_half_month_total(daily)
    window = daily.withColumn("venta_quincenal", F.sum("total").over(Window.partitionBy(*C.HALF_MONTH_KEYS)))
    assert got.columns == window.columns
    assert got.exceptAll(window).count() == 0 and got.count() == N
    assert _largest_task(window) > 0.2 and _largest_task(got) < 2.5 / PARTS
