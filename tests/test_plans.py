"""Plan checks: what reaches the scan, which joins are chosen, where the shuffles are."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from conftest import SF_CHECK
from incentiva.functions.scalars import month_start
from incentiva.operators import commission as C
from incentiva.operators import portfolio as P
from incentiva.operators import sales as S
from incentiva.params import DEFAULT
from incentiva.plans.inspect import count_nodes, explain_string, pushed_filters, read_schemas
from incentiva.sources import testdata
from incentiva.sources.tables import Sources, from_frames

NO_BROADCAST = DEFAULT.with_(broadcast_max_rows=0)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """The sf0.01 inputs with sales stored as a real parquet table, flat and month-partitioned."""
    d = tmp_path_factory.mktemp("sales")
    src = testdata.load(spark, SF_CHECK)
    src.sales.write.parquet(str(d / "flat"))
    src.sales.withColumn("sale_month", month_start(F.to_date("create_date_time_tz"))).write.partitionBy(
        "sale_month").parquet(str(d / "by_month"))
    flat = spark.read.parquet(str(d / "flat"))
    by_month = spark.read.parquet(str(d / "by_month"))
    others = {k: getattr(src, k) for k in ("portfolio", "portfolio_size", "buyers", "tier", "stores")}
    return {
        "flat": from_frames(sales=flat, **others),
        "by_month": Sources(sales=by_month, **others).conformed("sale_month"),
    }


@pytest.fixture
def shuffle_only(spark):
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield NO_BROADCAST
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)


def test_month_filter_reaches_the_parquet_scan(stored):
    pf = " ".join(pushed_filters(S.valid_sales(stored["flat"].sales)))
    assert "GreaterThanOrEqual(create_date_time_tz,2022-12-01T00:00)" in pf
    assert "LessThan(create_date_time_tz,2023-01-01T00:00)" in pf
    assert "IsNotNull(create_date_time)" in pf and "IsNull(cancel_date_time_tz)" in pf
    pf_after = " ".join(pushed_filters(S.valid_sales_after(stored["flat"].sales)))
    assert "GreaterThanOrEqual(create_date_time_tz,2022-12-01T00:00)" in pf_after


def test_month_partitions_are_pruned(stored):
    params = DEFAULT.with_(sales_month_col="sale_month")
    plan = explain_string(S.valid_sales(stored["by_month"].sales, params))
    assert re.search(r"PartitionFilters: \[.*\(sale_month#\d+ = 2022-12-01\)", plan), plan
    plan_after = explain_string(S.valid_sales_after(stored["by_month"].sales, params))
    assert re.search(r"PartitionFilters: \[.*\(sale_month#\d+ > 2022-11-01\)", plan_after)
    # same rows either way
    a = P.bonus_detail(stored["by_month"], "old", params).count()
    b = P.bonus_detail(stored["flat"], "old").count()
    assert a == b > 4000


def test_detail_reads_only_needed_sales_columns(stored):
    schemas = read_schemas(P.bonus_detail(stored["flat"], "old"))
    sales_schema = [s for s in schemas if "net_value" in s][0]
    assert "order_number" not in sales_schema
    for c in ("create_date_time_tz", "store_url", "leader_name", "dynamo_customer_id", "net_value"):
        assert c in sales_schema


def test_detail_scans_sales_once_and_broadcasts_small_dimensions(stored):
    df = P.bonus_detail(stored["flat"], "old")
    plan = explain_string(df, "simple")
    assert len(re.findall(r"FileScan parquet \[[^\]]*net_value", plan)) == 1
    assert count_nodes(df, "BroadcastHashJoin") == 2  # portfolio and buyers, both measured small
    assert count_nodes(df, "SortMergeJoin") == 0
    assert count_nodes(df, "Exchange") == 1  # the one aggregate; no dimension is shuffled


def test_both_populations_in_one_scan(stored):
    df = P.bonus_detail_all(stored["flat"])
    assert len(re.findall(r"FileScan parquet \[[^\]]*net_value", explain_string(df, "simple"))) == 1


def test_large_buyer_table_uses_salted_shuffle_join(stored, shuffle_only):
    df = P.bonus_detail(stored["flat"], "old", shuffle_only)
    plan = explain_string(df, "simple")
    assert re.search(r"SortMergeJoin \[dynamo_customer_id#\d+L, __salt#\d+L\]", plan), plan
    # the aggregate per buyer name follows the join without another exchange
    assert not re.search(r"Exchange hashpartitioning\(population", plan.split("SortMergeJoin [dynamo")[0])
    assert _scans_run(P.bonus_detail(stored["flat"], "old", shuffle_only)) == 1


def test_large_portfolio_is_joined_after_preaggregation(stored, shuffle_only):
    plan = explain_string(P.bonus_detail(stored["flat"], "old", shuffle_only), "simple")
    below_store_join = plan.split("SortMergeJoin [store_url")[1]
    assert "partial_sum(net_value" in below_store_join


def _scans_run(df) -> int:
    """Scans of the sales that run: those of reused exchanges are not listed again in the final plan."""
    df.collect()
    plan = explain_string(df, "simple")
    assert "isFinalPlan=true" in plan
    final = plan.split("== Initial Plan ==")[0]
    return len(re.findall(r"FileScan parquet \[[^\]]*net_value", final))


@pytest.mark.parametrize("strategy", ["broadcast", "shuffle"])
def test_tracker_reads_sales_once_and_has_no_window(stored, shuffle_only, strategy):
    df = C.commission_tracker(stored["flat"], shuffle_only if strategy == "shuffle" else DEFAULT, sort=False)
    assert "Window" not in explain_string(df, "simple")
    assert _scans_run(df) == 1  # the half-month totals reuse the daily aggregate's exchange


@pytest.mark.parametrize("layout, column, equal, after", [
    ("yyyy-MM", "m", r"\(m#\d+ = 2022-12\)", r"\(m#\d+ > 2022-11\)"),
    ("yyyyMM", "m", r"\(m#\d+ = 202212\)", r"\(m#\d+ > 202211\)"),
    ("year,month", "year,month", r"\(year#\d+ = 2022\).*\(month#\d+ = 12\)", r"\(year#\d+ > 2022\) OR \(\(year#\d+ = 2022\) AND \(month#\d+ >= 12\)"),
])
def test_month_partitions_of_other_layouts_are_pruned(spark, stored, tmp_path, layout, column, equal, after):
    sales = stored["flat"].sales
    if "," in layout:
        parts = {"year": F.year("create_date_time_tz"), "month": F.month("create_date_time_tz")}
    else:
        parts = {"m": F.date_format(F.col("create_date_time_tz").cast("timestamp"), layout)}
    sales.withColumns(parts).write.partitionBy(*parts).parquet(str(tmp_path / "sales"))
    read = spark.read.parquet(str(tmp_path / "sales"))
    others = {n: getattr(stored["flat"], n) for n in ("portfolio", "portfolio_size", "buyers", "tier", "stores")}
    src = from_frames(sales_month_col=column, sales=read, **others)
    params = DEFAULT.with_(sales_month_col=column)
    plan = explain_string(S.valid_sales(src.sales, params))
    assert re.search(r"PartitionFilters: \[.*" + equal, plan), plan
    plan = explain_string(S.valid_sales_after(src.sales, params))
    assert re.search(r"PartitionFilters: \[.*" + after, plan), plan
    assert S.misplaced_sales(src.sales, params).count() == 0
    assert P.bonus_detail(src, "old", params).exceptAll(P.bonus_detail(stored["flat"], "old")).count() == 0
    assert S.valid_sales_after(src.sales, params).count() == S.valid_sales_after(sales).count()
    wrong = src.sales.withColumn(column.split(",")[-1], F.lit(1 if "," in layout else "2022-01" if "-" in layout else 202201))
    assert S.misplaced_sales(wrong, params).count() > 0


def test_tracker_small_dimensions_join_the_lines_map_side(stored):
    plan = explain_string(C.commission_tracker(stored["flat"]), "simple")
    tier_join = re.search(r"BroadcastHashJoin \[store_url#\d+, calendar_month", plan).start()
    final_agg = plan.index("HashAggregate(keys=[creation_date")
    assert final_agg < tier_join  # one aggregate, above the map-side joins
    assert "with_multiplicity" not in plan and "functions=[count(1)]" not in plan  # no dimension dedupe


def test_tracker_large_dimensions_join_the_daily_aggregate(stored, shuffle_only):
    plan = explain_string(C.commission_tracker(stored["flat"], shuffle_only), "simple")
    tier_join = re.search(r"SortMergeJoin \[store_url#\d+, calendar_month", plan).start()
    daily_agg = plan.index("HashAggregate(keys=[calendar_date")
    sales_scan = re.search(r"FileScan parquet \[[^\]]*net_value", plan).start()
    assert tier_join < daily_agg < sales_scan  # the join sits above the aggregate of the sales


def test_tracker_sort_breaks_ties_for_range_partitioning(stored):
    plan = explain_string(C.commission_tracker(stored["flat"]), "simple")
    assert re.search(r"rangepartitioning\(creation_date#\d+ DESC NULLS FIRST, store_url", plan)


def test_large_table_with_small_filtered_part_is_still_broadcast(spark):
    from incentiva.operators.joins import checked_broadcast

    big = spark.range(5000).withColumn("k", F.col("id") % 7)
    small = big.filter(F.col("id") < 10)
    _, check = checked_broadcast(small, max_bytes=10**9, max_rows=100, bound=(5000, 5000 * 24))
    assert check.broadcast and check.rows == 10
    _, check = checked_broadcast(big, max_bytes=10**9, max_rows=100, bound=(5000, 5000 * 24))
    assert not check.broadcast


def test_totals_prune_the_unused_distinct_count(stored):
    df = P.portfolio_totals(stored["flat"], "old")
    plan = explain_string(df, "simple")
    assert "count(distinct" not in plan.lower() and "Expand" not in plan
    # detail aggregate, store graduation, advisor totals: one exchange each (the fixture's own
    # portfolio-size view adds one more, keyed by brand)
    assert len(re.findall(r"Exchange hashpartitioning\(population", plan)) == 3
