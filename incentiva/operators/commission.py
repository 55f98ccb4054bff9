"""Commission tracker: daily sales per store and tier, half-month totals, scheme label.

Plan shape, chosen for a very large sales table:

1. valid sales of every month after the cut month (range filter pushed to the
   scan, month partitions pruned when the table has them);
2. tier per (store, month) and store register are measured (once per input
   bundle). When both are small they are broadcast raw and joined map-side to
   the sale lines, then one aggregate per (creation day, day, store, leader,
   tier) -- the SQL's own order, duplicates multiplying as in SQL;
3. otherwise sales are first pre-aggregated to (day, store, leader) with
   map-side partial aggregation, and the dimensions, collapsed to distinct rows
   with a copy count, are joined to that much smaller aggregate;
4. the half-month total is one more aggregate of that table, per (store, half, month)
   and with map-side partial sums, joined back. Its rows are repeated over a few salts,
   by which the daily rows are dealt (hash of leader, day and tier), so a store with very many
   leaders, or the sales without a store (kept only without ``tier_required``), are in
   no single task; a window over the store would hold them all in one;
5. sales without a store would also be one reducer of the shuffle joins, however many
   there are. They get a salt there (they match nothing, so they may go anywhere).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import as_month, half_month, month_start, sale_date, scheme_label
from ..params import DEFAULT, Params
from ..sources.schemas import sum_money
from ..sources.tables import Sources
from .joins import MULTIPLICITY, checked_broadcast, copies, salted_join, times, with_multiplicity
from .sales import valid_sales_after

TRACKER_COLUMNS = [
    "creation_date", "calendar_date", "calendar_month", "quincena", "store_url", "leader_name",
    "tier_net_lm", "total", "venta_quincenal", "comision",
]
HALF_MONTH_KEYS = ["store_url", "quincena", "calendar_month"]


def _tier_for_tracker(tier: DataFrame, params: Params) -> DataFrame:
    # a sale month after the cut month can only meet a tier row of such a month
    after = as_month(params.tracker_after_month)
    return tier.filter(F.col("calendar_month") > F.lit(after)).select("store_url", "calendar_month", "tier_net_lm")


def sales_with_tier(src: Sources, params: Params = DEFAULT) -> DataFrame:
    """Valid sale lines after the cut month with the store's tier of that month.

    The join key month is derived from the sale day before the join. With
    ``tier_required`` (the default) a sale without a tier row is dropped. A large tier
    table meets the lines in a salted shuffle join: lines without a store are spread, and
    those of a store and month with very many are dealt over salts.
    """
    how = "inner" if params.tier_required else "left"
    sales = valid_sales_after(src.sales, params).select(
        "calendar_date", "calendar_month", "store_url", "leader_name", "dynamo_customer_id", "order_number",
        "net_value",
    )
    tier = _tier_for_tracker(src.tier, params)
    tier, check = checked_broadcast(tier, params.broadcast_max_bytes, params.broadcast_max_rows,
                                    bound=src.size_bound("tier"), memo=src._sizes, key=("tier", params.tracker_after_month))
    keys = ["store_url", "calendar_month"]
    if check.broadcast:
        return sales.join(tier, keys, how)
    spread = ["order_number", "dynamo_customer_id", "leader_name", "calendar_date"]
    return salted_join(sales, tier, keys, spread, how, SALT, params.heavy_key_rows).drop(SALT)


def half_month_sales(src: Sources, params: Params = DEFAULT) -> DataFrame:
    """Valid sales per store, month and half month (1 = days 1-15), after the cut month."""
    sales = valid_sales_after(src.sales, params)
    return sales.groupBy(
        "store_url", "calendar_month", half_month(F.col("calendar_date")).alias("quincena")
    ).agg(F.sum("net_value").cast(sum_money(sales, "net_value")).alias("venta_quincenal"))


def daily_store_sales(src: Sources, params: Params = DEFAULT) -> DataFrame:
    """Valid sales per day, store and leader after the cut month (pre-aggregate)."""
    sales = valid_sales_after(src.sales, params)
    return sales.groupBy("calendar_date", "store_url", "leader_name").agg(F.sum("net_value").alias("total"))


SALT = "__store_salt"


def store_salt() -> Column:
    """Hash of the store; of leader and day for a missing one (which matches nothing, so it may go anywhere)."""
    return F.when(F.col("store_url").isNull(), F.xxhash64("leader_name", "calendar_date")).otherwise(F.xxhash64("store_url"))


#: Tasks over which the daily rows of one store and half month are spread.
HALF_SALTS = 16


def with_half_month_total(daily: DataFrame) -> DataFrame:
    """``daily`` with ``venta_quincenal``, the sum of ``total`` per store (or missing store), half and month."""
    keys = HALF_MONTH_KEYS
    half = daily.groupBy(*keys).agg(F.sum("total").alias("venta_quincenal"))
    half = half.select(*[F.col(k).alias(f"__{k}") for k in keys], "venta_quincenal",
                       F.explode(F.sequence(F.lit(0), F.lit(HALF_SALTS - 1))).alias("__salt"))
    dealt = F.pmod(F.xxhash64("leader_name", "calendar_date", "tier_net_lm"), F.lit(HALF_SALTS)).cast("int")
    same = dealt == F.col("__salt")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return daily.join(half, same, "inner").drop("__salt", *[f"__{k}" for k in keys])


def commission_tracker(src: Sources, params: Params = DEFAULT, sort: bool = True) -> DataFrame:
    """Daily sales per store, leader and tier with the half-month total and scheme label.

    Sorted by creation date descending (missing dates first by default) when ``sort``.
    """
    how = "inner" if params.tier_required else "left"
    money = sum_money(src.sales, "net_value")
    src.size_bounds("tier", "stores")  # in one job
    tier = _tier_for_tracker(src.tier, params)
    stores = src.stores.select("store_url", sale_date(F.col("create_date_tz")).alias("creation_date"))
    tier_b, tier_check = checked_broadcast(tier, params.broadcast_max_bytes, params.broadcast_max_rows,
                                           bound=src.size_bound("tier"), extra_bytes_per_row=8,
                                           memo=src._sizes, key=("tier", params.tracker_after_month))
    stores_b, stores_check = checked_broadcast(stores, params.broadcast_max_bytes, params.broadcast_max_rows,
                                               bound=src.size_bound("stores"), extra_bytes_per_row=8, shrinks=False)
    if tier_check.broadcast and stores_check.broadcast:
        # both small: joined raw, map-side, to the sale lines; one aggregate (the SQL's order)
        lines = valid_sales_after(src.sales, params).select(
            "calendar_date", "calendar_month", "store_url", "leader_name", "net_value")
        j = lines.join(tier_b, ["store_url", "calendar_month"], how).join(stores_b, "store_url", "left")
        j = j.groupBy("creation_date", "calendar_date", "calendar_month", "store_url", "leader_name",
                      "tier_net_lm").agg(F.sum("net_value").alias("total"))
    else:
        # a large dimension: join it to the daily aggregate instead, collapsed with copy counts
        daily = daily_store_sales(src, params).withColumn("calendar_month", month_start(F.col("calendar_date")))
        tier_u = with_multiplicity(tier, ["store_url", "calendar_month", "tier_net_lm"])
        tier_u = tier_u.withColumnRenamed(MULTIPLICITY, "__tier_copies")
        stores_u = with_multiplicity(stores, ["store_url", "creation_date"]).withColumnRenamed(
            MULTIPLICITY, "__store_copies")
        salt = [] if params.tier_required else [SALT]
        if salt:
            daily = daily.withColumn(SALT, store_salt())
            # the same function on the store's side: matches are unchanged
            tier_u, stores_u = (d.withColumn(SALT, F.xxhash64("store_url")) for d in (tier_u, stores_u))
        if tier_check.broadcast:
            tier_u = F.broadcast(tier_u)
        if stores_check.broadcast:
            stores_u = F.broadcast(stores_u)
        j = daily.join(tier_u, ["store_url", "calendar_month", *salt], how).join(stores_u, ["store_url", *salt], "left")
        product = times(F.col("total"), copies("__tier_copies"), money.scale)
        j = j.withColumn("total", times(product, copies("__store_copies"), money.scale))

    j = j.select(
        "creation_date", "calendar_date", "calendar_month",
        half_month(F.col("calendar_date")).alias("quincena"),
        "store_url", "leader_name", "tier_net_lm", F.col("total").cast(money).alias("total"),
    )
    j = with_half_month_total(j)
    created = F.col("creation_date")
    label = scheme_label(created, params.cut_date, params.label_on_or_after, params.label_before,
                         params.label_unknown)
    out = j.select(
        *TRACKER_COLUMNS[:8],
        F.col("venta_quincenal").cast(money).alias("venta_quincenal"),
        label.alias("comision"),
    )
    if sort:
        order = created.desc_nulls_first() if params.nulls_first else created.desc_nulls_last()
        # ties are unspecified in the original; breaking them by the row's keys makes
        # the order deterministic and lets the range partitioner split one hot date
        # (e.g. every store missing from the register) over many sort tasks
        out = out.orderBy(order, "store_url", "calendar_date", "leader_name", "tier_net_lm")
    return out
