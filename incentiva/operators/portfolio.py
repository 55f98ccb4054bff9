"""Portfolio chain: sales -> portfolio sales -> bonus detail -> store graduation -> totals.

One implementation serves every population (old and new stores differ only in
population name, portfolio-size column and ladder). Functions take a list of
populations and carry a ``population`` column, so both populations can be
computed in one pass over the sales; the single-population forms drop it.

Plan shape (bonus detail), chosen for a very large sales table:

1. valid sales of the month (range filter pushed to the scan, month partitions
   pruned when the table has them);
2. the population's portfolio and the buyer table are measured (once per input
   bundle). A small one is broadcast raw and joined map-side to the sale lines
   *before* the first shuffle -- the original's join-then-aggregate, so
   duplicate dimension rows multiply exactly as in SQL, and stores outside the
   population never reach a shuffle;
3. a large portfolio instead meets sales pre-aggregated to (store, leader,
   buyer), collapsed to one row per distinct value with a copy count (sums are
   multiplied by it); a large buyer table is shuffle-joined on (buyer, salt),
   where missing buyers get a spread salt, and summed per name with no further
   exchange;
4. one aggregate per (mentor, advisor, store, leader, buyer, name) with map-side
   partial aggregation -- the per-order step of the original SQL is not needed
   for these sums (decimal sums of sums are equal).

A hot store or buyer stays bounded: the partial aggregate collapses its lines
to one row per (store, leader, buyer) in each task before any shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import ladder as L
from ..functions.scalars import flag_at_least, share, shortfall
from ..params import DEFAULT, Params, Population
from ..sources.schemas import sum_money
from ..sources.tables import Sources
from .joins import MULTIPLICITY, checked_broadcast, copies, salted_join, times, with_multiplicity
from .sales import sales_by_order, valid_sales

POP = "population"
SALT = "__salt"
DETAIL_KEYS = ["mentora", "orientador", "store_url", "leader_name", "dynamo_customer_id", "customer_name"]
DETAIL_COLUMNS = DETAIL_KEYS + ["total_cliente", "flag_bono", "falta"]


def _pops(params: Params, populations: Sequence[str | Population] | None) -> list[Population]:
    """The named populations; None: all that are configured."""
    if populations is None:
        return list(params.populations)
    return [p if isinstance(p, Population) else params.population(p) for p in populations]


def population_portfolio(portfolio: DataFrame, populations: Sequence[Population], params: Params = DEFAULT) -> DataFrame:
    """Portfolio rows of stores not in retention and in the given populations."""
    return portfolio.filter(
        (F.col("flag_retencion") == F.lit(params.retention_value))
        & F.col("flag_emprendedor").isin(*[p.name for p in populations])
    ).select("emprendedor", "mentora", "orientador", F.col("flag_emprendedor").alias(POP))


def _portfolio_side(src: Sources, pops: list[Population], params: Params, extra: int):
    port = population_portfolio(src.portfolio, pops, params)
    return checked_broadcast(port, params.broadcast_max_bytes, params.broadcast_max_rows, bound=src.size_bound("portfolio"),
                             extra_bytes_per_row=extra, memo=src._sizes,
                             key=("portfolio", params.retention_value, *[p.name for p in pops]))


def portfolio_sales(src: Sources, population: str = "old", params: Params = DEFAULT) -> DataFrame:
    """Per-order sales of the month with the store's mentor, advisor and population.

    The original writes a LEFT JOIN, but its WHERE on the portfolio side makes it
    an inner join; it is written as one. Duplicate portfolio rows duplicate orders.
    A small portfolio drops the other stores' lines before the orders are shuffled.
    """
    pops = _pops(params, [population])
    port, check = _portfolio_side(src, pops, params, 8)
    stores = population_portfolio(src.portfolio, pops, params).select("emprendedor") if check.broadcast else None
    orders = sales_by_order(src.sales, params, stores=stores)
    j = orders.join(port, orders.store_url == port.emprendedor, "inner")
    return j.select(*orders.columns, "mentora", "orientador", F.col(POP).alias("flag_emprendedor"))


def _spend_keys() -> list[str]:
    return [POP, "mentora", "orientador", "store_url", "leader_name", "dynamo_customer_id"]


def buyer_salt() -> Column:
    """Second join key for the buyer join: hash of the buyer id, or of store and
    leader when the buyer is missing (such rows can never match)."""
    key = "dynamo_customer_id"
    return F.when(F.col(key).isNull(), F.xxhash64("store_url", "leader_name")).otherwise(F.xxhash64(key))


def _salted_name_join(spend: DataFrame, known: DataFrame, heavy_rows: int) -> DataFrame:
    """``spend LEFT JOIN known`` as a shuffle join on (buyer, salt), summed per name.

    Missing buyers (which can never match) spread over all reducers by store and
    leader instead of piling onto the one that null hashes to; a buyer with more than
    ``heavy_rows`` (store, leader) pairs is dealt by them as well, and its names are
    repeated per salt (``joins.salted_join``). The salt is a function of the
    grouping keys, so grouping by it as well changes no group, and the join's
    hash partitioning already satisfies the aggregate: no extra exchange. The count that
    finds heavy buyers reads the aggregate that the join reads (one exchange, reused).
    Both sides have one id type since they were loaded.
    """
    key = "dynamo_customer_id"
    j = salted_join(spend, known, [key], ["store_url", "leader_name"], "left", SALT, heavy_rows, F.col("total"))
    group = [c for c in spend.columns if c != "total"] + ["customer_name", SALT]
    return j.groupBy(*group).agg(F.sum("total").alias("total")).drop(SALT)


def _detail_totals(src: Sources, pops: list[Population], params: Params) -> DataFrame:
    """Month spend per (population, mentor, advisor, store, leader, buyer, buyer name).

    Each dimension is measured; the plan depends on which ones are small:

    * both small: both broadcast raw and joined map-side to the sale lines, then
      one aggregate -- the original's join-then-aggregate, duplicates multiplying
      exactly as in SQL, with no work on the dimensions beyond the broadcast;
    * portfolio small, buyers large: portfolio joined map-side, one aggregate per
      buyer and store, then the salted shuffle join with the buyers;
    * portfolio large: sales pre-aggregated per (store, leader, buyer), joined to
      the portfolio collapsed with copy counts; then the buyers, broadcast with
      copy counts when small, else the salted shuffle join.
    """
    key = "dynamo_customer_id"
    sales = valid_sales(src.sales, params).select("store_url", "leader_name", key, "net_value")
    src.size_bounds("portfolio", "buyers")  # in one job
    port = population_portfolio(src.portfolio, pops, params)
    port_b, port_check = _portfolio_side(src, pops, params, 0)
    known = src.buyers.filter(F.col(key).isNotNull()).select(key, "customer_name")
    buyers_b, buyers_check = checked_broadcast(known, params.broadcast_max_bytes, params.broadcast_max_rows,
                                               bound=src.size_bound("buyers"), extra_bytes_per_row=8, shrinks=False)
    keys, scale = _spend_keys(), sum_money(src.sales, "net_value").scale
    if port_check.broadcast:
        lines = sales.join(port_b, sales.store_url == port_b.emprendedor, "inner")
        if buyers_check.broadcast:
            named = lines.join(buyers_b, key, "left")
            return named.groupBy(*keys, "customer_name").agg(F.sum("net_value").alias("total"))
        spend = lines.groupBy(*keys).agg(F.sum("net_value").alias("total"))
    else:
        port_u = with_multiplicity(port, ["emprendedor", "mentora", "orientador", POP])
        pre = sales.groupBy("store_url", "leader_name", key).agg(F.sum("net_value").alias("total"))
        j = pre.join(port_u, pre.store_url == port_u.emprendedor, "inner")
        spend = j.select(*keys, times(F.col("total"), F.col(MULTIPLICITY), scale).alias("total"))
    if buyers_check.broadcast:
        names = F.broadcast(with_multiplicity(known, [key, "customer_name"]))
        j = spend.join(names, key, "left")
        return j.select(*keys, "customer_name", times(F.col("total"), copies(), scale).alias("total"))
    return _salted_name_join(spend, known, params.heavy_key_rows)


def bonus_detail_all(src: Sources, params: Params = DEFAULT,
                     populations: Sequence[str | Population] | None = None) -> DataFrame:
    """Bonus detail of several populations (all, by default) in one pass, with a ``population`` column."""
    pops = _pops(params, populations)
    detail = _detail_totals(src, pops, params)
    kind = sum_money(src.sales, "net_value")
    total = F.col("total").cast(kind)
    # one digit less, so that the difference to the target keeps the whole scale
    narrow = F.col("total").cast(T.DecimalType(37, kind.scale))
    return detail.select(
        POP,
        *DETAIL_KEYS,
        total.alias("total_cliente"),
        flag_at_least(total, params.bonus_min).cast("int").alias("flag_bono"),
        shortfall(narrow, params.bonus_min).alias("falta"),
    )


def bonus_detail(src: Sources, population: str = "old", params: Params = DEFAULT) -> DataFrame:
    """Spend of each buyer in each store of one population, bonus mark and shortfall."""
    return bonus_detail_all(src, params, [population]).drop(POP)


def store_graduation(detail: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Per store: distinct buyers, bonus marks (per detail row) and the graduation flag.

    Bonus marks are summed per detail row, so one buyer under two leader names can
    count twice, while ``clientes`` counts distinct non-null buyers.
    """
    keys = ([POP] if POP in detail.columns else []) + ["mentora", "orientador", "store_url"]
    g = detail.groupBy(*keys).agg(
        F.countDistinct("dynamo_customer_id").cast("bigint").alias("clientes"),
        F.sum("flag_bono").cast("bigint").alias("clientes_bono"),
    )
    return g.withColumn("flag_graduado", flag_at_least(F.col("clientes_bono"), params.graduate_min).cast("int"))


def _per_population(pops: list[Population], fn: Callable[[Population], Column]) -> Column:
    if len(pops) == 1:
        return fn(pops[0])
    out = None
    for p in pops:
        cond = F.col(POP) == p.name
        out = F.when(cond, fn(p)) if out is None else out.when(cond, fn(p))
    return out


def portfolio_totals_all(graduation: DataFrame, portfolio_size: DataFrame, params: Params = DEFAULT,
                         populations: Sequence[str | Population] | None = None,
                         size_bound: tuple[int, int] | None = None) -> DataFrame:
    """Per mentor and advisor: graduated share of the portfolio, payout and next targets.

    The portfolio size is looked up per advisor and population (the size column
    differs per population, so sizes are stacked into one ``cartera`` column). The
    share is taken over the advisor's whole portfolio, also when the advisor's
    stores are split across two mentors.
    """
    pops = _pops(params, populations)
    if POP not in graduation.columns:
        if len(pops) != 1:
            raise ValueError("graduation without a population column needs exactly one population")
        graduation = graduation.withColumn(POP, F.lit(pops[0].name))
    sizes = None
    for p in pops:
        s = portfolio_size.select("orientador", F.lit(p.name).alias(POP), F.col(p.size_col).alias("cartera"))
        sizes = s if sizes is None else sizes.unionByName(s)
    # stacked per population; each row gains a population label (and maybe a copy count)
    sizes_b, check = checked_broadcast(sizes, params.broadcast_max_bytes, params.broadcast_max_rows,
                                       bound=size_bound, extra_bytes_per_row=32, copies=len(pops))
    keys = [POP, "mentora", "orientador", "cartera"]
    if check.broadcast:
        # join each store's flag to its advisor's size map-side, then sum: the SQL's own order
        j = graduation.join(sizes_b, [POP, "orientador"], "left")
        j = j.groupBy(*keys).agg(F.sum("flag_graduado").cast("bigint").alias("total_graduados"))
    else:
        per_advisor = graduation.groupBy(POP, "mentora", "orientador").agg(F.sum("flag_graduado").alias("graduados"))
        sizes_u = with_multiplicity(sizes, [POP, "orientador", "cartera"])
        j = per_advisor.join(sizes_u, [POP, "orientador"], "left")
        graduates = (F.col("graduados") * copies()).cast("bigint")
        j = j.select(*keys, graduates.alias("total_graduados"))
    sh = share(F.col("total_graduados"), F.col("cartera"), strict=params.strict_division)
    j = j.withColumn("porc_graduados", sh)
    pc, tg, top = F.col("porc_graduados"), F.col("total_graduados"), params.top_text
    return j.select(
        POP,
        "mentora",
        "orientador",
        "porc_graduados",
        "cartera",
        "total_graduados",
        _per_population(pops, lambda p: L.unit_rate(pc, p.ladder)).alias("ganancia_unitaria"),
        _per_population(pops, lambda p: L.payout(tg, pc, p.ladder)).alias("ganancia"),
        _per_population(pops, lambda p: L.next_target(pc, p.ladder, top)).alias("porc_meta"),
        _per_population(pops, lambda p: L.next_target_count(F.col("cartera"), pc, p.ladder, top)).alias(
            "emprendedores_meta"
        ),
    )


def portfolio_totals(src: Sources, population: str = "old", params: Params = DEFAULT,
                     detail: DataFrame | None = None) -> DataFrame:
    """Totals of one population; the size column keeps its own name (e.g. ``cartera_nuevos``)."""
    pop = params.population(population)
    if detail is None:
        detail = bonus_detail_all(src, params, [pop])
    grad = store_graduation(detail, params)
    t = portfolio_totals_all(grad, src.portfolio_size, params, [pop], src.size_bound("portfolio_size")).drop(POP)
    return t.withColumnRenamed("cartera", pop.size_col)
