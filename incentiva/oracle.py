"""DuckDB SQL for every registered query, for the side-by-side correctness check.

The SQL follows the original job's shape literally: aggregate per order, LEFT
JOIN the portfolio with a WHERE on its columns, join then aggregate, band-form
CASE ladders. The Spark plans reorder that work (aggregate before joins, copy
counts for duplicate dimension rows, exact integer share), so equal results
check the rewrites, not just the arithmetic.

Each statement first builds the six inputs from the driver's tables with the
fixture rules of ``incentiva.sources.testdata`` (as CTEs), then runs the query.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from .params import Ladder, Params, Population

FIXTURE_CTES = """
sale_lines AS (
  SELECT *, l.l_orderkey + l.l_partkey AS line,
         CAST(DATE '2022-11-01' + CAST(o.o_orderkey % 92 AS INTEGER) AS TIMESTAMP)
         + to_seconds(CASE WHEN o.o_orderkey % 31 = 0 THEN 86399 ELSE (o.o_orderkey * 7919) % 86400 END) AS created
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN part p ON l.l_partkey = p.p_partkey
),
sales AS (
  SELECT
    created AS create_date_time_tz,
    CASE WHEN o_orderkey % 97 <> 0 THEN created END AS create_date_time,
    CASE WHEN l_returnflag = 'R' AND o_orderkey % 10 = 0 THEN l_shipdate END AS cancel_date_time_tz,
    CASE WHEN o_orderstatus = 'O' THEN 'OPEN'
         WHEN o_orderstatus = 'P' AND o_orderkey % 7 = 0 THEN 'CANCEL'
         WHEN o_orderstatus = 'P' AND o_orderkey % 7 = 1 THEN NULL
         ELSE 'PAID' END AS order_status,
    CASE WHEN line % 37 <> 0 THEN 'store-' || CAST(l_partkey AS VARCHAR) END AS store_url,
    CASE WHEN o_custkey % 2 = 0 THEN p_name ELSE p_name || ' B' END AS leader_name,
    CASE WHEN o_orderkey % 23 <> 0 THEN o_custkey END AS dynamo_customer_id,
    o_orderkey AS order_number,
    CASE WHEN line % 41 <> 0 THEN
      CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))
           * CAST(0.0017 AS DECIMAL(4,4)) AS DECIMAL(18,2)) END AS net_value
  FROM sale_lines
),
portfolio AS (
  SELECT 'store-' || CAST(p_partkey AS VARCHAR) AS emprendedor,
         CASE WHEN p_partkey % 11 = 0 THEN 'mentor-shared' ELSE 'mentor-of-' || p_brand END AS mentora,
         p_brand AS orientador,
         CAST(CASE WHEN p_partkey % 10 = 9 THEN 1 ELSE 0 END AS INTEGER) AS flag_retencion,
         CASE WHEN p_size <= 25 THEN 'old' ELSE 'new' END AS flag_emprendedor
  FROM (SELECT * FROM part UNION ALL SELECT * FROM part WHERE p_partkey % 101 = 0) AS twice
  WHERE p_partkey % 13 <> 12
),
portfolio_counts AS (
  SELECT p_brand AS orientador, 1 + 4 * (CAST(right(p_brand, 1) AS INTEGER) % 5) AS share,
         count(CASE WHEN p_size <= 25 THEN 1 END) AS a, count(CASE WHEN p_size > 25 THEN 1 END) AS b
  FROM part WHERE p_brand <> 'Brand#25' GROUP BY p_brand
),
portfolio_total AS (
  SELECT orientador, CAST((a + share - 1) // share AS INTEGER) AS cartera,
         CAST((b + share - 1) // share AS INTEGER) AS cartera_nuevos
  FROM (SELECT * FROM portfolio_counts UNION ALL SELECT * FROM portfolio_counts WHERE orientador = 'Brand#11') AS twice
),
buyers AS (
  SELECT c_custkey AS dynamo_customer_id, c_name AS customer_name FROM customer WHERE c_custkey % 50 <> 49
  UNION ALL
  SELECT c_custkey, c_name || ' II' FROM customer WHERE c_custkey % 50 <> 49 AND c_custkey % 89 = 0
),
tier AS (
  SELECT 'store-' || CAST(p_partkey AS VARCHAR) AS store_url, calendar_month,
         'T' || CAST(p_size % 3 AS VARCHAR) AS tier_net_lm
  FROM (SELECT * FROM part UNION ALL SELECT * FROM part WHERE p_partkey % 97 = 0) AS twice,
       (VALUES (DATE '2022-11-01'), (DATE '2022-12-01'), (DATE '2023-01-01')) AS months(calendar_month)
  WHERE p_partkey % 4 <> 3
),
entrep AS (
  SELECT 'store-' || CAST(p_partkey AS VARCHAR) AS store_url,
         CAST(DATE '2022-01-01' + CAST(p_partkey % 365 + later AS INTEGER) AS TIMESTAMP) AS create_date_tz
  FROM part, (VALUES (0), (200)) AS days(later)
  WHERE p_partkey % 17 <> 16 AND (later = 0 OR p_partkey % 103 = 0)
)"""

# The scheme's values spelled out once more, so that a wrong constant in ``params`` shows as a difference.
SPELLED_OUT = Params(
    month=dt.date(2022, 12, 1), bonus_min=Decimal("100"), graduate_min=5, excluded_statuses=("CANCEL", "OPEN"), retention_value=0,
    tracker_after_month=dt.date(2022, 11, 1), cut_date=dt.date(2022, 7, 1), label_on_or_after="De 5% a 10%",
    label_before="De 8% a 15%", label_unknown="", top_text="max",
    populations=(
        Population("old", "cartera", Ladder.of(("0.03", 40), ("0.06", 50), ("0.10", 60), ("0.15", 70), ("0.20", 85), ("0.25", 100))),
        Population("new", "cartera_nuevos", Ladder.of(("0.02", 60), ("0.04", 75), ("0.07", 90), ("0.11", 100), ("0.14", 130), ("0.18", 150))),
    ),
)

VALID = (
    "create_date_time IS NOT NULL AND order_status NOT IN ('CANCEL', 'OPEN') "
    "AND cancel_date_time_tz IS NULL"
)
MONTH = "CAST(date_trunc('month', create_date_time_tz) AS DATE)"


def _with(*ctes: str, select: str) -> str:
    """A statement; the fixture's views are put in front by ``oracle_sql``."""
    parts = [c.strip() for c in ctes]
    return ("WITH\n" + ",\n".join(parts) + "\n" if parts else "") + f"{select.strip()}\n"


def _month_orders(params: Params) -> str:
    return f"""
month_orders AS (
  SELECT CAST(create_date_time_tz AS DATE) AS calendar_date, {MONTH} AS calendar_month,
         store_url, leader_name, dynamo_customer_id, order_number,
         CAST(sum(net_value) AS DECIMAL(38,2)) AS total
  FROM sales
  WHERE {VALID} AND {MONTH} = DATE '{params.month.isoformat()}'
  GROUP BY 1, 2, 3, 4, 5, 6
)"""


def _population_orders(pop: str) -> str:
    return f"""
population_orders AS (
  SELECT a.*, b.mentora, b.orientador, b.flag_emprendedor
  FROM month_orders a LEFT JOIN portfolio b ON a.store_url = b.emprendedor
  WHERE b.flag_retencion = 0 AND b.flag_emprendedor = '{pop}'
)"""


def _bonus_detail(bonus_min) -> str:
    return f"""
buyer_spend AS (
  SELECT a.mentora, a.orientador, a.store_url, a.leader_name, a.dynamo_customer_id, b.customer_name,
         CAST(sum(a.total) AS DECIMAL(38,2)) AS total_cliente
  FROM population_orders a LEFT JOIN buyers b ON a.dynamo_customer_id = b.dynamo_customer_id
  GROUP BY 1, 2, 3, 4, 5, 6
),
bonus_detail AS (
  SELECT *,
         CAST(CASE WHEN total_cliente >= {bonus_min} THEN 1 ELSE 0 END AS INTEGER) AS flag_bono,
         CAST(CASE WHEN total_cliente < {bonus_min} THEN round({bonus_min} - total_cliente, 0) ELSE 0 END
              AS DECIMAL(38,0)) AS falta
  FROM buyer_spend
)"""


def _store_graduation(graduate_min: int) -> str:
    return f"""
store_graduation AS (
  SELECT mentora, orientador, store_url,
         CAST(count(DISTINCT dynamo_customer_id) AS BIGINT) AS clientes,
         CAST(sum(flag_bono) AS BIGINT) AS clientes_bono,
         CAST(CASE WHEN sum(flag_bono) >= {graduate_min} THEN 1 ELSE 0 END AS INTEGER) AS flag_graduado
  FROM bonus_detail GROUP BY 1, 2, 3
)"""


def _band_cases(ladder: Ladder, size_col: str, top: str) -> tuple[str, str, str, str]:
    rs = list(ladder.rungs)
    desc = list(reversed(rs))
    rate = " ".join(f"WHEN porc_graduados >= {r.threshold} THEN {r.rate}" for r in desc)
    pay = " ".join(f"WHEN porc_graduados >= {r.threshold} THEN total_graduados * {r.rate}" for r in desc)
    bands = list(reversed(list(zip(rs[:-1], rs[1:]))))
    meta = " ".join(
        f"WHEN {lo.threshold} <= porc_graduados AND porc_graduados < {hi.threshold} THEN '{hi.threshold}'"
        for lo, hi in bands
    )
    count = " ".join(
        f"WHEN {lo.threshold} <= porc_graduados AND porc_graduados < {hi.threshold} "
        f"THEN CAST(CAST(ceil({size_col} * {hi.threshold}) AS BIGINT) AS VARCHAR)"
        for lo, hi in bands
    )
    t, low = ladder.top.threshold, ladder.lowest.threshold
    return (
        f"CAST(CASE {rate} ELSE 0 END AS INTEGER)",
        f"CAST(CASE {pay} ELSE 0 END AS BIGINT)",
        f"CASE WHEN porc_graduados >= {t} THEN '{top}' {meta} ELSE '{low}' END",
        f"CASE WHEN porc_graduados >= {t} THEN '{top}' {count} "
        f"ELSE CAST(CAST(ceil({size_col} * {low}) AS BIGINT) AS VARCHAR) END",
    )


def _advisor_totals(pop: str, params: Params, out_size_col: str | None = None) -> str:
    p = params.population(pop)
    size = p.size_col
    rate, pay, meta, count = _band_cases(p.ladder, size, params.top_text)
    out = out_size_col or size
    return f"""
advisor_graduates AS (
  SELECT a.mentora, a.orientador, b.{size}, CAST(sum(a.flag_graduado) AS BIGINT) AS total_graduados
  FROM store_graduation a LEFT JOIN portfolio_total b ON a.orientador = b.orientador
  GROUP BY 1, 2, 3
),
advisor_share AS (
  SELECT *, CAST(trunc(CAST(total_graduados / NULLIF({size}, 0) AS DECIMAL(18,6)), 4) AS DECIMAL(18,4))
         AS porc_graduados
  FROM advisor_graduates
),
advisor_totals AS (
  SELECT mentora, orientador, porc_graduados, {size} AS {out}, total_graduados,
         {rate} AS ganancia_unitaria, {pay} AS ganancia, {meta} AS porc_meta, {count} AS emprendedores_meta
  FROM advisor_share
)"""


def _portfolio_chain(pop: str, params: Params, upto: str, out_size_col: str | None = None) -> list[str]:
    steps = [_month_orders(params), _population_orders(pop), _bonus_detail(params.bonus_min), _store_graduation(params.graduate_min),
             _advisor_totals(pop, params, out_size_col)]
    n = {"month_orders": 1, "population_orders": 2, "bonus_detail": 3, "store_graduation": 4,
         "advisor_totals": 5}[upto]
    return steps[:n]


def _tracker_groups(params: Params, tier_required: bool) -> str:
    after = params.tracker_after_month.isoformat()
    where_month = f"b.calendar_month > DATE '{after}'" if tier_required else f"{MONTH} > DATE '{after}'"
    return f"""
tracker_daily AS (
  SELECT CAST(c.create_date_tz AS DATE) AS creation_date,
         CAST(a.create_date_time_tz AS DATE) AS calendar_date,
         CAST(date_trunc('month', a.create_date_time_tz) AS DATE) AS calendar_month,
         a.store_url, a.leader_name, b.tier_net_lm, sum(a.net_value) AS total
  FROM sales a
  LEFT JOIN tier b
    ON a.store_url = b.store_url AND CAST(date_trunc('month', a.create_date_time_tz) AS DATE) = b.calendar_month
  LEFT JOIN entrep c ON a.store_url = c.store_url
  WHERE a.create_date_time IS NOT NULL AND a.order_status NOT IN ('CANCEL', 'OPEN')
    AND a.cancel_date_time_tz IS NULL AND {where_month}
  GROUP BY 1, 2, 3, 4, 5, 6
),
tracker AS (
  SELECT creation_date, calendar_date, calendar_month,
         CAST(CASE WHEN extract(day FROM calendar_date) <= 15 THEN 1 ELSE 2 END AS INTEGER) AS quincena,
         store_url, leader_name, tier_net_lm,
         CAST(total AS DECIMAL(38,2)) AS total,
         CAST(sum(total) OVER (PARTITION BY store_url,
                                CASE WHEN extract(day FROM calendar_date) <= 15 THEN 1 ELSE 2 END,
                                date_trunc('month', calendar_date)) AS DECIMAL(38,2)) AS venta_quincenal,
         CASE WHEN creation_date >= DATE '{params.cut_date.isoformat()}' THEN '{params.label_on_or_after}'
              WHEN creation_date < DATE '{params.cut_date.isoformat()}' THEN '{params.label_before}'
              ELSE '{params.label_unknown}' END AS comision
  FROM tracker_daily
)"""


def _upper(cols: list[str]) -> str:
    return ", ".join(f"{c} AS {c.upper()}" for c in cols)


def oracle_sql(params: Params = SPELLED_OUT, fixture: bool = True) -> dict[str, str]:
    """SQL per query key. ``fixture=False`` leaves out the input views, for a
    connection where ``sales portfolio portfolio_total buyers tier entrep`` exist."""
    found = _oracle_sql(params)
    if not fixture:
        return found
    views = FIXTURE_CTES.strip()
    return {k: f"WITH\n{views}\nSELECT * FROM (\n{v}) AS result\n" for k, v in found.items()}


def _oracle_sql(params: Params) -> dict[str, str]:
    after = params.tracker_after_month.isoformat()
    q: dict[str, str] = {
        "sales_scan": _with(select="SELECT * FROM sales"),
        "portfolio_scan": _with(select="SELECT * FROM portfolio"),
        "portfolio_size_scan": _with(select="SELECT * FROM portfolio_total"),
        "customer_scan": _with(select="SELECT * FROM buyers"),
        "tier_scan": _with(select="SELECT * FROM tier"),
        "store_scan": _with(select="SELECT * FROM entrep"),
        "dimension_duplicates": _with(select="""
SELECT 'portfolio' AS dimension, coalesce(CAST(emprendedor AS VARCHAR), '<null>') AS key, count(*) AS copies
FROM portfolio GROUP BY emprendedor HAVING count(*) > 1
UNION ALL
SELECT 'portfolio_size', coalesce(CAST(orientador AS VARCHAR), '<null>'), count(*)
FROM portfolio_total GROUP BY orientador HAVING count(*) > 1
UNION ALL
SELECT 'buyers', coalesce(CAST(dynamo_customer_id AS VARCHAR), '<null>'), count(*)
FROM buyers GROUP BY dynamo_customer_id HAVING count(*) > 1
UNION ALL
SELECT 'tier', coalesce(CAST(store_url AS VARCHAR), '<null>') || '|' || coalesce(CAST(calendar_month AS VARCHAR), '<null>'),
       count(*)
FROM tier GROUP BY store_url, calendar_month HAVING count(*) > 1
UNION ALL
SELECT 'stores', coalesce(CAST(store_url AS VARCHAR), '<null>'), count(*)
FROM entrep GROUP BY store_url HAVING count(*) > 1"""),
        "valid_sales": _with(select=f"""
SELECT *, CAST(create_date_time_tz AS DATE) AS calendar_date, {MONTH} AS calendar_month
FROM sales WHERE {VALID} AND {MONTH} = DATE '{params.month.isoformat()}'"""),
        "sales_by_order": _with(_month_orders(params), select="SELECT * FROM month_orders"),
        "sales_with_tier": _with(select=f"""
SELECT a.store_url, {MONTH.replace('create_date_time_tz', 'a.create_date_time_tz')} AS calendar_month,
       CAST(a.create_date_time_tz AS DATE) AS calendar_date, a.leader_name, a.dynamo_customer_id,
       a.order_number, a.net_value, b.tier_net_lm
FROM sales a
LEFT JOIN tier b
  ON a.store_url = b.store_url AND CAST(date_trunc('month', a.create_date_time_tz) AS DATE) = b.calendar_month
WHERE a.create_date_time IS NOT NULL AND a.order_status NOT IN ('CANCEL', 'OPEN')
  AND a.cancel_date_time_tz IS NULL AND b.calendar_month > DATE '{after}'"""),
        "half_month_sales": _with(select=f"""
SELECT store_url, {MONTH} AS calendar_month,
       CAST(CASE WHEN extract(day FROM create_date_time_tz) <= 15 THEN 1 ELSE 2 END AS INTEGER) AS quincena,
       CAST(sum(net_value) AS DECIMAL(38,2)) AS venta_quincenal
FROM sales WHERE {VALID} AND {MONTH} > DATE '{after}'
GROUP BY 1, 2, 3"""),
        "commission_tracker": _with(_tracker_groups(params, True),
                                    select="SELECT * FROM tracker ORDER BY creation_date DESC NULLS FIRST"),
        "commission_tracker_all_stores": _with(_tracker_groups(params, False),
                                               select="SELECT * FROM tracker ORDER BY creation_date DESC NULLS FIRST"),
    }
    for pop in ("old", "new"):
        q[f"portfolio_sales_{pop}"] = _with(*_portfolio_chain(pop, params, "population_orders"),
                                            select="SELECT * FROM population_orders")
        q[f"bonus_detail_{pop}"] = _with(*_portfolio_chain(pop, params, "bonus_detail"), select="SELECT * FROM bonus_detail")
        q[f"store_graduation_{pop}"] = _with(*_portfolio_chain(pop, params, "store_graduation"),
                                             select="SELECT * FROM store_graduation")
        q[f"portfolio_totals_{pop}"] = _with(*_portfolio_chain(pop, params, "advisor_totals"),
                                             select="SELECT * FROM advisor_totals")
        q[f"report_detail_{pop}"] = _with(*_portfolio_chain(pop, params, "bonus_detail"), select=f"""
SELECT {_upper(['mentora', 'orientador', 'store_url', 'leader_name', 'dynamo_customer_id', 'customer_name',
                'total_cliente', 'flag_bono', 'falta'])} FROM bonus_detail""")
        size = params.population(pop).size_col
        q[f"report_totals_{pop}"] = _with(*_portfolio_chain(pop, params, "advisor_totals"), select=f"""
SELECT {_upper(['mentora', 'orientador', 'porc_graduados', size, 'total_graduados', 'ganancia_unitaria',
                'ganancia', 'porc_meta', 'emprendedores_meta'])} FROM advisor_totals""")
    q["report_commission"] = _with(_tracker_groups(params, True), select="""
SELECT strftime(creation_date, '%Y-%m-%d') AS CREATION_DATE, strftime(calendar_date, '%Y-%m-%d') AS CALENDAR_DATE,
       strftime(calendar_month, '%Y-%m-%d') AS CALENDAR_MONTH, quincena AS QUINCENA, store_url AS STORE_URL,
       leader_name AS LEADER_NAME, tier_net_lm AS TIER_NET_LM, total AS TOTAL, venta_quincenal AS VENTA_QUINCENAL,
       comision AS COMISION
FROM tracker ORDER BY creation_date DESC NULLS FIRST""")
    q["report_detail_old_csv"] = q["report_detail_old"]
    # both populations in one result, with the population as a column
    parts_d, parts_t = [], []
    for pop in ("old", "new"):
        chain_d = _portfolio_chain(pop, params, "bonus_detail")
        chain_t = _portfolio_chain(pop, params, "advisor_totals", out_size_col="cartera")
        parts_d.append(f"({_with(*chain_d, select=f'SELECT {chr(39)}{pop}{chr(39)} AS population, * FROM bonus_detail')})")
        parts_t.append(f"({_with(*chain_t, select=f'SELECT {chr(39)}{pop}{chr(39)} AS population, * FROM advisor_totals')})")
    q["bonus_detail_all_populations"] = "SELECT * FROM " + " UNION ALL SELECT * FROM ".join(
        f"{p} AS t{i}" for i, p in enumerate(parts_d))
    q["portfolio_totals_all_populations"] = "SELECT * FROM " + " UNION ALL SELECT * FROM ".join(
        f"{p} AS t{i}" for i, p in enumerate(parts_t))
    return q
