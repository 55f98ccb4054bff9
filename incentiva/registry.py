"""Named queries over a test-data directory: ``name -> (spark, sf_dir) -> DataFrame``.

Each builds the six inputs from the driver's tables (``sources.testdata``) and
runs one operator or result of the job over all of them. The ``report_*``
entries write their report into the session's shared folder and return it read
back.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .operators import commission as C
from .operators import portfolio as P
from .operators import sales as S
from .params import DEFAULT, Params
from .plans.session import shared_dir
from .sources import testdata
from .sources.reports import read_report, shape_report, write_report
from .sources.tables import Sources, dimension_duplicates

Query = Callable[[SparkSession, str], DataFrame]


SourceQuery = Callable[[Sources], DataFrame]


def source_queries(params: Params = DEFAULT) -> dict[str, SourceQuery]:
    """Every operator query as a function of the six inputs."""
    all_stores = params.with_(tier_required=False)
    q: dict[str, SourceQuery] = {
        "sales_scan": lambda src: src.sales,
        "dimension_duplicates": dimension_duplicates,
        "portfolio_scan": lambda src: src.portfolio,
        "portfolio_size_scan": lambda src: src.portfolio_size,
        "customer_scan": lambda src: src.buyers,
        "tier_scan": lambda src: src.tier,
        "store_scan": lambda src: src.stores,
        "valid_sales": lambda src: S.valid_sales(src.sales, params),
        "sales_by_order": lambda src: S.sales_by_order(src.sales, params),
        "sales_with_tier": lambda src: C.sales_with_tier(src, params),
        "half_month_sales": lambda src: C.half_month_sales(src, params),
        "commission_tracker": lambda src: C.commission_tracker(src, params),
        "commission_tracker_all_stores": lambda src: C.commission_tracker(src, all_stores),
        "bonus_detail_all_populations": lambda src: P.bonus_detail_all(src, params),
        "portfolio_totals_all_populations": lambda src: P.portfolio_totals_all(
            P.store_graduation(P.bonus_detail_all(src, params), params), src.portfolio_size, params,
            size_bound=src.size_bound("portfolio_size")),
    }
    for pop in ("old", "new"):
        q.update({
            f"portfolio_sales_{pop}": lambda src, pop=pop: P.portfolio_sales(src, pop, params),
            f"bonus_detail_{pop}": lambda src, pop=pop: P.bonus_detail(src, pop, params),
            f"store_graduation_{pop}": lambda src, pop=pop: P.store_graduation(
                P.bonus_detail(src, pop, params), params),
            f"portfolio_totals_{pop}": lambda src, pop=pop: P.portfolio_totals(src, pop, params),
        })
    return q


def _written(spark: SparkSession, report: DataFrame, fmt: str = "parquet") -> DataFrame:
    """A report written to a folder of its own and read back."""
    path = f"{shared_dir(spark)}/report-{uuid.uuid4().hex}"
    write_report(report, path, fmt)
    return read_report(spark, path, report.schema, fmt)


def _report_queries(params: Params) -> dict[str, Query]:
    def detail(pop: str, fmt: str = "parquet") -> Query:
        return lambda s, d: _written(s, shape_report(P.bonus_detail(testdata.load(s, d), pop, params)), fmt)

    def totals(pop: str) -> Query:
        return lambda s, d: _written(s, shape_report(P.portfolio_totals(testdata.load(s, d), pop, params)))

    return {
        "report_detail_old": detail("old"),
        "report_detail_new": detail("new"),
        "report_detail_old_csv": detail("old", "csv"),
        "report_totals_old": totals("old"),
        "report_totals_new": totals("new"),
        "report_commission": lambda s, d: _written(
            s, shape_report(C.commission_tracker(testdata.load(s, d), params), date_text=True)),
    }


def queries(params: Params = DEFAULT) -> dict[str, Query]:
    q: dict[str, Query] = {
        name: (lambda s, d, f=f: f(testdata.load(s, d))) for name, f in source_queries(params).items()
    }
    q.update(_report_queries(params))
    return q
