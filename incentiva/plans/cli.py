"""Run the whole job: the five reports for one month.

    spark-submit --py-files incentiva.zip run_job.py --parquet-root s3://lake/shop --out s3://lake/reports/2022-12
    python -m incentiva.plans.cli --tables sales=shop.sale_lines,portfolio=crm.portfolio,... --out ...

Inputs are either catalog tables (``--tables name=table,...``) or folders under
one root (``--root``, one folder per input: sales, portfolio, portfolio_size,
buyers, tier, stores) in parquet, orc, csv or json (``--input-format``). The session comes from the environment
(spark-submit / the platform); nothing here sets cluster resources.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from ..params import Params
from ..sources.schemas import SCHEMAS
from ..sources.tables import from_files, from_tables, require_unique_dimensions
from .reports_job import run_reports
from .session import apply_cluster_conf


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    ap = argparse.ArgumentParser(prog="incentiva", description=__doc__.split("\n\n")[0])
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--tables", help="name=table pairs for " + ", ".join(SCHEMAS))
    src.add_argument("--root", "--parquet-root", dest="root", help="folder with one folder per input")
    ap.add_argument("--input-format", default="parquet", choices=["parquet", "orc", "csv", "json"],
                    help="file format of the input folders under --root")
    ap.add_argument("--out", required=True, help="output folder for the report tables")
    ap.add_argument("--month", default=None, help="report month, e.g. 2022-12-01")
    ap.add_argument("--tracker-after", default=None,
                    help="the tracker covers months strictly after this one")
    ap.add_argument("--sales-month-col", default=None,
                    help="month partition column of the sales table (date, whole number yyyymm or text), or two: year,month")
    ap.add_argument("--sales-month-format", default=None, help="pattern of a text month column, e.g. yyyy-MM")
    ap.add_argument("--sales-month-type", default="date", help="type of the month column of csv and json inputs: date, int or string")
    ap.add_argument("--allow-float", action="store_true", help="accept floating amounts, kept to six decimal places")
    ap.add_argument("--keep-runs", type=int, default=None, help="delete all but so many of the newest published runs")
    ap.add_argument("--zone", default=None,
                    help="zone whose wall clock dates the sales, when timestamps are stored zoned")
    ap.add_argument("--all-stores", action="store_true", help="keep tracker sales without a tier row")
    ap.add_argument("--bonus-min", default=None, help="month spend that earns a bonus mark")
    ap.add_argument("--graduate-min", type=int, default=None, help="bonus marks to graduate")
    ap.add_argument("--params-file", default=None,
                    help="JSON object of further parameters (Params.from_json): ladders and populations, cut date, labels, "
                         "null order, strict division; the options above win where both are given")
    ap.add_argument("--missing-date-text", default=None, help="text for a missing date in the commission report")
    ap.add_argument("--format", default="parquet", choices=["parquet", "orc", "json", "csv"],
                    help="report format")
    ap.add_argument("--require-unique-dimensions", action="store_true",
                    help="fail when a dimension repeats a key instead of multiplying sales")
    ap.add_argument("--keep-session-conf", action="store_true",
                    help="do not apply the job's cluster SQL settings (plans.session.CLUSTER_CONF)")
    return ap.parse_args(argv)


def _params(a: argparse.Namespace) -> Params:
    given = {}
    if a.params_file:
        with open(a.params_file, encoding="utf-8") as f:
            given = json.load(f)
    options = {"month": a.month, "tracker_after_month": a.tracker_after, "sales_month_col": a.sales_month_col,
               "sales_month_format": a.sales_month_format,
               "bonus_min": a.bonus_min, "graduate_min": a.graduate_min, "tier_required": False if a.all_stores else None}
    return Params.from_json(given | {k: v for k, v in options.items() if v is not None})


def main(argv: list[str] | None = None) -> str:
    a = parse_args(argv)
    spark = SparkSession.builder.appName("incentiva-reports").getOrCreate()
    if not a.keep_session_conf:
        apply_cluster_conf(spark)
    if a.tables:
        names = dict(kv.split("=", 1) for kv in a.tables.split(","))
        missing = sorted(set(SCHEMAS) - set(names))
        if missing:
            raise SystemExit(f"--tables lacks {missing}")
        src = from_tables(spark, names, a.sales_month_col, a.zone, a.allow_float)
    else:
        root = a.root.rstrip("/")
        src = from_files(spark, {n: f"{root}/{n}" for n in SCHEMAS}, a.input_format,
                         sales_month_col=a.sales_month_col, zone=a.zone, allow_float=a.allow_float,
                         sales_month_type=a.sales_month_type)
    if a.require_unique_dimensions:
        require_unique_dimensions(src)
    paths = run_reports(spark, src, a.out, _params(a), fmt=a.format, missing_date_text=a.missing_date_text, keep_runs=a.keep_runs)
    return paths.root


def console() -> None:
    """Console-script entry: run and print the report folder."""
    print(main())


if __name__ == "__main__":
    console()
