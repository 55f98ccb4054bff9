"""Report sinks and the one-run report job."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMOKE
from incentiva.operators import commission as C
from incentiva.operators import portfolio as P
from incentiva.plans.reports_job import run_reports
from incentiva.sources import testdata
from incentiva.sources.tables import from_frames
from incentiva.sources.reports import read_report, shape_report, write_report


@pytest.fixture(scope="module")
def src(spark):
    return testdata.load(spark, SF_SMOKE)


def _diff(a, b):
    return a.exceptAll(b).count() + b.exceptAll(a).count()


def test_report_job_writes_all_five(spark, src, tmp_path):
    paths = run_reports(spark, src, str(tmp_path / "out"))
    for pop in ("old", "new"):
        d = read_report(spark, paths.detail(pop))
        assert d.columns == [c.upper() for c in P.DETAIL_COLUMNS]
        assert _diff(d, shape_report(P.bonus_detail(src, pop))) == 0
        t = read_report(spark, paths.totals(pop))
        assert _diff(t, shape_report(P.portfolio_totals(src, pop))) == 0
    c = read_report(spark, paths.commission)
    assert c.schema["CREATION_DATE"].dataType.simpleString() == "string"
    assert _diff(c, shape_report(C.commission_tracker(src, sort=False), date_text=True)) == 0


def test_csv_keeps_empty_text_and_null_apart(spark, src, tmp_path):
    df = shape_report(C.commission_tracker(src), date_text=True)
    path = str(tmp_path / "commission_csv")
    write_report(df, path, "csv")
    back = read_report(spark, path, df.schema, "csv")
    assert _diff(back, df) == 0
    assert back.filter(F.col("COMISION") == "").count() == back.filter(F.col("CREATION_DATE").isNull()).count() > 0


def test_overwrite_leaves_no_stale_rows(spark, src, tmp_path):
    path = str(tmp_path / "detail")
    full = shape_report(P.bonus_detail(src, "old"))
    write_report(full, path)
    write_report(full.limit(3), path)
    assert read_report(spark, path).count() == 3


def test_missing_date_text_option(spark, src):
    df = shape_report(C.commission_tracker(src), date_text=True, missing_date_text="None")
    assert df.filter(F.col("CREATION_DATE").isNull()).count() == 0
    assert df.filter(F.col("CREATION_DATE") == "None").count() > 0


def test_report_job_as_csv(spark, src, tmp_path):
    paths = run_reports(spark, src, str(tmp_path / "csv"), fmt="csv", populations=("new",))
    like = shape_report(P.portfolio_totals(src, "new"))
    back = read_report(spark, paths.totals("new"), like.schema, "csv")
    assert _diff(back, like) == 0
    c_like = shape_report(C.commission_tracker(src, sort=False), date_text=True)
    assert _diff(read_report(spark, paths.commission, c_like.schema, "csv"), c_like) == 0


def test_cli_runs_the_job_from_parquet_inputs(spark, src, tmp_path):
    from incentiva.plans import cli
    from incentiva.sources.schemas import SCHEMAS

    root = tmp_path / "lake"
    for name in SCHEMAS:
        df = getattr(src, name)
        if name == "sales":
            df = df.withColumn("sale_month", F.trunc(F.to_date("create_date_time_tz"), "month"))
            df.write.partitionBy("sale_month").parquet(str(root / name))
        else:
            df.write.parquet(str(root / name))
    out = cli.main(["--parquet-root", str(root), "--out", str(tmp_path / "reports"),
                    "--sales-month-col", "sale_month", "--keep-session-conf"])
    got = read_report(spark, f"{out}/detail_old")
    assert _diff(got, shape_report(P.bonus_detail(src, "old"))) == 0
    assert read_report(spark, f"{out}/commission").count() == C.commission_tracker(src).count()


def test_cli_runs_the_job_from_catalog_tables(spark, src, tmp_path):
    from incentiva.plans import cli
    from incentiva.sources.schemas import SCHEMAS

    # this run asks for unique dimensions, which the fixture's are not
    keys = {"portfolio": ["emprendedor"], "portfolio_size": ["orientador"], "buyers": ["dynamo_customer_id"],
            "tier": ["store_url", "calendar_month"], "stores": ["store_url"]}
    src = from_frames(sales=src.sales, **{n: getattr(src, n).groupBy(*k).agg(*[
        F.min(c).alias(c) for c in getattr(src, n).columns if c not in k]).select(getattr(src, n).columns) for n, k in keys.items()})
    for name in SCHEMAS:
        getattr(src, name).createOrReplaceTempView(f"cli_{name}")
    tables = ",".join(f"{name}=cli_{name}" for name in SCHEMAS)
    out = cli.main(["--tables", tables, "--out", str(tmp_path / "reports"), "--all-stores",
                    "--require-unique-dimensions", "--keep-session-conf", "--bonus-min", "100",
                    "--graduate-min", "5"])
    params = P.DEFAULT.with_(tier_required=False)
    assert read_report(spark, f"{out}/commission").count() == C.commission_tracker(src, params).count()
    assert _diff(read_report(spark, f"{out}/totals_new"), shape_report(P.portfolio_totals(src, "new"))) == 0


@pytest.mark.parametrize("fmt", ["orc", "csv", "json"])
def test_inputs_from_other_file_formats(spark, src, tmp_path, fmt):
    from incentiva.sources.schemas import SCHEMAS
    from incentiva.sources.tables import from_files

    paths = {}
    for name in SCHEMAS:
        path = str(tmp_path / f"{name}_{fmt}")
        w = getattr(src, name).write.format(fmt)
        if fmt == "csv":
            w = w.option("header", True)
        w.save(path)
        paths[name] = path
    loaded = from_files(spark, paths, fmt)
    assert _diff(P.bonus_detail(loaded, "old"), P.bonus_detail(src, "old")) == 0
    assert _diff(C.commission_tracker(loaded, sort=False), C.commission_tracker(src, sort=False)) == 0


@pytest.mark.parametrize("fmt", ["orc", "json"])
def test_report_job_in_other_formats(spark, src, tmp_path, fmt):
    paths = run_reports(spark, src, str(tmp_path / fmt), fmt=fmt, populations=("old",))
    like = shape_report(P.bonus_detail(src, "old"))
    assert _diff(read_report(spark, paths.detail("old"), like.schema, fmt), like) == 0


def _in_file_order(path):
    """Rows of a written table, part file after part file."""
    import glob

    import pyarrow.parquet as pq

    files = sorted(glob.glob(f"{path}/part-*.parquet"))
    return len(files), [r for f in files for r in pq.read_table(f).to_pylist()]


@pytest.mark.parametrize("nulls_first", [True, False])
def test_the_written_commission_report_is_in_order(spark, src, tmp_path, nulls_first):
    """The sort's only lasting effect: part files in order hold newest creation dates first."""
    params = P.DEFAULT.with_(nulls_first=nulls_first)
    prev = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        orders = {}
        for sort in (True, False):
            path = str(tmp_path / f"commission-{sort}")
            write_report(shape_report(C.commission_tracker(src, params, sort=sort), date_text=True), path)
            n, rows = _in_file_order(path)
            dates = [r["CREATION_DATE"] for r in rows]
            assert n > 1 and len(set(dates)) > 10 and None in dates
            newest = sorted((x for x in dates if x is not None), reverse=True)
            missing = [None] * dates.count(None)
            orders[sort] = dates == (missing + newest if nulls_first else newest + missing)
        assert orders == {True: True, False: False}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", prev)
