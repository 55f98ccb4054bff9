"""Loads and filters that must not lose, change or hide anything (each failed on an earlier version)."""

from __future__ import annotations

import datetime as dt
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from incentiva.operators import commission as C
from incentiva.operators import joins
from incentiva.operators import portfolio as P
from incentiva.operators import sales as S
from incentiva.params import DEFAULT, Ladder, Params, Population
from incentiva.plans.inspect import explain_string, pushed_filters
from incentiva.plans.reports_job import current_run, run_reports
from incentiva.sources.reports import read_report
from incentiva.sources.schemas import SchemaError
from incentiva.sources.tables import Sources, from_files, from_frames
from tests_helpers import d, money, sale, sources, ts


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def _one_store(spark, sales, **kw):
    return sources(spark, sales=sales, portfolio=[("s", "m", "o", 0, "old")], portfolio_size=[("o", 10, 10)], **kw)


@pytest.mark.parametrize("text_side", ["sales", "buyers"])
def test_one_id_type_whatever_join_is_chosen(spark, text_side):
    src = _one_store(spark, [sale("2022-12-05 10:00:00", "s", 120, buyer=7), sale("2022-12-05 10:00:00", "s", 30, buyer=8)],
                     buyers=[(7, "ana"), (8, "bo")])
    frames = {n: getattr(src, n) for n in ("sales", "portfolio", "portfolio_size", "buyers", "tier", "stores")}
    padded = F.concat(F.lit("00"), F.col("dynamo_customer_id").cast("string"))
    id_ = F.col("dynamo_customer_id")
    frames[text_side] = frames[text_side].withColumn("dynamo_customer_id", F.when(id_ == 7, padded).otherwise(id_.cast("string")))
    mixed = from_frames(**frames)
    assert mixed.sales.schema["dynamo_customer_id"].dataType == mixed.buyers.schema["dynamo_customer_id"].dataType == T.StringType()
    results = [_rows(P.bonus_detail(mixed, "old", DEFAULT.with_(broadcast_max_rows=n))) for n in (0, 1, 2_000_000)]
    assert results[0] == results[1] == results[2]
    assert {r[5] for r in results[0]} == {None, "bo"}  # '007' and '7' are different ids


ZONED = T.StructType([T.StructField(f.name, T.TimestampType() if isinstance(f.dataType, T.TimestampNTZType) else f.dataType)
                      for f in __import__("incentiva.sources.schemas", fromlist=["SALES"]).SALES] + [T.StructField("sale_month", T.DateType())])


def _zoned(spark, instants):
    rows = []
    for k, text in enumerate(instants):
        t = dt.datetime.fromisoformat(text).replace(tzinfo=dt.timezone.utc)
        rows.append((t, t, None, "PAID", "s", "L", 1, k, money(1), t.date().replace(day=1)))
    return spark.createDataFrame(rows, ZONED)


@pytest.mark.parametrize("zone", ["America/Lima", "Asia/Karachi", "Europe/Madrid", "Pacific/Kiritimati", "America/Sao_Paulo"])
def test_zoned_months_lose_nothing_and_reach_the_scan(spark, tmp_path, zone):
    instants = [f"{day} {h:02d}:30:00" for day in ("2022-10-30", "2022-11-30", "2022-12-01", "2022-12-31", "2023-01-01", "2023-01-31", "2023-02-01")
                for h in range(0, 24, 3)]
    path = str(tmp_path / "sales")
    _zoned(spark, instants).write.partitionBy("sale_month").parquet(path)
    raw = spark.read.parquet(path)
    empty = {n: getattr(sources(spark), n) for n in ("portfolio", "portfolio_size", "buyers", "tier", "stores")}
    src = Sources(sales=raw, **empty).conformed("sale_month", zone)
    params = DEFAULT.with_(sales_month_col="sale_month")
    import zoneinfo

    local = [dt.datetime.fromisoformat(x).replace(tzinfo=dt.timezone.utc).astimezone(zoneinfo.ZoneInfo(zone)) for x in instants]
    for p in (params, DEFAULT):
        got = {r["order_number"] for r in S.valid_sales(src.sales, p).collect()}
        assert got == {k for k, t in enumerate(local) if (t.year, t.month) == (2022, 12)}
        after = {r["order_number"] for r in S.valid_sales_after(src.sales, p).collect()}
        assert after == {k for k, t in enumerate(local) if (t.year, t.month) > (2022, 11)}
    pushed = " ".join(pushed_filters(S.valid_sales(src.sales, params)))
    assert "GreaterThanOrEqual(create_date_time_tz," in pushed and "LessThan(create_date_time_tz," in pushed
    assert "__create_instant" not in S.valid_sales(src.sales, params).columns


def test_misplaced_sales_are_reported(spark):
    df = sources(spark, sales=[sale("2022-12-31 23:00:00", "s", 1), sale("2022-12-01 00:00:00", "s", 1)]).sales
    df = df.withColumn("sale_month", F.lit(dt.date(2022, 12, 1)))
    moved = df.withColumn("sale_month", F.when(F.dayofmonth("create_date_time_tz") == 31, F.lit(dt.date(2023, 1, 1))).otherwise(F.col("sale_month")))
    params = DEFAULT.with_(sales_month_col="sale_month")
    assert S.misplaced_sales(df, params).count() == 0
    assert [tuple(r) for r in S.misplaced_sales(moved, params).collect()] == [(d("2023-01-01"), d("2022-12-01"), 1)]


def _with_vip(spark):
    src = sources(spark, sales=[sale("2022-12-05 10:00:00", s, 150, order=i) for i, s in enumerate(("a", "b", "c"))],
                  portfolio=[("a", "m", "o", 0, "old"), ("b", "m", "o", 0, "new"), ("c", "m", "o", 0, "vip")],
                  portfolio_size=[("o", 4, 4)], buyers=[(1, "ana")])
    vip = Population("vip", "cartera", Ladder.of(("0.1", 5)))
    return src, DEFAULT.with_(populations=(*DEFAULT.populations, vip)), vip


def test_every_configured_population_is_reported(spark, tmp_path):
    src, params, vip = _with_vip(spark)
    assert {r["population"] for r in P.bonus_detail_all(src, params).collect()} == {"old", "new", "vip"}
    paths = run_reports(spark, src, str(tmp_path / "three"), params)
    assert [read_report(spark, paths.detail(p)).count() for p in ("old", "new", "vip")] == [1, 1, 1]
    only = run_reports(spark, src, str(tmp_path / "one"), params.with_(populations=(vip,)))
    assert read_report(spark, only.totals("vip")).count() == 1


def test_a_failed_run_leaves_the_last_whole_one_current(spark, tmp_path, monkeypatch):
    import os

    from incentiva.plans import reports_job

    src, params, _ = _with_vip(spark)
    out = str(tmp_path / "out")
    first = run_reports(spark, src, out, params)
    assert current_run(spark, out) == first and "_stage" not in os.listdir(first.root)
    monkeypatch.setattr(reports_job, "totals_report", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        run_reports(spark, src, out, params)
    monkeypatch.undo()
    assert current_run(spark, out) == first
    second = run_reports(spark, src, out, params)
    assert current_run(spark, out) == second != first


def _published_runs(path):
    import os

    return sorted(f for f in os.listdir(f"{path}/published") if not f.startswith("."))


@pytest.mark.parametrize("step", ["stage_detail", "write_report", "_delete", "_publish", "_retire"])
def test_a_driver_lost_at_any_step_leaves_a_whole_run(spark, tmp_path, monkeypatch, step):
    """The step does its work up to some point and then the driver is gone; nothing after it runs."""
    from incentiva.plans import reports_job

    class Lost(BaseException):
        pass

    src, params, _ = _with_vip(spark)
    out = str(tmp_path / "out")
    with pytest.raises(FileNotFoundError):
        current_run(spark, out)
    first = run_reports(spark, src, out, params, concurrent=False)
    for done in (False, True):
        real = getattr(reports_job, step)

        def lost(*a, real=real, done=done, **k):
            if done:
                real(*a, **k)
            raise Lost

        monkeypatch.setattr(reports_job, step, lost)
        with pytest.raises(Lost):
            run_reports(spark, src, out, params, concurrent=False, keep_runs=5)
        monkeypatch.undo()
        now = current_run(spark, out)
        assert {read_report(spark, now.detail(p)).count() for p in ("old", "new", "vip")} == {1}
        assert read_report(spark, now.commission).count() == read_report(spark, first.commission).count()
        assert (now == first) == (step in ("stage_detail", "write_report", "_delete") or step == "_publish" and not done)
        first = now


def test_old_runs_are_retired(spark, tmp_path):
    import os

    src, params, _ = _with_vip(spark)
    out = str(tmp_path / "out")
    runs = [run_reports(spark, src, out, params, populations=["old"]) for _ in range(3)]
    last = run_reports(spark, src, out, params, populations=["old"], keep_runs=2)
    assert current_run(spark, out) == last
    assert len(_published_runs(out)) == 2 and sorted(os.listdir(f"{out}/runs")) == sorted(p.root.rsplit("/", 1)[1] for p in (runs[2], last))
    with pytest.raises(ValueError):
        run_reports(spark, src, out, params, keep_runs=0)


def test_whole_numbers_stored_as_decimals_load(spark):
    plain = _one_store(spark, [sale("2022-12-05 10:00:00", "s", 120, buyer=7), sale("2022-12-05 10:00:00", "s", 30, buyer=8)], buyers=[(7, "ana"), (8, "bo")])
    frames = {n: getattr(plain, n) for n in ("sales", "portfolio", "portfolio_size", "buyers", "tier", "stores")}
    wide = {"sales": ("dynamo_customer_id", "order_number"), "portfolio": ("flag_retencion",), "portfolio_size": ("cartera", "cartera_nuevos"),
            "buyers": ("dynamo_customer_id",)}
    for digits in (38, 5):
        stored = dict(frames)
        for n, cols in wide.items():
            stored[n] = frames[n].withColumns({c: F.col(c).cast(f"decimal({digits},0)") for c in cols})
        src = from_frames(**stored)
        for n, cols in wide.items():
            assert [getattr(src, n).schema[c].dataType for c in cols] == [frames[n].schema[c].dataType for c in cols]
        assert _rows(P.bonus_detail(src, "old")) == _rows(P.bonus_detail(plain, "old"))
        assert _rows(P.portfolio_totals(src, "old")) == _rows(P.portfolio_totals(plain, "old"))
    # text on one side: both become text
    stored["buyers"] = frames["buyers"].withColumn("dynamo_customer_id", F.col("dynamo_customer_id").cast("string"))
    assert {r[5] for r in _rows(P.bonus_detail(from_frames(**stored), "old"))} == {"ana", "bo"}


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("value, kind", [("9223372036854775807", None), ("-9223372036854775808", None), ("9223372036854775808", "id"), (str(1 << 31), "flag")])
def test_a_whole_number_out_of_range_fails_the_job(spark, ansi, value, kind):
    src = _one_store(spark, [sale("2022-12-05 10:00:00", "s", 120)])
    frames = {n: getattr(src, n) for n in ("sales", "portfolio", "portfolio_size", "buyers", "tier", "stores")}
    big = F.lit(Decimal(value)).cast("decimal(38,0)")
    name, column = ("portfolio", "flag_retencion") if kind == "flag" else ("sales", "dynamo_customer_id")
    frames[name] = frames[name].withColumn(column, big)
    prev = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        loaded = getattr(from_frames(**frames), name).select(column)
        if kind is None:
            assert loaded.first()[0] == int(value)
        else:
            with pytest.raises(Exception, match="out of the range"):
                loaded.collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", prev)


@pytest.mark.parametrize("kind", ["decimal(38,1)", "decimal(10,2)"])
def test_fractions_are_no_whole_numbers(spark, kind):
    src = sources(spark)
    frames = {n: getattr(src, n) for n in ("sales", "portfolio", "portfolio_size", "buyers", "tier", "stores")}
    frames["buyers"] = frames["buyers"].withColumn("dynamo_customer_id", F.lit(None).cast(kind))
    with pytest.raises(SchemaError):
        from_frames(**frames)


def test_floating_amounts_by_request_through_every_loader(spark, tmp_path):
    from incentiva.plans import cli
    from incentiva.sources.tables import from_parquet, from_tables

    src = _one_store(spark, [sale("2022-12-05 10:00:00", "s", 120.5)], buyers=[(1, "ana")])
    names = ("sales", "portfolio", "portfolio_size", "buyers", "tier", "stores")
    frames = {n: getattr(src, n) for n in names}
    frames["sales"] = frames["sales"].withColumn("net_value", F.col("net_value").cast("double"))
    paths = {n: str(tmp_path / n) for n in names}
    for n in names:
        frames[n].write.parquet(paths[n])
        spark.read.parquet(paths[n]).createOrReplaceTempView(f"float_{n}")
    views = {n: f"float_{n}" for n in names}
    loaders = [lambda **k: from_frames(**frames, **k), lambda **k: from_parquet(spark, paths, **k),
               lambda **k: from_files(spark, paths, "parquet", **k), lambda **k: from_tables(spark, views, **k)]
    for load in loaders:
        with pytest.raises(SchemaError):
            load()
        (row,) = P.bonus_detail(load(allow_float=True), "old").collect()
        assert row["total_cliente"] == Decimal("120.500000")
    args = ["--parquet-root", str(tmp_path), "--out", str(tmp_path / "out"), "--keep-session-conf"]
    with pytest.raises(SchemaError):
        cli.main(args)
    assert read_report(spark, cli.main([*args, "--allow-float"]) + "/detail_old").count() == 1


def test_money_beyond_the_supported_scale_is_refused(spark):
    src = sources(spark)
    frames = {n: getattr(src, n) for n in ("sales", "portfolio", "portfolio_size", "buyers", "tier", "stores")}
    frames["sales"] = frames["sales"].withColumn("net_value", F.lit(None).cast("decimal(38,19)"))
    with pytest.raises(SchemaError):
        from_frames(**frames)


def test_money_keeps_its_scale_through_the_sum(spark):
    src = _one_store(spark, [sale("2022-12-05 10:00:00", "s", 0, order=i) for i in range(3)])
    fine = from_frames(**{n: getattr(src, n) for n in ("portfolio", "portfolio_size", "buyers", "tier", "stores")},
                       sales=src.sales.withColumn("net_value", F.lit(Decimal("33.3349")).cast("decimal(18,4)")))
    (row,) = P.bonus_detail(fine, "old").collect()
    assert row["total_cliente"] == Decimal("100.0047") and row["flag_bono"] == 1
    low = from_frames(**{n: getattr(src, n) for n in ("portfolio", "portfolio_size", "buyers", "tier", "stores")},
                      sales=src.sales.withColumn("net_value", F.lit(Decimal("33.332")).cast("decimal(18,3)")))
    (row,) = P.bonus_detail(low, "old").collect()
    assert row["total_cliente"] == Decimal("99.996") and row["flag_bono"] == 0


@pytest.mark.parametrize("column, kind", [("net_value", "double"), ("net_value", "string"), ("order_status", "int"), ("create_date_time", "string")])
def test_lossy_types_are_refused(spark, column, kind):
    src = sources(spark)
    frames = {n: getattr(src, n) for n in ("sales", "portfolio", "portfolio_size", "buyers", "tier", "stores")}
    frames["sales"] = frames["sales"].withColumn(column, F.lit(None).cast(kind))
    with pytest.raises(SchemaError):
        from_frames(**frames)
    if kind == "double":
        assert Sources(**frames).conformed(allow_float=True).sales.schema["net_value"].dataType == T.DecimalType(24, 6)
    frames = {n: getattr(src, n) for n in frames}
    frames["portfolio_size"] = frames["portfolio_size"].withColumn("cartera", F.lit(1).cast("bigint"))
    with pytest.raises(SchemaError):
        from_frames(**frames)


def test_rates_are_whole_numbers():
    with pytest.raises(ValueError):
        Ladder.of(("0.03", 40.9))
    assert Params.from_json({"month": "2023-02-01", "populations": [{"name": "x", "size_col": "c", "ladder": [["0.1", 7]]}]}).population("x").ladder.top.rate == 7
    with pytest.raises(TypeError):
        Params.from_json({"no_such": 1})


def _csv(spark, tmp_path, stores_text):
    src = _one_store(spark, [sale("2022-12-05 10:00:00", "s", 120)], stores=[("s", ts("2022-08-01 00:00:00"))])
    paths = {}
    for n in ("sales", "portfolio", "portfolio_size", "buyers", "tier", "stores"):
        paths[n] = str(tmp_path / n)
        getattr(src, n).write.option("header", True).csv(paths[n])
    (tmp_path / "own").mkdir()
    (tmp_path / "own" / "stores.csv").write_text(stores_text)
    return paths | {"stores": str(tmp_path / "own")}


@pytest.mark.parametrize("text", ["create_date_tz,store_url\n2022-08-01T00:00:00,s\n", "store_url,create_date_tz\ns,05/12/2022 10:00\n"])
def test_csv_by_header_and_no_silent_nulls(spark, tmp_path, text):
    with pytest.raises(Exception, match="(?i)header|malformed|FAILED_READ|CSV"):
        from_files(spark, _csv(spark, tmp_path, text), "csv").stores.collect()


def test_only_joined_inputs_are_measured_and_once(spark, monkeypatch):
    src = _one_store(spark, [sale("2022-12-05 10:00:00", "s", 120)], buyers=[(1, "ana"), (2, "bo")])
    seen = []
    many, one = joins.measure_many, joins.measure
    monkeypatch.setattr(joins, "measure_many", lambda frames: seen.append(sorted(frames)) or many(frames))
    monkeypatch.setattr(joins, "measure", lambda df: seen.append("again") or one(df))
    tight = DEFAULT.with_(broadcast_max_rows=1)
    P.bonus_detail(src, "old", tight)
    assert seen == [["buyers", "portfolio"]]
    P.bonus_detail(src, "old", tight)
    assert len(seen) == 1


def test_portfolio_sales_drop_other_stores_before_the_shuffle(spark):
    src = _one_store(spark, [sale("2022-12-05 10:00:00", "s", 120), sale("2022-12-05 10:00:00", "t", 120)])
    plan = explain_string(P.portfolio_sales(src, "old"), "simple")
    assert plan.index("HashAggregate") < plan.index("LeftSemi")
    assert P.portfolio_sales(src, "old").count() == 1


def test_sales_without_a_store_are_spread(spark):
    """Most sales lack a store: no task may hold them all, with small and with large dimensions."""
    n, ids = 40_000, F.col("id")
    src = sources(spark, tier=[("s1", d("2022-12-01"), "T")], stores=[("s1", ts("2022-08-01 00:00:00"))])
    lines = spark.range(n).select(
        F.make_timestamp_ntz(F.lit(2022), F.lit(12), (ids % 28 + 1).cast("int"), F.lit(9), F.lit(0), F.lit(0)).alias("create_date_time_tz"),
        F.lit(None).cast("timestamp_ntz").alias("cancel_date_time_tz"), F.lit("PAID").alias("order_status"),
        F.when(ids % 10 == 0, F.concat(F.lit("s"), (ids % 300).cast("string"))).alias("store_url"),
        F.concat(F.lit("L"), ids.cast("string")).alias("leader_name"), ids.alias("dynamo_customer_id"), ids.alias("order_number"),
        F.lit(1).cast("decimal(18,2)").alias("net_value")).withColumn("create_date_time", F.col("create_date_time_tz"))
    src = from_frames(sales=lines, **{x: getattr(src, x) for x in ("portfolio", "portfolio_size", "buyers", "tier", "stores")})
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        results = []
        for rows in (2_000_000, 0):
            t = C.commission_tracker(src, DEFAULT.with_(tier_required=False, broadcast_max_rows=rows), sort=False)
            sizes = [r["count"] for r in t.groupBy(F.spark_partition_id()).count().collect()]
            assert max(sizes) < 0.2 * sum(sizes)
            results.append(_rows(t))
            plan = explain_string(t, "simple")
            # the half-month totals are joined back by a salt of the daily row, not a window over the store
            assert "Window" not in plan and re.search(r"hashpartitioning\(cast\(pmod\(xxhash64\(leader_name", plan)
        assert results[0] == results[1]
        halves = {(r[3], r[8]) for r in results[0] if r[4] is None}
        want = {(q, sum(r[7] for r in results[0] if r[4] is None and r[3] == q)) for q in (1, 2)}
        assert halves == want
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_commission_report_keeps_its_order(spark, tmp_path):
    import glob

    import pyarrow.parquet as pq
    from conftest import SF_SMOKE
    from incentiva.sources import testdata

    src = testdata.load(spark, SF_SMOKE)
    paths = run_reports(spark, src, str(tmp_path / "out"), DEFAULT, missing_date_text="9999")
    files = sorted(glob.glob(f"{paths.commission}/part-*"))
    dates = [x for f in files for x in pq.read_table(f, columns=["CREATION_DATE"]).column(0).to_pylist()]
    assert len(dates) > 500 and dates == sorted(dates, reverse=True)
