"""The whole job: five report tables from one run.

The original runs five independent queries, so the sales table is scanned five
times and the detail of each population is computed twice. Here:

* the bonus detail of *both* populations is computed in one pass over the
  month's sales and written once, partitioned by population, to a staging
  table in the output folder (shared storage). Reading it back cuts the
  lineage: a lost executor costs a re-read of the staged files, not a re-run of
  the sales aggregation;
* each detail report is a partition-pruned read of the staged table, and the
  totals of a population come from its part of it;
* the commission tracker is its own scan (it needs every month after the cut,
  not one month).

A run writes all its tables to a new folder, ``runs/<id>``, removes the staged
detail, and last publishes the run: it creates one empty file whose name holds the
next number and the run's id. Creating a file that is not there is atomic on file
systems and object stores alike, nothing is overwritten, and the name says all, so
``current_run``, the highest number, is always one whole run, wherever the driver is lost. Old
runs stay until ``keep_runs`` is given; then the older ones are deleted.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.commission import commission_tracker
from ..operators.portfolio import DETAIL_COLUMNS, POP, bonus_detail_all, portfolio_totals_all, store_graduation
from ..params import DEFAULT, Params
from ..sources.reports import shape_report, write_report
from ..sources.tables import Sources


log = logging.getLogger(__name__)
SKEW_CONF = ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled", "spark.sql.adaptive.forceOptimizeSkewedJoin")


@dataclass(frozen=True)
class ReportPaths:
    root: str

    def detail(self, pop: str) -> str:
        return f"{self.root}/detail_{pop}"

    def totals(self, pop: str) -> str:
        return f"{self.root}/totals_{pop}"

    @property
    def commission(self) -> str:
        return f"{self.root}/commission"

    @property
    def stage_detail(self) -> str:
        return f"{self.root}/_stage/bonus_detail"


def stage_detail(spark: SparkSession, src: Sources, paths: ReportPaths, params: Params = DEFAULT,
                 populations: Sequence[str] | None = None) -> DataFrame:
    """Compute the detail of all populations once, write it, and return the written table."""
    detail = bonus_detail_all(src, params, populations)
    detail.write.mode("overwrite").partitionBy(POP).parquet(paths.stage_detail)
    # the written schema, so the partition column is not re-typed by inference
    return spark.read.schema(detail.schema).parquet(paths.stage_detail)


def totals_report(detail_all: DataFrame, src: Sources, pop: str, params: Params = DEFAULT) -> DataFrame:
    size_col = params.population(pop).size_col
    grad = store_graduation(detail_all.filter(F.col(POP) == pop), params)
    t = portfolio_totals_all(grad, src.portfolio_size, params, [pop], src.size_bound("portfolio_size")).drop(POP)
    return t.withColumnRenamed("cartera", size_col)


def run_reports(spark: SparkSession, src: Sources, out_root: str, params: Params = DEFAULT,
                populations: Sequence[str] | None = None, fmt: str = "parquet",
                missing_date_text: str | None = None, concurrent: bool = True, keep_runs: int | None = None) -> ReportPaths:
    """Write all report tables to a new run folder under ``out_root``, make it current, and return their paths.

    ``populations``: names; all that are configured by default. The session should have the settings of
    ``session.CLUSTER_CONF`` (``apply_cluster_conf``); a warning names missing skew settings.
    ``missing_date_text`` is the commission report's text for a missing date (null by
    default). With ``concurrent`` the independent report writes are submitted from
    driver threads at once, so small jobs do not wait on each other; the commission
    tracker runs alongside the portfolio staging. ``keep_runs``: published runs that stay, this one included
    (None: all).
    """
    if keep_runs is not None and keep_runs < 1:
        raise ValueError("keep_runs must be at least 1: the run just published stays")
    out_root = out_root.rstrip("/")
    paths = ReportPaths(f"{out_root}/runs/{uuid.uuid4().hex}")
    populations = [p.name for p in params.populations] if populations is None else populations
    for k in SKEW_CONF:
        if spark.conf.get(k, "false") != "true":
            log.warning("%s is not set: a hot buyer stays in one task of a shuffle join (see session.apply_cluster_conf)", k)
    tracker = commission_tracker(src, params, sort=True)
    writes: list[Callable[[], None]] = [
        lambda: write_report(shape_report(tracker, date_text=True, missing_date_text=missing_date_text),
                             paths.commission, fmt)
    ]

    def portfolio_reports() -> None:
        detail_all = stage_detail(spark, src, paths, params, populations)
        jobs = []
        for pop in populations:
            d = detail_all.filter(F.col(POP) == pop).select(*DETAIL_COLUMNS)
            jobs.append(lambda d=d, pop=pop: write_report(shape_report(d), paths.detail(pop), fmt))
            t = totals_report(detail_all, src, pop, params)
            jobs.append(lambda t=t, pop=pop: write_report(shape_report(t), paths.totals(pop), fmt))
        _run_all(jobs, concurrent)

    writes.append(portfolio_reports)
    try:
        _run_all(writes, concurrent)
    finally:
        _delete(spark, f"{paths.root}/_stage")
    _publish(spark, out_root, paths)
    if keep_runs is not None:
        _retire(spark, out_root, keep_runs)
    return paths


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _published(spark: SparkSession, out_root: str) -> list[tuple[int, str]]:
    """(number, run id) of the published runs, oldest first."""
    fs, p = _fs(spark, f"{out_root}/published")
    names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    return sorted((int(n), run) for n, _, run in (x.partition("-") for x in names) if n.isdigit() and run)


def _publish(spark: SparkSession, out_root: str, paths: ReportPaths) -> None:
    last = max((n for n, _ in _published(spark, out_root)), default=0)
    fs, p = _fs(spark, f"{out_root}/published/{last + 1:010d}-{paths.root.rsplit('/', 1)[1]}")
    fs.create(p, False).close()


def _retire(spark: SparkSession, out_root: str, keep: int) -> None:
    """Delete the published runs beyond the ``keep`` newest: tables first, so that a name left over is tried again."""
    for n, run in _published(spark, out_root)[:-keep]:
        _delete(spark, f"{out_root}/runs/{run}")
        _delete(spark, f"{out_root}/published/{n:010d}-{run}")


def current_run(spark: SparkSession, out_root: str) -> ReportPaths:
    """The paths of the last whole run under ``out_root``; ``FileNotFoundError`` if there is none."""
    out_root = out_root.rstrip("/")
    runs = _published(spark, out_root)
    if not runs:
        raise FileNotFoundError(f"no published run under {out_root}")
    return ReportPaths(f"{out_root}/runs/{runs[-1][1]}")


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def _run_all(jobs: list[Callable[[], None]], concurrent: bool) -> None:
    if not concurrent or len(jobs) == 1:
        for job in jobs:
            job()
        return
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        for f in [pool.submit(job) for job in jobs]:
            f.result()  # re-raises the first failure
