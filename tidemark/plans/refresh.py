"""A whole run: marts day, week and year to date, then the reports."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.params import DAY, FYTD, WEEK, MartConfig, RunParams
from tidemark.plans import acquisition, budget, conversion, monetisation, reports, retention, supply
from tidemark.plans.late import LateDays
from tidemark.plans.ytd import carries, forget_state, remember
from tidemark.schema import BREAKOUT_KEY, BUDGET_KEY, BUDGET_MEASURES, MART_KEY, MART_UPDATE, OVERVIEW_KEY, PARTITION
from tidemark.sinks.upsert import read_table, upsert
from tidemark.sources.catalog import Sources


@dataclass(frozen=True)
class Mart:
    """Builders of one mart: DAY reads sources, WEEK reads stored DAY rows, FYtD stored WEEK rows."""

    day: Callable[[Sources, RunParams, MartConfig], DataFrame]
    week: Callable[[DataFrame, Sources, RunParams, MartConfig], DataFrame]
    fytd: Callable[[DataFrame, Sources, RunParams, MartConfig], DataFrame] | None
    key: tuple[str, ...] = tuple(MART_KEY)
    update: tuple[str, ...] = tuple(MART_UPDATE)


MARTS = {
    "acquisition_mart": Mart(acquisition.acquisition_day, acquisition.acquisition_week, acquisition.acquisition_fytd),
    "conversion_mart": Mart(conversion.conversion_day, conversion.conversion_week, conversion.conversion_fytd),
    "monetisation_mart": Mart(
        monetisation.monetisation_day, monetisation.monetisation_week, monetisation.monetisation_fytd
    ),
    "retention_mart": Mart(retention.retention_day, retention.retention_week, retention.retention_fytd),
    "supply_mart": Mart(supply.supply_day, supply.supply_week, supply.supply_fytd),
    "budget_mart": Mart(
        budget.budget_day, budget.budget_week, None, tuple(BUDGET_KEY), (*BUDGET_MEASURES, "last_modified")
    ),
}
METRIC_MARTS = tuple(name for name in MARTS if name != "budget_mart")


def _refresh_mart(
    spark: SparkSession, name: str, src: Sources, p: RunParams, cfg: MartConfig, folder: str, scopes: Iterable[str], staging: str | None
) -> tuple[DataFrame, set]:
    """The stored mart and the weeks that were rewritten."""
    mart, path, weeks = MARTS[name], f"{folder}/{name}", set()
    builders = {DAY: mart.day, WEEK: mart.week, FYTD: mart.fytd}
    for scope in (DAY, WEEK, FYTD):
        build = builders[scope]
        if scope not in scopes or build is None:
            continue
        state = f"{folder}/_ytd/{name}"
        carried = scope == FYTD and carries(p)
        own = replace(cfg, ytd_state=(path, state)) if carried else cfg
        if scope == FYTD and not carried:
            forget_state(spark, state)
        rows = build(src, p, own) if scope == DAY else build(read_table(spark, path), src, p, own)
        weeks.update(upsert(path, rows, list(mart.key), list(mart.update), staging=staging))
        if carried:
            remember(spark, path, state, src.calendar, p)
    return read_table(spark, path), weeks


def refresh_mart(
    spark: SparkSession, name: str, src: Sources, p: RunParams, cfg: MartConfig, folder: str,
    scopes: Iterable[str] = (DAY, WEEK, FYTD), staging: str | None = None,
) -> DataFrame:
    """Bring the stored mart up to date, scope by scope; each scope reads what the one before wrote."""
    return _refresh_mart(spark, name, src, p, cfg, folder, scopes, staging)[0]


def refresh_reports(
    spark: SparkSession, tables: Mapping[str, DataFrame], touched: Iterable, p: RunParams, folder: str, staging: str | None = None
) -> dict[str, DataFrame]:
    """Both reports and the dashboard over the stored marts.

    A report that is stored already rebuilds the ``touched`` weeks and those whose comparisons
    they are in; the dashboard follows the overview week by week.
    """
    out = {}
    for name, build, key in (
        ("breakout_report", reports.breakout_report, BREAKOUT_KEY), ("overview_status", reports.overview_status, OVERVIEW_KEY),
    ):
        path = f"{folder}/{name}"
        stored = read_table(spark, path)
        part = None if stored is None else reports.rebuild(stored, [w for w in touched if w is not None])
        weeks = upsert(path, build(tables, p, part=part), key, None, staging=staging)
        out[name] = read_table(spark, path)
    wide = reports.dashboard_pivot(out["overview_status"].where(F.col(PARTITION).isin(weeks)), ordered=False)
    upsert(f"{folder}/dashboard", wide, list(reports.DASHBOARD_KEY), None, staging=staging)
    out["dashboard"] = read_table(spark, f"{folder}/dashboard")
    return out


def refresh(
    spark: SparkSession, src: Sources, p: RunParams, folder: str, cfg: MartConfig = MartConfig(),
    marts: Iterable[str] = tuple(MARTS), scopes: Iterable[str] = (DAY, WEEK, FYTD), with_reports: bool = True,
    staging: str | None = None, changed_days_only: bool = False,
) -> dict[str, DataFrame]:
    """Run the chosen marts over a date range of any length, then both reports and the dashboard.

    A backfill is the same call with a longer range: the range is one job, not one per day.
    ``staging`` is the folder of the upserts' intermediate tables, by default the shared one.
    ``changed_days_only`` builds of the look-back the days whose lines are not those of the run before; the
    result is that of the whole look-back. All runs over a folder should then choose it, and all marts.
    """
    stored, touched = {}, set()
    late = LateDays(spark, src, p, cfg, folder) if changed_days_only else None
    if late is not None:
        cfg = replace(cfg, late_days=late.days)
    try:
        for name in marts:
            stored[name], weeks = _refresh_mart(spark, name, src, p, cfg, folder, scopes, staging)
            touched |= weeks if name in METRIC_MARTS else set()
        if late is not None:
            late.remember()
    finally:
        src.drop_kept(spark)
    if with_reports:
        tables = {n: stored[n] if n in stored else read_table(spark, f"{folder}/{n}") for n in METRIC_MARTS}
        stored |= refresh_reports(spark, tables, touched, p, folder, staging)
    return stored
