"""Every query the engine answers, by name: ``(spark, directory) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.checks import campaigns, quality
from tidemark.checks import monetisation as mon_checks
from tidemark.checks import retention as ret_checks
from tidemark.checks.moved import unique_keys_where_moved
from tidemark.checks.reconcile import tally
from tidemark.functions.money import from_units, sum_units
from tidemark.functions.taxonomy import journey_class, journey_type, payback_category, payback_sub_category
from tidemark.operators.calendar import attach_calendar, in_run, outside
from tidemark.operators.compare import number_weeks
from tidemark.operators.customers import customer_flags
from tidemark.operators.pivot import kpi_pivot
from tidemark.operators.region import region_fanout
from tidemark.operators.rollup import count_levels, over_all_tasks
from tidemark.operators.scopes import SERIES, lag_previous_present, roll_to_week, running_ytd
from tidemark.operators.spread import weekday_weights
from tidemark.params import DAY, FYTD, PRODUCT_LINES, WEEK
from tidemark.plans import acquisition as acq
from tidemark.plans import monetisation as mon
from tidemark.plans import conversion, reports, retention, supply
from tidemark.plans import single_metrics as single
from tidemark.plans.common import DAY_KEYS, LINE_PL, LINE_REGION, qualifying_lines
from tidemark.plans.conversion import conversion_budget
from tidemark.plans.extracts import distinct_orders
from tidemark.plans.refresh import METRIC_MARTS, refresh, refresh_mart, refresh_reports
from tidemark.plans.store import MartStore
from tidemark.plans.ytd import remember
from tidemark.schema import BREAKOUT_KEY, BUDGET_KEY, BUDGET_MEASURES, MART_KEY, OVERVIEW_KEY
from tidemark.session import scratch_table
from tidemark.sinks.upsert import read_parts, read_table, upsert
from tidemark.sources.catalog import FACTS, LOOKUPS, Sources
from tidemark.sources.fixtures import CONFIG, KPIS, RUN, fixture_sources
from tidemark.sources.profile import PROFILES, profile

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


class Setup:
    """Sources, run and stored marts of one directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.p, self.cfg = spark, RUN, CONFIG
        self.src = fixture_sources(spark, sf_dir)
        self.store = MartStore(spark, sf_dir, self.src, self.p, self.cfg)

    @property
    def marts(self) -> dict[str, DataFrame]:
        return self.store.marts

    @property
    def reports(self) -> dict[str, DataFrame]:
        return {name: self.store.report(name) for name in ("breakout_report", "overview_status")}

    def mart_days(self, mart: str) -> DataFrame:
        return self.store.stored(mart, [DAY])


def query(name: str):
    """Register a function of a ``Setup``; the write stamp never belongs to a result."""

    def register(build: Callable[[Setup], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: build(Setup(spark, sf_dir)).drop("last_modified")
        return build

    return register


# --- marts -----------------------------------------------------------------------------------

for _mart in METRIC_MARTS:
    for _scope in (DAY, WEEK, FYTD):
        query(f"{_mart}_{_scope.lower()}")(lambda s, m=_mart, sc=_scope: s.store.build(m, sc))


def _plain(budget: DataFrame) -> DataFrame:
    return budget.select(*BUDGET_KEY, *[F.col(c).cast("double").alias(c) for c in BUDGET_MEASURES])


query("budget_mart_day")(lambda s: _plain(s.store.build("budget_mart", DAY)))
query("budget_mart_week")(lambda s: _plain(s.store.build("budget_mart", WEEK)))

# --- metric families -------------------------------------------------------------------------

FAMILIES = {
    "acquisition_metrics": acq.acquisition_metrics,
    "payback_months": acq.payback_metric,
    "customer_metrics_day": acq.customer_metrics_day,
    "revenue_metrics": mon.revenue_metrics,
    "non_fee_revenue_per_visit": mon.non_fee_revenue_per_visit,
    "total_visits": mon.total_visits,
    "ads_metrics": mon.ads_metrics,
    "hotel_bookings": mon.hotel_bookings,
    "hotel_revenue": mon.hotel_revenue,
    "hotel_web_metrics": mon.hotel_web_metrics,
    "transaction_metrics": mon.transaction_metrics,
    "monetisation_metrics": mon.monetisation_metrics,
    "sales_metrics": supply.sales_metrics,
    "journey_search_metrics": supply.journey_metrics,
    "user_journey_metrics": retention.journey_metrics,
}
for _name, _family in FAMILIES.items():
    query(f"metrics_{_name}")(lambda s, f=_family: f(s.src, s.p, s.cfg))
query("metrics_growth_day")(lambda s: retention.growth_metrics(s.src, s.p, s.cfg, DAY))
query("metrics_growth_week")(lambda s: retention.growth_metrics(s.src, s.p, s.cfg, WEEK))

# --- reports ---------------------------------------------------------------------------------

query("report_breakout")(lambda s: reports.breakout_report(s.marts, s.p))
query("report_overview")(lambda s: reports.overview_status(s.marts, s.p))
query("report_dashboard")(lambda s: reports.dashboard_pivot(s.store.report("overview_status")))

# --- checks ----------------------------------------------------------------------------------

def _check(name: str):
    return query(f"check_{name}")


for _name, _spec in campaigns.CHECKS.items():
    _check(_name)(lambda s, c=_spec: campaigns.campaign_check(c, s.store.whole("acquisition_mart"), s.src, s.p, s.cfg))
for _name in mon_checks.FEE_CHECKS:
    _check(_name)(lambda s, n=_name: mon_checks.fee_check(n, s.mart_days("monetisation_mart"), s.src, s.p, s.cfg))
for _metric in mon_checks.ADS_METRICS:
    _check(f"ads_{_metric.lower()}")(lambda s, m=_metric: mon_checks.ads_check(m, s.mart_days("monetisation_mart"), s.src, s.p))
_check("hotel_bookings")(lambda s: mon_checks.hotel_bookings_check(s.mart_days("monetisation_mart"), s.src, s.p, s.cfg))
for _metric in ("CTR", "Impressions"):
    _check(f"hotel_{_metric.lower()}")(
        lambda s, m=_metric: mon_checks.hotel_web_check(m, s.mart_days("monetisation_mart"), s.src, s.p, s.cfg)
    )
for _stage in retention.STAGES:
    _check(f"lifecycle_{_stage.lower().replace(' ', '_')}")(
        lambda s, g=_stage: ret_checks.lifecycle_check(g, s.mart_days("retention_mart"), s.src, s.p)
    )
    _check(f"lifecycle_{_stage.lower().replace(' ', '_')}_week")(
        lambda s, g=_stage: ret_checks.lifecycle_check(g, s.store.stored("retention_mart", [WEEK]), s.src, s.p, WEEK)
    )
for _journey in ret_checks.JOURNEYS:
    _check(f"journey_{_journey}_coarse")(
        lambda s, j=_journey: ret_checks.journey_check(j, s.mart_days("retention_mart"), s.src, s.p, s.cfg, coarse=True)
    )
    _check(f"journey_{_journey}")(
        lambda s, j=_journey: ret_checks.journey_check(j, s.mart_days("retention_mart"), s.src, s.p, s.cfg)
    )
for _mart in METRIC_MARTS:
    _check(f"foreign_travel_{_mart.removesuffix('_mart')}")(
        lambda s, m=_mart: quality.foreign_travel_check(m, s.store.whole(m))
    )
for _column in ("category", "sub_category"):
    _check(f"{_column}_completeness")(
        lambda s, c=_column: quality.completeness_check(s.mart_days("supply_mart"), c, s.p)
    )
_check("unique_keys")(lambda s: quality.unique_key_tally({
    **{name: (mart, MART_KEY) for name, mart in s.marts.items()},
    "budget_mart": (s.store.stored("budget_mart", [DAY, WEEK]), BUDGET_KEY),
    "breakout_report": (s.store.report("breakout_report"), BREAKOUT_KEY),
    "overview_status": (s.store.report("overview_status"), OVERVIEW_KEY),
}))
_check("not_null")(lambda s: quality.not_null_check(s.marts))
_check("not_null_this_run")(lambda s: quality.not_null_check(s.marts, written_at=s.p.run_ts))
_check("not_null_reports")(lambda s: quality.not_null_check(s.reports))
_check("accepted_regions_reports")(lambda s: quality.accepted_values_check(s.reports))
_check("accepted_product_lines_reports")(lambda s: quality.accepted_values_check(s.reports, "product_pl", PRODUCT_LINES))
_check("accepted_regions")(lambda s: quality.accepted_values_check(s.marts))
_check("accepted_product_lines")(lambda s: quality.accepted_values_check(s.marts, "product_pl", PRODUCT_LINES))
_check("region_count")(lambda s: quality.distinct_count_check(s.marts))
_check("breakout_values")(lambda s: tally(
    quality.report_check(s.store.report("breakout_report"), s.store.whole("acquisition_mart"), s.p, True),
    ["date_scope", "metric"],
))
_check("overview_values")(lambda s: tally(
    quality.report_check(s.store.report("overview_status"), s.store.whole("acquisition_mart"), s.p, False),
    ["date_scope", "metric"],
))

# --- sources ---------------------------------------------------------------------------------

for _table, _profile in PROFILES.items():
    query(f"source_{_table}")(lambda s, t=_table, f=_profile: profile(getattr(s.src, t), f))

# --- metrics one at a time -------------------------------------------------------------------

for _name in single.LINE_METRICS:
    query("single_" + _name.lower().replace(" / ", "_per_").replace(" ", "_").replace("-", "_"))(
        lambda s, n=_name: single.line_metric(n, s.src, s.p, s.cfg)
    )
for _name in single.AD_METRICS:
    query(f"single_ads_{_name}")(lambda s, n=_name: single.ad_metric(n, s.src, s.p, s.cfg))
query("single_lifecycle_by_currency")(lambda s: single.lifecycle_by_currency(s.src, s.p, DAY))

# --- steps -----------------------------------------------------------------------------------

CAMPAIGN_ATTRIBUTES = ["kpi", "channel", "sub_channel", "channel_source", "device"]


@query("label_campaigns")
def _(s: Setup) -> DataFrame:
    labels = [v.alias(k) for k, v in acq.campaign_labels().items()]
    return s.src.marketing.groupBy(*CAMPAIGN_ATTRIBUTES, *labels).agg(F.count("*").alias("records"))


@query("label_payback_channels")
def _(s: Setup) -> DataFrame:
    channel = F.col("channel_0")
    return s.src.payback.groupBy(
        channel, payback_category(channel).alias("category"), payback_sub_category(channel, F.col("channel_1")).alias("sub_category")
    ).agg(F.count("*").alias("records"))


@query("label_journeys")
def _(s: Setup) -> DataFrame:
    train = F.col("fare_train_classification_name_longest_duration")
    kind = journey_type(F.col(LINE_PL), F.col(LINE_REGION), train, F.col("product_train_speed_code"))
    return s.src.order_lines.groupBy(
        "year_month_day", kind.alias("journey_type"),
        journey_class(train, F.col("product_travel_classification_name")).alias("journey_class"),
    ).agg(F.count("*").alias("records"))


@query("label_new_customers")
def _(s: Setup) -> DataFrame:
    lines = qualifying_lines(s.src, s.cfg).where(F.col("product_gross_sales_flag") == "Y")
    bought = lines.select(
        F.col("order_customer_id").alias("customer_id"), "year_month_day", "product_issued_date",
        F.col(LINE_PL).alias("product_pl"), F.col(LINE_REGION).alias("region"),
    )
    flags = customer_flags(bought, s.src.customer_accounts, "year_month_day")
    return flags.groupBy("year_month_day", "product_pl", "region").agg(
        F.count("*").alias("purchases"), F.sum("is_new").alias("new_purchases")
    )


@query("filter_qualifying_lines")
def _(s: Setup) -> DataFrame:
    kept = qualifying_lines(s.src, s.cfg).where(in_run(F.col("year_month_day"), s.p, s.cfg.line_lookback_days))
    return kept.groupBy("year_month_day", "product_type_code", "source_system", "order_managed_group_id").agg(F.count("*").alias("records"))


@query("filter_outage_days")
def _(s: Setup) -> DataFrame:
    kept = s.src.web_events.where(in_run(F.col("event_date"), s.p, 1) & outside(F.col("event_date"), s.cfg.web_outages))
    return kept.groupBy("event_date").agg(F.count("*").alias("records"))


@query("join_region_fanout")
def _(s: Setup) -> DataFrame:
    lines = s.src.order_lines.groupBy("year_month_day", LINE_PL, LINE_REGION).agg(F.count("*").alias("records"))
    mapped = region_fanout(lines, LINE_PL, LINE_REGION, s.src.region_map)
    return mapped.groupBy("year_month_day", "product_pl", "region").agg(F.sum("records").alias("records"))


@query("join_calendar")
def _(s: Setup) -> DataFrame:
    daily = s.src.order_lines.groupBy("year_month_day").agg(F.count("*").alias("records"))
    dated = attach_calendar(daily, s.src.calendar, DAY)
    return dated.groupBy("financial_year", "week_number", "week_commencing_date").agg(F.sum("records").alias("records"))


@query("join_origin_country")
def _(s: Setup) -> DataFrame:
    origin = F.split("search_odpair_country_name", " - ", 2)[0]
    searches = s.src.journey_searches.groupBy(origin.alias("origin")).agg(F.sum("m_search_result_journey_count").alias("journeys"))
    return searches.join(s.src.countries, F.col("origin") == F.col("country_code")).select("origin", "country_name", "product_pl", "region", "journeys")


query("join_booking_countries")(lambda s: mon.placed_bookings(s.src, s.p, s.cfg))
query("join_exchange_rates")(lambda s: mon.hotel_commissions(s.src, s.p, s.cfg))
query("join_budget_regions")(lambda s: conversion_budget(s.src, s.p))
query("join_margin_and_spend")(
    lambda s: acq.margin_totals(s.src, s.p, s.cfg).join(acq.spend_totals(s.src, s.p, s.cfg), DAY_KEYS).withColumn(
        "margin_after_spend", F.col("margin") - F.col("spend")
    )
)
query("join_visits")(
    lambda s: mon.line_extract(s.src, s.p, s.cfg).join(mon.visit_totals(s.src, s.p), DAY_KEYS).select(*DAY_KEYS, "non_fee_gbp", "non_fee_eur", "visits")
)
query("count_orders")(lambda s: mon.order_counts(s.src, s.p, s.cfg))
query("count_customers_day")(lambda s: acq.customer_totals(s.src, s.p, s.cfg, "year_month_day"))
query("count_customers_week")(lambda s: acq.customer_totals(s.src, s.p, s.cfg, "week_commencing_date"))
query("rollup_orders_week")(lambda s: distinct_orders(s.src, s.p, s.cfg, "financial_year", "week_commencing_date"))
query("rollup_orders_year")(lambda s: distinct_orders(s.src, s.p, s.cfg, "financial_year"))
query("count_web_events")(lambda s: mon.hotel_web_counts(s.src, s.p, s.cfg))
query("sum_line_extract")(lambda s: mon.line_extract(s.src, s.p, s.cfg))
query("sum_journey_classes")(lambda s: retention.journey_totals(s.src, s.p, s.cfg))


@query("latest_ad_rows")
def _(s: Setup) -> DataFrame:
    kept = mon.ad_rows(s.src, s.p)
    return kept.groupBy("event_date", "event_line_item_name").agg(
        F.count("*").alias("records"), F.sum("revenue_micros").alias("micros"), F.max("header_eventtime").cast("string").alias("latest")
    )


@query("pivot_campaign_kpis")
def _(s: Setup) -> DataFrame:
    daily = s.src.marketing.groupBy("activity_date", "kpi").agg(from_units(sum_units(F.col("value"))).alias("value"))
    return kpi_pivot(daily, ["activity_date"], "kpi", "value", {k.lower().replace(" ", "_"): k for k in KPIS})


@query("unpivot_weekly_budget")
def _(s: Setup) -> DataFrame:
    return supply.weekly_budget(s.src, s.p)


@query("level_sets")
def _(s: Setup) -> DataFrame:
    """Every level of three line attributes, with line counts and distinct orders."""
    labels = ["order_region_name", "record_type", "product_train_speed_code"]
    lines = over_all_tasks(qualifying_lines(s.src, s.cfg).select("year_month_day", *labels, "order_id"), "year_month_day", "order_id")
    return count_levels(lines, ["year_month_day"], labels, "order_id", "orders", {"records": F.count("*")})


query("window_running_year")(lambda s: running_ytd(s.store.stored("supply_mart", [DAY, WEEK]), s.src.calendar, s.p, supply.ADDITIVE))


@query("window_previous_present")
def _(s: Setup) -> DataFrame:
    growth = retention.growth_metrics(s.src, s.p, s.cfg, DAY)
    return lag_previous_present(growth, SERIES, "year_month_day", "metric_value", "previous").select(
        "year_month_day", *SERIES, "metric_value", "previous"
    )


query("window_week_numbers")(lambda s: number_weeks(reports.collate(s.marts, reports.BREAKOUT_METRICS)))
query("weights_by_weekday")(lambda s: weekday_weights(s.src.order_lines, s.src.plan_calendar, s.p.as_of))
query("sum_weeks")(lambda s: roll_to_week(s.store.stored("conversion_mart", [DAY]), s.p, conversion.ADDITIVE))


@query("report_overview_with_future")
def _(s: Setup) -> DataFrame:
    late = replace(s.p, as_of=date(2025, 12, 1))
    return reports.overview_status(s.marts, late, s.src.calendar, include_future=True)


# --- stored tables ---------------------------------------------------------------------------

@query("stored_supply_mart")
def _(s: Setup) -> DataFrame:
    """The supply mart as a run leaves it, over a table that held stale and missing values."""
    folder = scratch_table(s.spark, "stored")
    day = s.store.stored("supply_mart", [DAY])
    stale = day.where(F.col("year_month_day") < F.lit(date(1999, 1, 1))).withColumn("metric_value", F.col("metric_value") + 1)
    upsert(f"{folder}/supply_mart", stale)
    return refresh_mart(s.spark, "supply_mart", s.src, s.p, s.cfg, folder)


@query("stored_budget_mart")
def _(s: Setup) -> DataFrame:
    folder = scratch_table(s.spark, "stored")
    return _plain(refresh_mart(s.spark, "budget_mart", s.src, s.p, s.cfg, folder))


@query("stored_overview_report")
def _(s: Setup) -> DataFrame:
    """The overview written twice: the second write replaces every non-key column."""
    path = scratch_table(s.spark, "overview")
    report = s.store.report("overview_status")
    upsert(path, report.withColumns({"metric_value": F.lit(0.0), "yoy": F.lit(None).cast("double")}), OVERVIEW_KEY, None)
    upsert(path, report, OVERVIEW_KEY, None)
    return s.spark.read.parquet(path)


@query("stored_breakout_report")
def _(s: Setup) -> DataFrame:
    """The breakout built over marts of which some weeks were wrong, then refreshed for those weeks alone."""
    folder = scratch_table(s.spark, "breakout")
    weeks = [date(1999, 5, 9), date(1999, 5, 16), date(2024, 1, 14)]
    wrong = F.when(F.col("week_commencing_date").isin(weeks), F.col("metric_value") + 1).otherwise(F.col("metric_value"))
    refresh_reports(s.spark, {name: mart.withColumn("metric_value", wrong) for name, mart in s.marts.items()}, [], s.p, folder)
    return refresh_reports(s.spark, s.marts, weeks, s.p, folder)["breakout_report"]


query("stored_dashboard")(lambda s: refresh_reports(s.spark, s.marts, [], s.p, scratch_table(s.spark, "dashboard"))["dashboard"])


@query("stored_carried_years")
def _(s: Setup) -> DataFrame:
    """Running totals of supply carried by three runs: over weeks of which some are wrong or missing, then over those alone."""
    folder = scratch_table(s.spark, "carried")
    path, weekly = f"{folder}/supply_mart", s.store.stored("supply_mart", [WEEK])
    cfg = replace(s.cfg, ytd_state=(path, f"{folder}/_ytd/supply_mart"))
    wrong, missing = [date(1998, 5, 3)], [date(1997, 8, 10)]
    week = F.col("week_commencing_date")
    bad = F.when(week.isin(wrong), F.col("metric_value") + 1).otherwise(F.col("metric_value"))
    first = weekly.where(~week.isin(missing)).withColumn("metric_value", bad)
    for rows, run in ((first, s.p), *[(weekly.where(week.isin(w)), replace(s.p, start=w, end=w)) for w in (*wrong, *missing)]):
        upsert(path, rows)
        upsert(path, supply.supply_fytd(read_table(s.spark, path), s.src, run, cfg))
        remember(s.spark, *cfg.ytd_state, s.src.calendar, run)
    return read_table(s.spark, path).where(F.col("date_scope") == FYTD)


@query("stored_checks")
def _(s: Setup) -> DataFrame:
    """Keys of the stored supply mart checked four times: all weeks, none, one whose rows came twice, and that one mended."""
    folder = scratch_table(s.spark, "checked")
    path, note, week = f"{folder}/supply_mart", f"{folder}/_checked/unique_keys", date(1998, 5, 3)
    rows = s.store.stored("supply_mart", [DAY])
    out = []
    for run in range(1, 5):
        if run == 1:
            upsert(path, rows)
        elif run == 3:
            again = read_parts(s.spark, path, read_table(s.spark, path).schema, "week_commencing_date", [week])
            again.write.mode("append").partitionBy("week_commencing_date").parquet(path)
        elif run == 4:
            upsert(path, rows.where(F.col("week_commencing_date") == F.lit(week)))
        _, found = unique_keys_where_moved(s.spark, note, path, MART_KEY)
        kept = scratch_table(s.spark, f"check-run-{run}")
        found.withColumn("run", F.lit(run)).write.parquet(kept)
        out.append(s.spark.read.schema("week_commencing_date date, records long, repeated_keys long, failed boolean, run int").parquet(kept))
    return reduce(DataFrame.unionByName, out)


@query("stored_late_rows")
def _(s: Setup) -> DataFrame:
    """Retention by day after two runs, of which the second finds that lines of two days before it came late."""
    folder = scratch_table(s.spark, "late")
    day, late = F.col("year_month_day"), [date(1999, 4, 20), date(1999, 5, 1)]
    before = s.src.order_lines.where(~(day.isin(late) & (F.col("order_id") % 3 == 0)))
    tables = {n: (lambda n=n: getattr(s.src, n)) for n in (*FACTS, *LOOKUPS)}
    first, second = (replace(s.p, start=a, end=b) for a, b in ((date(1999, 3, 14), date(1999, 5, 8)), (date(1999, 5, 9), date(1999, 5, 15))))
    for lines, run in ((before, first), (s.src.order_lines, second)):
        src = Sources({**tables, "order_lines": lines})
        refresh(s.spark, src, run, folder, s.cfg, ["retention_mart"], [DAY], with_reports=False, changed_days_only=True)
    return read_table(s.spark, f"{folder}/retention_mart").where(day >= F.lit(date(1999, 3, 28)))


@query("stored_drift")
def _(s: Setup) -> DataFrame:
    """Three upserts of supply rows: the second brings a column, the third, of the same weeks, has none."""
    path = scratch_table(s.spark, "drift")
    day = s.store.stored("supply_mart", [DAY])
    part = day.where(F.col("year_month_day").between(F.lit(date(1999, 1, 1)), F.lit(date(1999, 12, 31))))
    upsert(path, day)
    upsert(path, part.withColumn("name_length", F.char_length("metric_name")))
    upsert(path, part.where(F.col("region") == "France").withColumn("metric_value", F.col("metric_value") + 1))
    return read_table(s.spark, path)


@query("stored_undated_budget")
def _(s: Setup) -> DataFrame:
    """Budget rows without a date, which belong to no week, upserted one region after the other."""
    path = scratch_table(s.spark, "undated")
    day = s.store.stored("budget_mart", [DAY])
    upsert(path, day, BUDGET_KEY, [*BUDGET_MEASURES, "last_modified"])
    dates = ("year_month_day", "week_in_fin_year", "week_commencing_date")
    for region in ("France", "Germany"):
        undated = day.where(F.col("region") == region).withColumns({c: F.lit(None).cast(day.schema[c].dataType) for c in dates})
        upsert(path, undated, BUDGET_KEY, [*BUDGET_MEASURES, "last_modified"])
    return _plain(read_table(s.spark, path))
