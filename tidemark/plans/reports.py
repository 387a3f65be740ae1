"""Reports over the marts: the breakout by label, the overview, and the wide dashboard."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.compare import (
    future_placeholders, lagged_compare, number_weeks, weeks_to_read, weeks_to_rebuild,
)
from tidemark.params import ALL, DAY, FYTD, WEEK, RunParams
from tidemark.plans.retention import GROWTH_NAMES, RATE_NAMES
from tidemark.schema import COMPARISON

# Metrics the reports take from each mart (None takes all).
LIFECYCLE_METRICS = (*GROWTH_NAMES.values(), *RATE_NAMES.values())
HABIT_METRICS = ("Number of Customers", "Net Sales Amount", "Transactions per Customer")
SUPPLY_METRICS = (
    "WBR Gross Sales", "Gross Sales Budget", "WBR Net Sales", "Net Sales Budget", "Total Refunds", "Refunds Ratio",
    "Total Journeys", "Unsellable Journeys", "Unsellable Journey Ratio", "New Customers Budget",
    "Marketing Spend Budget", "Total Revenue Budget", "Total Costs Budget", "Gross Margin Budget", "GM - PMS Budget",
)
BREAKOUT_METRICS = {
    "acquisition_mart": None,
    "monetisation_mart": None,
    "conversion_mart": None,
    "retention_mart": (*LIFECYCLE_METRICS, *HABIT_METRICS),
    "supply_mart": SUPPLY_METRICS,
}
OVERVIEW_METRICS = {
    "acquisition_mart": None,
    "monetisation_mart": (
        "Fee Revenue / Transaction", "Fee Revenue", "Non-Fee Revenue / Visit", "Non-Fee Revenue",
    ),
    "conversion_mart": (
        "Avg Trans Value Budget", "Avg Trans Value", "Conversion Ratio", "Gross Transactions Budget",
        "WBR Gross Transactions", "Total Visits", "Transactions Tracked",
    ),
    "retention_mart": (*LIFECYCLE_METRICS, *HABIT_METRICS, "Total number of Orders"),
    "supply_mart": SUPPLY_METRICS,
}
BREAKOUT_SERIES = [
    "metric_mart_name", "date_scope", "product_pl", "region", "category", "sub_category", "metric_name",
]
OVERVIEW_SERIES = ["date_scope", "product_pl", "region", "metric_name"]


def collate(marts: Mapping[str, DataFrame], wanted: Mapping[str, tuple[str, ...] | None]) -> DataFrame:
    """The wanted rows of every mart, with the mart's name; a missing value counts as zero."""

    def part(name: str, metrics) -> DataFrame:
        rows = marts[name] if metrics is None else marts[name].where(F.col("metric_name").isin(*metrics))
        return rows.select(
            F.lit(name).alias("metric_mart_name"),
            "date_scope", "financial_year", "week_number", "year_month_day", "week_commencing_date",
            "product_pl", "region", "category", "sub_category", "metric_name",
            F.coalesce("metric_value", F.lit(0.0)).alias("metric_value"),
        )

    return reduce(DataFrame.unionByName, [part(name, metrics) for name, metrics in wanted.items()])


def display_name(name: Column) -> Column:
    return F.upper(F.replace(name, F.lit("_"), F.lit(" ")))


@dataclass(frozen=True)
class Rebuild:
    """Part of a report: the weeks to build, the weeks to read for them, and the numbers of all weeks."""

    weeks: list[date]
    read: list[date]
    numbers: DataFrame

    def of(self, marts: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
        """The marts' partitions that are needed."""
        return {name: mart.where(F.col("week_commencing_date").isin(self.read)) for name, mart in marts.items()}


def rebuild(stored: DataFrame, touched: list[date]) -> Rebuild:
    """What a stored report must rebuild when the marts rewrote the ``touched`` weeks."""
    # one date per reporting week, 53 a year
    known = [r[0] for r in stored.select("week_commencing_date").distinct().collect()]
    weeks = weeks_to_rebuild(touched, known)
    every = stored.sparkSession.createDataFrame([(w,) for w in sorted({*touched, *known})], "week_commencing_date date")
    return Rebuild(weeks, weeks_to_read(weeks), number_weeks(every))


def _report(
    rows: DataFrame, series: list[str], calendar: DataFrame | None, p: RunParams, include_future: bool, part: Rebuild | None
) -> DataFrame:
    compared = lagged_compare(rows, series, None if part is None else part.numbers)
    if part is not None:
        compared = compared.where(F.col("week_commencing_date").isin(part.weeks))
    if include_future:
        compared = compared.unionByName(future_placeholders(rows.select(*series), calendar, p.as_of))
    return compared.select(
        *[c for c in series if c != "metric_name"],
        "financial_year", "week_number", "year_month_day", "week_commencing_date",
        F.lit(p.run_ts).cast("timestamp").alias("last_modified"),
        display_name(F.col("metric_name")).alias("metric_name"),
        "metric_value", *COMPARISON,
    )


def breakout_report(
    marts: Mapping[str, DataFrame], p: RunParams, calendar: DataFrame | None = None, include_future: bool = False,
    part: Rebuild | None = None,
) -> DataFrame:
    """Every mart row with its change on the week and the year before.

    ``include_future`` adds empty rows for weeks to come; the stored report has none. ``part``
    builds some weeks only.
    """
    marts = marts if part is None else part.of(marts)
    return _report(collate(marts, BREAKOUT_METRICS), BREAKOUT_SERIES, calendar, p, include_future, part)


def overview_rows(marts: Mapping[str, DataFrame]) -> DataFrame:
    """Rows without labels: the 'All' level of each mart, and all lifecycle metrics."""
    rows = collate(marts, OVERVIEW_METRICS)
    mart, metric = F.col("metric_mart_name"), F.col("metric_name")
    lifecycle = (mart == "retention_mart") & metric.isin(*LIFECYCLE_METRICS)
    kept = rows.where(lifecycle | ((F.col("category") == ALL) & (F.col("sub_category") == ALL)))
    renamed = F.when((mart == "acquisition_mart") & (metric == "Total Visits"), "Acquisition Visits").otherwise(metric)
    return kept.withColumn("metric_name", renamed).drop("metric_mart_name", "category", "sub_category")


def overview_status(
    marts: Mapping[str, DataFrame], p: RunParams, calendar: DataFrame | None = None, include_future: bool = False,
    part: Rebuild | None = None,
) -> DataFrame:
    marts = marts if part is None else part.of(marts)
    return _report(overview_rows(marts), OVERVIEW_SERIES, calendar, p, include_future, part)


# Dashboard column suffix -> metric name, as the overview stores it. DAY_Cost_Per_Click is
# empty on purpose: cost per click exists per week and year to date only.
DASHBOARD_METRICS = {
    "28_56_Day_Churned_Customers": "28d Person moved Active to Inactive",
    "28_56_Day_New_Customers": "28d Early life Person Count",
    "28_56_Day_Resurrected_Customers": "28d Resurrected Person Count",
    "28_56_Day_Retained_Customers": "28d Retained Person Count",
    "Active_Customers": "Active Customers",
    "Avg_Trans_Value": "Avg Trans Value",
    "Conversion_Ratio": "Conversion Ratio",
    "Cost_Per_Click": "Cost / Click",
    "Existing_Customers": "Existing Customers",
    "Fee_Revenue_Per_Transaction": "Fee Revenue / Transaction",
    "Fee_Revenue": "Fee Revenue",
    "GM_Minus_PMS": "GM - PMS",
    "Gross_Margin": "Gross Margin",
    "Gross_Sales": "WBR Gross Sales",
    "Gross_Transactions": "WBR Gross Transactions",
    "Marketing_Spend": "Marketing Spend",
    "Net_Sales": "WBR Net Sales",
    "New_Customers": "New Customers",
    "Non_Fee_Revenue_Per_Visit": "Non-Fee Revenue / Visit",
    "Non_Fee_Revenue": "Non-Fee Revenue",
    "Total_Clicks": "Total Clicks",
    "Total_Costs": "Total Costs",
    "Total_Impressions": "Total Impressions",
    "Total_Refunds": "Total Refunds",
    "Total_Revenue": "Total Revenue",
    "Total_Visits": "Total Visits",
    "Transactions_Tracked": "Transactions Tracked",
}
DASHBOARD_KEY = ["financial_year", "week_number", "year_month_day", "week_commencing_date", "product_pl", "region"]


def dashboard_pivot(overview: DataFrame, modified_on: datetime | None = None, ordered: bool = True) -> DataFrame:
    """One wide row per day, line and region: each metric at each scope.

    Weekly and year-to-date rows are dated by their week's Sunday, so they fall on that day's
    row by key; one conditional aggregate replaces a pivot per scope and the joins between
    them. Only days with daily rows are shown.
    """
    rows = overview.where(~F.col("metric_name").like("%BUDGET%"))
    if modified_on is not None:
        rows = rows.where(F.to_date("last_modified") == F.lit(modified_on).cast("date"))

    def value(scope: str, suffix: str, metric: str) -> Column:
        hit = (F.col("date_scope") == scope) & (F.col("metric_name") == metric.upper())
        if suffix == "Non_Fee_Revenue_Per_Visit":
            hit = hit & (F.col("region") != "UK>EU")
        return F.max(F.when(hit, F.col("metric_value"))).alias(f"{scope}_{suffix}")

    cells = [value(scope, suffix, metric) for scope in (DAY, WEEK, FYTD) for suffix, metric in DASHBOARD_METRICS.items()]
    daily = F.max((F.col("date_scope") == DAY).cast("int")).alias("_daily")
    wide = rows.groupBy(*DASHBOARD_KEY).agg(daily, *cells).where(F.col("_daily") == 1).drop("_daily")
    return wide.orderBy(*DASHBOARD_KEY) if ordered else wide
