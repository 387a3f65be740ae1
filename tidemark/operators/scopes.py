"""From day to week to financial year to date, over stored mart rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.money import stable_sum
from tidemark.operators.calendar import in_run, year_weeks
from tidemark.params import DAY, WEEK, RunParams

SERIES = ["product_pl", "region", "category", "sub_category", "metric_name"]


def rows_of(mart: DataFrame, scope: str, metrics=None) -> DataFrame:
    rows = mart.where(F.col("date_scope") == scope)
    return rows if metrics is None else rows.where(F.col("metric_name").isin(*metrics))


def touched(mart: DataFrame, scope: str, column: str, p: RunParams, calendar_years: bool = False) -> DataFrame:
    """Distinct weeks or financial years of the rows a run date range falls on."""
    day = F.col("year_month_day")
    hit = F.year(day).between(p.start.year, p.end.year) if calendar_years else in_run(day, p)
    return rows_of(mart, scope).where(hit).select(column).distinct()


def _week_sum(rows: DataFrame) -> DataFrame:
    return rows.groupBy("week_commencing_date", *SERIES).agg(stable_sum(F.col("metric_value")).alias("metric_value"))


def run_weeks(p: RunParams) -> Column:
    """Literal week range of the run: prunes the mart's partitions before anything is read."""
    return F.col("week_commencing_date").between(F.lit(p.first_week), F.lit(p.last_week))


def roll_to_week(mart: DataFrame, p: RunParams, metrics=None, weeks: DataFrame | None = None) -> DataFrame:
    """Sum DAY rows over every whole week the run touches (days outside the run included)."""
    days = rows_of(mart, DAY, metrics).where(run_weeks(p))
    weeks = touched(mart.where(run_weeks(p)), DAY, "week_commencing_date", p) if weeks is None else weeks
    return _week_sum(days.join(weeks, "week_commencing_date", "left_semi"))


def roll_to_week_by_year(mart: DataFrame, calendar: DataFrame, p: RunParams, metrics) -> DataFrame:
    """As ``roll_to_week`` for all weeks of the financial years the run touches."""
    mart = mart.where(year_weeks(calendar, DAY, p))
    years = touched(mart, DAY, "financial_year", p)
    return _week_sum(rows_of(mart, DAY, metrics).join(years, "financial_year", "left_semi"))


def running_ytd(
    mart: DataFrame, calendar: DataFrame, p: RunParams, metrics=None, calendar_years: bool = False
) -> DataFrame:
    """Running sum of WEEK rows within each financial year the run touches.

    Only those years' partitions are read. A window partition is one series in one year: at
    most 53 rows.
    """
    mart = mart.where(year_weeks(calendar, WEEK, p, calendar_years))
    years = touched(mart, WEEK, "financial_year", p, calendar_years)
    rows = rows_of(mart, WEEK, metrics).join(years, "financial_year", "left_semi")
    by_series = Window.partitionBy("financial_year", *SERIES).orderBy("week_commencing_date")
    running = F.sum(F.col("metric_value").cast("decimal(28,8)")).over(by_series).cast("double")
    return rows.select(
        "financial_year", "week_number", "week_commencing_date", *SERIES, running.alias("metric_value")
    )


def lag_previous_present(df: DataFrame, series: list[str], order: str, value: str, name: str) -> DataFrame:
    """Value of the previous present row of a series, whatever the gap."""
    return df.withColumn(name, F.lag(value).over(Window.partitionBy(*series).orderBy(order)))
