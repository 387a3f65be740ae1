"""Spreading monthly budgets over days."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.dates import year_month
from tidemark.functions.money import from_units, sum_units


def weekday_weights(lines: DataFrame, calendar: DataFrame, as_of: date, months: int = 6) -> DataFrame:
    """Average net sales of each weekday over the last months, relative to the average day.

    The look-back runs from the start of the reporting week six months ago to the end of the
    current one. The calendar's one row of bounds is read while planning: as literals they
    reach the fact scan, which then skips everything older.
    """
    edge = calendar.where(F.col("report_date").isin(F.lit(as_of), F.add_months(F.lit(as_of), -months)))
    bounds = edge.agg(F.min("report_week_commencing").alias("first_day"), F.max("report_week_ending").alias("last_day")).first()
    daily = (
        lines.where(F.col("year_month_day").between(F.lit(bounds.first_day), F.lit(bounds.last_day)))
        .groupBy("year_month_day")
        .agg(sum_units(F.col("m_net_sales_amount_gbp")).alias("net_units"))
    )
    weekday = calendar.select(F.col("report_date").alias("year_month_day"), "day_of_reporting_week")
    by_weekday = (
        daily.join(weekday, "year_month_day")
        .groupBy("day_of_reporting_week")
        .agg(F.sum(F.col("net_units").cast("decimal(20,0)")).alias("net_units"), F.count("*").alias("days"))
        .select("day_of_reporting_week", F.try_divide(from_units(F.col("net_units")), F.col("days").cast("double")).alias("avg_dow"))
    )
    # seven rows: the global window is over weekdays, not facts
    average_day = F.sum(F.col("avg_dow").cast("decimal(28,8)")).over(Window.partitionBy()).cast("double") / F.lit(7.0)
    return by_weekday.select("day_of_reporting_week", F.try_divide(F.col("avg_dow"), average_day).alias("ratio"))


def month_days(calendar: DataFrame) -> DataFrame:
    """Every calendar day with its month and the month's number of days present."""
    month = Window.partitionBy("year_month")
    return calendar.withColumn("year_month", year_month(F.col("report_date"))).select(
        "year_month", "report_date", "day_of_reporting_week", "week_in_fin_year", "report_week_commencing",
        F.max("day_of_month").over(month).alias("days_month"),
    )


def spread_budget(monthly: DataFrame, calendar: DataFrame, weights: DataFrame) -> DataFrame:
    """Monthly budget rows, once per day of the month, with the day's weight. Left joins keep
    a month the calendar does not know as one undated row."""
    return monthly.join(month_days(calendar), "year_month", "left").join(weights, "day_of_reporting_week", "left")


def complete_weeks_only(daily: DataFrame, keys: list[str], measures: list[str], flag: str, days: int = 7) -> DataFrame:
    """Weekly sums, zeroed unless ``flag`` is non-zero on all ``days`` of the week."""
    present = F.sum(F.when(F.col(flag) == 0, 0).otherwise(1))
    sums = [F.sum(c).alias(c) for c in measures]
    whole = F.when(F.col("_days") == days, F.lit(1)).otherwise(F.lit(0))
    weekly = daily.groupBy(*keys).agg(present.alias("_days"), *sums)
    return weekly.withColumn("complete", whole).drop("_days")
