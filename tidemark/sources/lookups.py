"""Reference data the marts join to.

Contents are assumptions where no public table exists; replace them through ``Sources``.
All are built from rules or short value lists whose size Spark knows, so joins to them are
broadcast on that evidence and not on a hint.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.dates import sunday_of

YEAR_STARTS_IN_MONTH = 3  # assumed: the financial year starts on 1 March

# Input pair -> reporting pairs. Every pair also feeds UK & EU / Total, and the
# three cross-border regions also feed Foreign Travel.
BASE_REGION = {
    ("UK", "United Kingdom"): ("UK", "United Kingdom"),
    ("EU", "France"): ("EU", "France"),
    ("EU", "Germany"): ("EU", "Germany"),
    ("EU", "Inbound"): ("EU", "Inbound"),
    ("EU", "RoE"): ("EU", "RoE"),
    ("EU", "United Kingdom"): ("EU", "UK>EU"),
    ("INT", "United Kingdom"): ("EU", "UK>EU"),
    ("EU", "Unknown"): ("EU", "France"),
    ("(null)", "(null)"): ("EU", "France"),
}
FOREIGN_TRAVEL = ("Inbound", "RoE", "UK>EU")

# Country code, name, product line, region.
COUNTRIES = (
    ("GB", "United Kingdom", "UK", "United Kingdom"),
    ("FR", "France", "EU", "France"),
    ("IT", "Italy", "EU", "RoE"),
    ("CY", "Cyprus", "EU", "RoE"),
    ("GE", "Georgia", "EU", "Inbound"),
    ("KR", "South Korea", "EU", "Inbound"),
)
COUNTRY_NAMES = (
    ("United Kingdom", "GB"), ("France", "FR"), ("Korea, Republic of", "KR"), ("Georgia", "GE"),
)


def _table(spark: SparkSession, rows, columns: list[str]) -> DataFrame:
    quote = lambda v: "'" + v.replace("'", "''") + "'"
    values = ", ".join("(" + ", ".join(quote(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(columns)})")


def region_map(spark: SparkSession) -> DataFrame:
    rows = []
    for source, base in BASE_REGION.items():
        rows.append((*source, *base))
        if base[1] in FOREIGN_TRAVEL:
            rows.append((*source, "EU", "Foreign Travel"))
        rows.append((*source, "UK & EU", "Total"))
    return _table(spark, rows, ["input_product_pl", "input_region", "output_product_pl", "output_region"])


def countries(spark: SparkSession) -> DataFrame:
    return _table(spark, COUNTRIES, ["country_code", "country_name", "product_pl", "region"])


def country_names(spark: SparkSession) -> DataFrame:
    return _table(spark, COUNTRY_NAMES, ["country_lookup_value", "country_code"])


def calendar(spark: SparkSession, first: date, last: date) -> DataFrame:
    """DAY and WEEK rows of every date: financial year, week number and week start.

    A week belongs to the financial year its Sunday falls in; week 1 starts on the first
    Sunday of that year.
    """
    days = spark.range((last - first).days + 1, numPartitions=1).select(
        F.date_add(F.lit(first), F.col("id").cast("int")).alias("year_month_day")
    )
    start = F.col("week_commencing_date")
    year = F.year(F.add_months(start, 1 - YEAR_STARTS_IN_MONTH))
    # the last Sunday before the financial year; week numbers count Sundays after it
    eve = sunday_of(F.date_sub(F.make_date(year, F.lit(YEAR_STARTS_IN_MONTH), F.lit(1)), 1))
    dated = days.withColumn("week_commencing_date", sunday_of(F.col("year_month_day"))).select(
        "year_month_day",
        "week_commencing_date",
        year.cast("int").alias("financial_year"),
        (F.datediff(start, eve) / 7).cast("int").alias("week_number"),
    )
    scopes = F.when(F.col("year_month_day") == start, F.array(F.lit("DAY"), F.lit("WEEK"))).otherwise(F.array(F.lit("DAY")))
    return dated.withColumn("date_scope", F.explode(scopes))


def plan_calendar(calendar_rows: DataFrame) -> DataFrame:
    """The planning calendar: one row per date with its week bounds and weekday (1 is Sunday)."""
    day, week = F.col("year_month_day"), F.col("week_commencing_date")
    return calendar_rows.where(F.col("date_scope") == "DAY").select(
        day.alias("report_date"),
        week.alias("report_week_commencing"),
        F.date_add(week, 6).alias("report_week_ending"),
        (F.datediff(day, week) + 1).cast("int").alias("day_of_reporting_week"),
        F.dayofmonth(day).cast("int").alias("day_of_month"),
        F.col("week_number").alias("week_in_fin_year"),
    )


def fx_rates(spark: SparkSession) -> DataFrame:
    # Validity, base, target, rate.
    return spark.sql(
        """SELECT * FROM VALUES
        (timestamp '2024-01-01 00:00:00', timestamp '2024-01-23 23:59:59', 'EUR', 'GBP', 0.85D),
        (timestamp '2024-01-24 00:00:00', timestamp '2024-12-31 23:59:59', 'EUR', 'GBP', 0.86D),
        (timestamp '2024-01-01 00:00:00', timestamp '2024-12-31 23:59:59', 'USD', 'GBP', 0.79D),
        (timestamp '2024-01-01 00:00:00', timestamp '2024-12-31 23:59:59', 'USD', 'EUR', 0.92D)
        AS r(valid_from, valid_to, base_currency, target_currency, rate)"""
    )
