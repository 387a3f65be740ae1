"""Calendar arithmetic on columns."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def monday_after_shift(day: Column) -> Column:
    """Identity of the Sunday-to-Saturday week holding ``day``: the Monday inside it."""
    return F.date_trunc("week", F.date_add(day, 1)).cast("date")


def sunday_of(day: Column) -> Column:
    return F.date_sub(monday_after_shift(day), 1)


def plan_week(text: Column) -> Column:
    """Budget files write dates as two-digit day/month/year (MM is the month, mm would be minutes).

    Spark reads every two-digit year as 20xx; years from 46 on are meant as 19xx.
    """
    parsed = F.to_date(text, "dd/MM/yy")
    return F.when(F.year(parsed) > 2045, F.add_months(parsed, -1200)).otherwise(parsed)


def year_month(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")
