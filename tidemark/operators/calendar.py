"""Calendar attachment and the run's date windows."""

from __future__ import annotations

from datetime import date, timedelta
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.params import DAY, WEEK, RunParams


def in_window(day: Column, start: date, end: date, back: int = 0) -> Column:
    """Both ends included; ``back`` widens the window towards the past. Filters the bare column."""
    return day.between(F.lit(start - timedelta(days=back)), F.lit(end))


def in_run(day: Column, p: RunParams, back: int = 0) -> Column:
    return in_window(day, p.start, p.end, back)


def outside(day: Column, windows) -> Column:
    keep = F.lit(True)
    for first, last in windows:
        keep = keep & ~day.between(F.lit(first), F.lit(last))
    return keep


def attach_calendar(df: DataFrame, calendar: DataFrame, scope: str) -> DataFrame:
    """Inner join adding financial year, week number and week start.

    DAY frames carry ``year_month_day``; WEEK frames carry ``week_commencing_date`` and get
    the week's first day as their ``year_month_day``.
    """
    cal = calendar.where(F.col("date_scope") == scope)
    if scope == DAY:
        cal = cal.select("year_month_day", "financial_year", "week_number", "week_commencing_date")
        return df.join(cal, "year_month_day")
    if scope != WEEK:
        raise ValueError(f"no calendar rows for scope {scope}")
    cal = cal.select("week_commencing_date", "financial_year", "week_number")
    return df.join(cal, "week_commencing_date").withColumn("year_month_day", F.col("week_commencing_date"))


_SPANS: WeakKeyDictionary[DataFrame, tuple[date | None, date | None]] = WeakKeyDictionary()


def require_cover(calendar: DataFrame, p: RunParams) -> None:
    """Raise unless the calendar holds the whole run: facts beyond it would vanish in the joins.

    Read once for each calendar table, while planning.
    """
    if calendar not in _SPANS:
        _SPANS[calendar] = tuple(calendar.agg(F.min("year_month_day"), F.max("year_month_day")).first())
    first, last = _SPANS[calendar]
    if first is None or first > p.start or last < p.end:
        raise ValueError(f"the calendar runs from {first} to {last}, the run from {p.start} to {p.end}")


def year_weeks(calendar: DataFrame, scope: str, p: RunParams, calendar_years: bool = False) -> Column:
    """Literal week range of the financial years the run falls on: prunes the mart's partitions.

    ``scope`` and ``calendar_years`` say which dates of the run count, as in ``touched``.
    """
    day = F.col("year_month_day")
    hit = F.year(day).between(p.start.year, p.end.year) if calendar_years else in_run(day, p)
    years = calendar.where((F.col("date_scope") == scope) & hit).select("financial_year").distinct()
    weeks = calendar.where(F.col("date_scope") == WEEK).join(years, "financial_year", "left_semi")
    first, last = weeks.agg(F.min("week_commencing_date"), F.max("week_commencing_date")).first()
    return F.lit(False) if first is None else F.col("week_commencing_date").between(F.lit(first), F.lit(last))
