"""Week-on-week and year-on-year comparison."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.ratio import safe_ratio
from tidemark.params import FYTD

WEEK_BACK, YEAR_BACK = 1, 52


def number_weeks(rows: DataFrame) -> DataFrame:
    """Dense number of every reporting week present. The window sees distinct weeks only, 53 a year."""
    weeks = rows.select("week_commencing_date").distinct()
    return weeks.withColumn("week_seq", F.row_number().over(Window.orderBy("week_commencing_date")))


def lagged_compare(rows: DataFrame, series: list[str], numbers: DataFrame | None = None) -> DataFrame:
    """Add wow, wow_ratio, yoy and yoy_ratio to long rows.

    A row matches the row of its series whose dates are 1 (or 52) weeks earlier, provided the
    week numbers are that far apart too; a gap means no match, not the nearest earlier row.
    Both earlier rows come from range frames of one window, so rows are shuffled and sorted
    once; a window partition is one series, a row per date. ``numbers`` are the numbers of all
    reporting weeks, by default of those in ``rows``. FYtD rows have no weekly comparison.
    """
    numbered = rows.join(number_weeks(rows) if numbers is None else numbers, "week_commencing_date")
    dated = ["year_month_day", "week_commencing_date"]
    by_day = Window.partitionBy(*series).orderBy(F.unix_date("year_month_day"))
    found = F.struct("week_commencing_date", "week_seq", "metric_value")
    sides = numbered.withColumns({
        f"_{side}": F.max(found).over(by_day.rangeBetween(-7 * weeks, -7 * weeks))
        for side, weeks in (("week", WEEK_BACK), ("year", YEAR_BACK))
    })

    def past(side: str, weeks: int):
        apart = F.col("week_seq") == F.col(f"_{side}.week_seq") + weeks
        same_day = F.col(f"_{side}.week_commencing_date") == F.date_sub("week_commencing_date", 7 * weeks)
        return F.when(apart & same_day, F.col(f"_{side}.metric_value"))

    cur, week, year = F.col("metric_value"), past("week", WEEK_BACK), past("year", YEAR_BACK)
    change = lambda old: F.coalesce(cur - old, F.lit(0.0))
    growth = lambda old: safe_ratio(cur - old, F.coalesce(old, F.lit(0.0)))
    weekly = F.col("date_scope") != FYTD
    return sides.select(
        *series, *dated, "financial_year", "week_number", "metric_value",
        F.when(weekly, change(week)).alias("wow"),
        F.when(weekly, growth(week)).alias("wow_ratio"),
        change(year).alias("yoy"),
        growth(year).alias("yoy_ratio"),
    )


def weeks_to_rebuild(touched: list[date], stored: list[date]) -> list[date]:
    """Weeks whose comparisons change when ``touched`` are rewritten in a report that holds ``stored``.

    Those weeks and the ones 1 and 52 weeks later; behind a week that is new to the report all
    weeks up to 52 later, as it moves their numbers apart.
    """
    out = {w + timedelta(weeks=k) for w in touched for k in (0, WEEK_BACK, YEAR_BACK)}
    new = sorted(set(touched) - set(stored))
    known = sorted({*touched, *stored})
    for w in new:
        out |= {k for k in known if w < k <= w + timedelta(weeks=YEAR_BACK)}
    return sorted(out & set(known))


def weeks_to_read(rebuilt: list[date]) -> list[date]:
    """The rebuilt weeks and those they are compared with."""
    return sorted({w - timedelta(weeks=k) for w in rebuilt for k in (0, WEEK_BACK, YEAR_BACK)})


def future_placeholders(series: DataFrame, calendar: DataFrame, as_of: date) -> DataFrame:
    """An empty row per non-budget series and calendar day of a week that starts after ``as_of``.

    Generated per series from the calendar's last day, then joined to the calendar by date.
    """
    ahead = calendar.where((F.col("year_month_day") > F.lit(as_of)) & (F.col("week_commencing_date") > F.lit(as_of)))
    days = ahead.select("year_month_day", "financial_year", "week_number", "week_commencing_date").distinct()
    last_day = calendar.agg(F.max("year_month_day")).scalar()
    first_day = F.date_add(F.lit(as_of), 1)
    spread = series.where(~F.col("metric_name").like("%Budget%")).distinct().withColumn(
        "year_month_day", F.explode(F.sequence(first_day, F.greatest(last_day, first_day)))
    )
    empty = F.lit(None).cast("double")
    return spread.join(days, "year_month_day").select(
        *spread.columns, "financial_year", "week_number", "week_commencing_date",
        *[empty.alias(c) for c in ("metric_value", "wow", "wow_ratio", "yoy", "yoy_ratio")],
    )
