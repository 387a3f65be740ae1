"""Year-to-date totals carried from run to run.

Beside a stored mart lies a state: per week and series the running total through that week, also of
series without a row that week, so the week before holds all that a run must know of the past. A run
adds the weeks that changed to it and shifts the later weeks of the year by the difference. Totals are
decimals, so carrying gives the bits of adding up anew.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.scopes import SERIES, rows_of, running_ytd
from tidemark.params import WEEK, MartConfig, RunParams
from tidemark.schema import PARTITION
from tidemark.sinks.columns import columns_of
from tidemark.sinks.files import Folder
from tidemark.sinks.upsert import read_parts, upsert
from tidemark.sinks.weeks import newest_note, signature, stored_weeks, write_note
from tidemark.sources.catalog import Sources

#: days of a run that still carries totals; a longer one, a backfill, adds its years up and lets the state go
LONGEST_RUN = 400
KEY = ["financial_year", "week_number", PARTITION, *SERIES]
TOTAL = "decimal(28,8)"
SEEN = "_seen"


def remember(spark: SparkSession, mart: str, state: str, calendar: DataFrame, p: RunParams) -> None:
    """Note what the mart's weeks look like now that the state holds them: to be called once the running totals are written."""
    weeks = {w for _, _, w in run_years(calendar, p)}
    number, held = newest_note(spark, f"{state}/{SEEN}")
    held |= {str(w): signature(spark, mart, w) for w in stored_weeks(spark, mart) if w in weeks}
    write_note(spark, f"{state}/{SEEN}", number, held)


def carries(p: RunParams) -> bool:
    return (p.end - p.start).days <= LONGEST_RUN


def forget_state(spark: SparkSession, state: str) -> None:
    """After totals were written without it; the next run that carries starts from the beginning of its year."""
    Folder(spark, state).drop()


def run_years(calendar: DataFrame, p: RunParams) -> list[tuple[int, int, date]]:
    """Financial year, number and start of all weeks of the years the run's weeks are in: 53 a year."""
    weeks = calendar.where(F.col("date_scope") == WEEK).select("financial_year", "week_number", PARTITION).distinct()
    mine = weeks.where(F.col(PARTITION).between(F.lit(p.first_week), F.lit(p.last_week))).select("financial_year").distinct()
    return sorted(map(tuple, weeks.join(mine, "financial_year", "left_semi").collect()), key=lambda r: r[2])


def carried_ytd(mart: DataFrame, mart_path: str, state: str, calendar: DataFrame, p: RunParams, metrics=None) -> DataFrame:
    """Running totals of the run's financial years, from the first week that changed on.

    Changed are the run's weeks and those whose files are not the ones the state has seen. Read are
    the WEEK rows from the first of them to the last, the state of the week before, and the state's
    later weeks of that year. The state is brought up to date; its rows are the result.
    """
    spark = mart.sparkSession
    years = run_years(calendar, p)
    known, seen = set(stored_weeks(spark, state)), newest_note(spark, f"{state}/{SEEN}")[1]
    moved = [w for _, _, w in years if p.first_week <= w <= p.last_week or signature(spark, mart_path, w) != seen.get(str(w), [])]
    if not moved:
        return mart.where(F.lit(False)).select(*KEY, F.lit(0.0).alias("metric_value"))
    first, last = min(moved), max(moved)
    year_of = {w: y for y, _, w in years}
    of = lambda w: [x for x in year_of if year_of[x] == year_of[w]]
    earlier = [w for w in of(first) if w < first]
    prefix_week = max((w for w in earlier if w in known), default=None)
    if prefix_week is None and earlier:
        first = min(earlier)  # this year has no state yet
    if not any(w in known for w in of(last)):
        last = max(of(last))
    later_weeks = [w for w in of(last) if w > last and w in known]
    found = columns_of(spark, state)
    old = lambda weeks: read_parts(spark, state, found[1], PARTITION, weeks)

    rows = rows_of(mart, WEEK, metrics).where(F.col(PARTITION).between(F.lit(first), F.lit(last)))
    own = rows.select(*KEY, F.col("metric_value").cast(TOTAL).alias("amount"))
    before = own.where(F.lit(False)) if prefix_week is None else old([prefix_week]).select(*KEY, F.col("running").alias("amount"))
    series = own.select("financial_year", *SERIES).unionByName(before.select("financial_year", *SERIES)).distinct()
    weeks = own.select("financial_year", "week_number", PARTITION).distinct()
    grid = series.join(weeks, "financial_year").join(own.withColumn("present", F.lit(True)), KEY, "left")
    both = grid.unionByName(before.withColumn("present", F.lit(None).cast("boolean")))
    so_far = Window.partitionBy("financial_year", *SERIES).orderBy(PARTITION)
    summed = both.withColumn("running", F.sum("amount").over(so_far).cast(TOTAL)).where(
        F.col("running").isNotNull() & F.col(PARTITION).between(F.lit(first), F.lit(last))
    )
    new = summed.select(*KEY, "running", F.coalesce("present", F.lit(False)).alias("present"))
    if later_weeks:
        new = new.unionByName(_shifted(new, old(later_weeks), [w for w in of(last) if w <= last], known, old, years, later_weeks))
    upsert(state, new, KEY, None)
    now = read_parts(spark, state, columns_of(spark, state)[1], PARTITION, [w for w in year_of if w >= first])
    return now.where("present").select(*KEY, F.col("running").cast("double").alias("metric_value"))


def _shifted(new: DataFrame, later: DataFrame, upto: list[date], known: set[date], old, years, later_weeks: list[date]) -> DataFrame:
    """The later weeks of the last year, by what its total through the last changed week has moved; series that came new follow."""
    year = {w: (y, n) for y, n, w in years}
    own = new.where(F.col("financial_year") == year[upto[-1]][0])
    at = F.max(F.struct(PARTITION, "running")).alias("top")
    latest = own.groupBy("financial_year", *SERIES).agg(at).select("financial_year", *SERIES, F.col("top.running").alias("total"))
    held_week = max((w for w in upto if w in known), default=None)
    held = later.where(F.lit(False)) if held_week is None else old([held_week])
    moved = latest.join(held.select(*SERIES, F.col("running").alias("was")), SERIES, "left")
    weeks = F.array(*[F.struct(F.lit(year[w][1]).cast("int").alias("week_number"), F.lit(w).alias(PARTITION)) for w in later_weeks])
    asked = moved.withColumn("week", F.explode(weeks)).select("financial_year", "week.week_number", f"week.{PARTITION}", *SERIES, "total", "was")
    both = asked.join(later.select(*KEY, "running", "present"), KEY, "full")
    shifted = F.col("running") + F.coalesce(F.col("total") - F.coalesce("was", F.lit(0)), F.lit(0))
    return both.select(*KEY, F.coalesce(shifted, "total").cast(TOTAL).alias("running"), F.coalesce("present", F.lit(False)).alias("present"))


def year_to_date(mart: DataFrame, src: Sources, p: RunParams, cfg: MartConfig, metrics=None, calendar_years: bool = False) -> DataFrame:
    """Running totals of WEEK rows: carried if the run keeps a state, else added up over the years it touches."""
    if cfg.ytd_state is None:
        return running_ytd(mart, src.calendar, p, metrics, calendar_years)
    return carried_ytd(mart, *cfg.ytd_state, src.calendar, p, metrics)
