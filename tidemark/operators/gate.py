"""Assembling mart rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.calendar import attach_calendar, require_cover
from tidemark.params import FYTD, RunParams
from tidemark.schema import MART_KEY, as_mart


def notnull_gate(df: DataFrame) -> DataFrame:
    """Rows with every key and a value; nothing else enters a mart."""
    return df.dropna(subset=MART_KEY + ["metric_value"])


def to_mart(df: DataFrame, scope: str, calendar: DataFrame, p: RunParams) -> DataFrame:
    """Calendar, scope label, stamp and gate on metric rows of one scope.

    FYtD rows already carry their week's calendar columns. The calendar must cover the run.
    Metric rows are unique per key by construction, which the upsert enforces, so no DISTINCT
    pass is needed.
    """
    require_cover(calendar, p)
    dated = df.withColumn("year_month_day", F.col("week_commencing_date")) if scope == FYTD else attach_calendar(df, calendar, scope)
    stamped = dated.withColumn("date_scope", F.lit(scope)).withColumn("last_modified", F.lit(p.run_ts))
    return notnull_gate(as_mart(stamped))
