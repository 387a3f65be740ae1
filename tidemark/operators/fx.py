"""Exchange rates valid over an interval."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKET_DAYS = 7


def rates_by_interval(rates: DataFrame) -> DataFrame:
    """One row per base currency and validity interval with its GBP and EUR rates."""
    pick = lambda target: F.avg(F.when(F.col("target_currency") == target, F.col("rate")))
    return (
        rates.where(F.col("target_currency").isin("GBP", "EUR"))
        .groupBy("valid_from", "valid_to", "base_currency")
        .agg(pick("GBP").alias("rate_gbp"), pick("EUR").alias("rate_eur"))
    )


def time_bucket(at: Column, first: date, last: date, days: int = BUCKET_DAYS) -> Column:
    """Number of the bucket of days ``at`` falls in; what lies before ``first`` or after ``last`` is in their buckets."""
    day = F.greatest(F.least(F.to_date(at), F.lit(last)), F.lit(first))
    return F.when(at.isNotNull(), F.floor(F.unix_date(day) / days).cast("int"))


def bucketed_intervals(intervals: DataFrame, first: date, last: date, days: int = BUCKET_DAYS) -> DataFrame:
    """Each interval once for every bucket it touches, in ``_bucket``; an interval that ends before it begins has none."""
    begin, end = (time_bucket(F.col(c), first, last, days) for c in ("valid_from", "valid_to"))
    return intervals.where(F.col("valid_from") <= F.col("valid_to")).withColumn("_bucket", F.explode(F.sequence(begin, end)))


def fx_interval_join(facts: DataFrame, rates: DataFrame, currency: str, at: str, days: int = BUCKET_DAYS) -> DataFrame:
    """Left join on currency with the fact's time inside the rate's validity.

    Currency and a bucket of days are the key, the interval is a residual condition: a fact meets
    the few intervals of its week, not the currency's history, and a currency that most facts
    have is spread over as many keys as there are weeks. Only the span of the rates' beginnings is
    read beforehand; times outside it are in the outer buckets, so an interval without an end costs
    no more than the rates' own span.
    """
    by_interval = rates_by_interval(rates)
    first, last = by_interval.agg(F.min(F.to_date("valid_from")), F.max(F.to_date("valid_from"))).first()
    if first is None:
        first = last = date(1970, 1, 1)
    dealt = bucketed_intervals(by_interval, first, last, days)
    keyed = facts.withColumn("_fact_bucket", time_bucket(F.col(at), first, last, days))
    return keyed.join(
        dealt,
        (F.col(currency) == F.col("base_currency"))
        & (F.col("_fact_bucket") == F.col("_bucket"))
        & F.col(at).between(F.col("valid_from"), F.col("valid_to")),
        "left",
    ).drop("base_currency", "valid_from", "valid_to", "_bucket", "_fact_bucket")
