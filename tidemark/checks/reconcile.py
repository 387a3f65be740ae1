"""Comparing a mart with an independent recount, and summarising comparisons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def whole(value: Column) -> Column:
    """Nearest whole number; a plain cast would cut the decimals off."""
    return F.round(value, 0).cast("long")


def reconcile(
    mart: DataFrame, source: DataFrame, keys: list[str], tolerance: float = 0.0, whole_numbers: bool = False,
    how: str = "full_outer",
) -> DataFrame:
    """``mart_value`` beside ``source_value`` per key, with their difference and a verdict.

    A full outer comparison also fails keys only one side has; an inner one leaves them out.
    """
    sides = mart.join(source, keys, how)
    m, s = F.col("mart_value"), F.col("source_value")
    gap = F.abs(whole(m) - whole(s)).cast("double") if whole_numbers else F.abs(m - s)
    return sides.select(*keys, m, s, gap.alias("difference")).withColumn(
        "failed", F.coalesce(F.col("difference") > tolerance, F.lit(True))
    )


def failing(comparison: DataFrame) -> DataFrame:
    """The offending rows; an empty result is a pass."""
    return comparison.where("failed")


def tally(comparison: DataFrame, by: list[str]) -> DataFrame:
    """Rows compared and failed per group."""
    return comparison.groupBy(*by).agg(
        F.count("*").alias("compared"), F.sum(F.col("failed").cast("int")).alias("failures")
    )
