"""Long to wide and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DROP = {
    "null": lambda v: v.isNotNull(),
    "zero": lambda v: F.coalesce(v, F.lit(0.0)) != 0,
    "nonpositive": lambda v: v > 0,
    None: lambda v: F.lit(True),
}


def unpivot_metrics(
    df: DataFrame, keys: list[str], metrics: dict[str, Column] | list[tuple[dict[str, str], Column]], drop: str | None = "null"
) -> DataFrame:
    """One row per metric from a wide aggregate.

    ``metrics`` maps metric names to value expressions, or lists ``(labels, value)`` pairs
    when a metric also sets its category or sub_category. Runs after aggregation, on a few
    rows per day, never on facts.
    """
    pairs = [({"metric_name": k}, v) for k, v in metrics.items()] if isinstance(metrics, dict) else metrics
    rows = [
        F.struct(*[F.lit(v).alias(k) for k, v in labels.items()], value.cast("double").alias("metric_value"))
        for labels, value in pairs
    ]
    return df.select(*keys, F.inline(F.array(*rows))).where(DROP[drop](F.col("metric_value")))


def kpi_pivot(df: DataFrame, keys: list[str], name_col: str, value_col: str, names: dict[str, str]) -> DataFrame:
    """Columns from long rows: ``names`` maps output column to the name it picks."""
    cols = [F.max(F.when(F.col(name_col) == name, F.col(value_col))).alias(out) for out, name in names.items()]
    return df.groupBy(*keys).agg(*cols)
