"""Retention mart against the growth summary and order lines."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.checks.monetisation import base_pair
from tidemark.functions.money import from_units, merge_units, sum_units
from tidemark.functions.ratio import currency_pick
from tidemark.operators.calendar import in_run
from tidemark.operators.pivot import kpi_pivot
from tidemark.operators.rollup import count_each
from tidemark.operators.scopes import rows_of
from tidemark.params import ALL, DAY, WEEK, MartConfig, RunParams
from tidemark.plans.common import DAY_KEYS, LINE_PL, LINE_REGION, round4
from tidemark.plans.extracts import order_rows
from tidemark.plans.retention import GROWTH_NAMES, STAGES
from tidemark.sources.catalog import Sources

JOURNEYS = {"commute": "Commute and Regional", "leisure": "Leisure and Long Distance", "summary": ALL}


def _side_by_side(mart: DataFrame, source: DataFrame, measures: list[str], judged: list[str], failed=None) -> DataFrame:
    """Measures of both sides per day, line and region; any differing judged measure fails the row."""
    m = mart.select(*DAY_KEYS, *[F.col(c).alias(f"mart_{c}") for c in measures])
    s = source.select(*DAY_KEYS, *[F.col(c).cast("double").alias(f"source_{c}") for c in measures])
    verdict = F.lit(False)
    for c in judged:
        verdict = verdict | F.coalesce(F.col(f"mart_{c}") != F.col(f"source_{c}"), F.lit(False))
    return m.join(s, DAY_KEYS).withColumn("failed", verdict if failed is None else failed)


def lifecycle_check(stage: str, mart: DataFrame, src: Sources, p: RunParams, scope: str = DAY) -> DataFrame:
    """Persons, net sales, kept and lost persons of one lifecycle stage."""
    k = STAGES[stage]
    names = {
        "customers": GROWTH_NAMES["Volume", stage], "net_sales": GROWTH_NAMES["Net Sales Amount", stage],
        "retained": GROWTH_NAMES["Retention", stage], "churned": GROWTH_NAMES["Churn", stage],
    }
    stored = kpi_pivot(
        rows_of(mart, scope).where(in_run(F.col("year_month_day"), p) & (F.col("sub_category") == stage)),
        DAY_KEYS, "metric_name", "metric_value", names,
    )
    pl, region = base_pair(F.col("product_pl"), F.col("region"))
    day = F.date_sub("year_month_day", 1) if scope == WEEK else F.col("year_month_day")
    amounts = {cur: from_units(sum_units(F.col(f"{k}_nts_{cur}"))) for cur in ("gbp", "eur")}
    summary = src.growth_summary.where(
        (F.col("date_scope") == scope)
        & F.col("year_month_day").between(F.lit(p.start), F.lit(p.end + timedelta(days=1)))
    ).select("*", day.alias("_day"), pl.alias("_pl"), region.alias("_region"))
    source = summary.groupBy(F.col("_day").alias("year_month_day"), F.col("_pl").alias("product_pl"), F.col("_region").alias("region")).agg(
        F.sum(f"{k}_volume").alias("customers"), F.sum(f"{k}_retention").alias("retained"),
        F.sum(f"{k}_churned").alias("churned"), *[v.alias(c) for c, v in amounts.items()],
    ).withColumn("net_sales", round4(currency_pick(F.col("gbp"), F.col("eur"))))
    measures = list(names)
    return _side_by_side(stored, source, measures, measures)


def _class_filter(journey: str) -> Column:
    kind = F.col("journey_class")
    return kind.isNotNull() if journey == "summary" else kind == JOURNEYS[journey]


def journey_check(
    journey: str, mart: DataFrame, src: Sources, p: RunParams, cfg: MartConfig, coarse: bool = False
) -> DataFrame:
    """Customers, orders and net sales of a journey class.

    The summary judges net sales only, as its customers and orders add up classes. ``coarse``
    is the weekly and year-to-date rule: net sales within 0.2 percent.
    """
    names = {
        "customers": "Number of Customers", "net_sales": "Net Sales Amount", "orders": "Total number of Orders",
    }
    rows = rows_of(mart, DAY).where(in_run(F.col("year_month_day"), p) & (F.col("sub_category") == JOURNEYS[journey]))
    if journey == "summary":
        rows = rows.where(F.col("category") == ALL)
    stored = kpi_pivot(rows, DAY_KEYS, "metric_name", "metric_value", names)
    pl, region = base_pair(F.col(LINE_PL), F.col(LINE_REGION))
    kept = order_rows(src, p, cfg).where(in_run(F.col("year_month_day"), p) & _class_filter(journey))
    orders = kept.select(
        "year_month_day", pl.alias("product_pl"), region.alias("region"), "order_customer_id", "order_id", "gbp", "eur"
    ).dropna(subset=DAY_KEYS)
    money = [from_units(merge_units(F.col(c))).alias(c) for c in ("gbp", "eur")]
    source = count_each(orders, DAY_KEYS, {"customers": "order_customer_id", "orders": "order_id"}, money).withColumn(
        "net_sales", round4(currency_pick(F.col("gbp"), F.col("eur")))
    )
    off = F.try_divide(F.abs(F.col("mart_net_sales") - F.col("source_net_sales")) * 100.0, F.col("source_net_sales"))
    judged = ["net_sales"] if journey == "summary" else list(names)
    return _side_by_side(stored, source, list(names), judged, F.coalesce(off > 0.2, F.lit(False)) if coarse else None)
