"""Metrics on their own, for callers that want one and not its family."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.money import from_units, merge_units, sum_units
from tidemark.functions.ratio import safe_ratio
from tidemark.operators.pivot import unpivot_metrics
from tidemark.operators.region import region_fanout
from tidemark.params import ALL, MartConfig, RunParams
from tidemark.plans import monetisation as mon
from tidemark.plans.common import DAY_KEYS, round4
from tidemark.plans.retention import STAGES
from tidemark.sources.catalog import Sources

LINE_METRICS = ("Total Revenue", "Fee Revenue", "Non-Fee Revenue", "Gross Transactions", "Fee Revenue / Transaction")
AD_METRICS = {"revenue": "Revenue", "reach": "Impressions", "ctr": "CTR", "quality": "CPM"}


def line_metric(name: str, src: Sources, p: RunParams, cfg: MartConfig) -> DataFrame:
    """One order-line metric, unrounded, sterling for the United Kingdom only; unneeded sums are pruned."""
    amount = lambda m: mon.picked(m, cfg, "region")
    value: dict[str, Column] = {
        "Total Revenue": amount("total"),
        "Fee Revenue": amount("fees"),
        "Non-Fee Revenue": amount("non_fee"),
        "Gross Transactions": F.col("orders"),
        "Fee Revenue / Transaction": round4(safe_ratio(amount("fees"), F.col("orders"))),
    }
    counted = name in ("Gross Transactions", "Fee Revenue / Transaction")
    rows = mon.line_extract(src, p, cfg) if name != "Gross Transactions" else mon.order_counts(src, p, cfg)
    if counted and name != "Gross Transactions":
        rows = rows.join(mon.order_counts(src, p, cfg), DAY_KEYS)
    return unpivot_metrics(rows, DAY_KEYS, {name: value[name]}).withColumns({"category": F.lit(ALL), "sub_category": F.lit(ALL)})


def ad_metric(name: str, src: Sources, p: RunParams, cfg: MartConfig) -> DataFrame:
    return mon.ads_metrics(src, p, cfg).where(F.col("metric_name") == AD_METRICS[name])


def lifecycle_by_currency(src: Sources, p: RunParams, scope: str) -> DataFrame:
    """Lifecycle sums with net sales in both currencies, as category and stage.

    The totals become an array of categories, each with a map from stage to value, and are
    taken apart again by two explodes over the few aggregated rows.
    """
    counts = {"Volume": "volume", "Retention": "retention", "Churn": "churned"}
    money = {"Sales GBP": "nts_gbp", "Sales EUR": "nts_eur"}
    rows = src.growth_summary.where((F.col("date_scope") == scope) & F.col("year_month_day").between(F.lit(p.start), F.lit(p.end)))
    raw = rows.groupBy("year_month_day", "product_pl", "region").agg(
        *[F.sum(f"{k}_{c}").alias(f"{k}_{c}") for k in STAGES.values() for c in counts.values()],
        *[sum_units(F.col(f"{k}_{c}")).alias(f"{k}_{c}") for k in STAGES.values() for c in money.values()],
    )
    totals = region_fanout(raw, "product_pl", "region", src.region_map).groupBy(*DAY_KEYS).agg(
        *[F.sum(f"{k}_{c}").alias(f"{k}_{c}") for k in STAGES.values() for c in counts.values()],
        *[merge_units(F.col(f"{k}_{c}")).alias(f"{k}_{c}") for k in STAGES.values() for c in money.values()],
    )

    def stages(category: str) -> Column:
        column = {**counts, **money}[category]
        shown = (lambda v: from_units(v)) if category in money else (lambda v: v.cast("double"))
        parts = {stage: F.col(f"{k}_{column}") for stage, k in STAGES.items()}
        entries = [x for stage, v in parts.items() for x in (F.lit(stage), shown(v))]
        if category != "Retention":
            entries += [F.lit("Active"), shown(sum(list(parts.values())[1:], list(parts.values())[0]))]
        return F.struct(F.lit(category).alias("category"), F.create_map(*entries).alias("by_stage"))

    listed = totals.select(*DAY_KEYS, F.explode(F.array(*[stages(c) for c in (*counts, *money)])).alias("c"))
    return listed.select(
        *DAY_KEYS, F.col("c.category").alias("category"), F.explode("c.by_stage").alias("sub_category", "metric_value")
    ).where(F.col("metric_value").isNotNull())
