"""Acquisition mart against the marketing source."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.checks.reconcile import reconcile
from tidemark.functions.dates import sunday_of
from tidemark.functions.money import from_units, merge_units, stable_sum, sum_units
from tidemark.operators.calendar import in_run
from tidemark.operators.region import region_fanout
from tidemark.operators.scopes import rows_of
from tidemark.params import ALL, DAY, WEEK, MartConfig, RunParams
from tidemark.plans.acquisition import EXCLUDED_CHANNELS, campaign_labels
from tidemark.plans.common import CAMPAIGN_PL, CAMPAIGN_REGION
from tidemark.sources.catalog import Sources

# KPI -> metric; two KPIs of one metric are its sterling and euro amounts.
VOLUMES = {
    "Clicks": "Total Clicks", "Impressions": "Total Impressions", "Installs": "Total Installs", "Visits": "Total Visits",
    "Incremental New Customers": "Incremental New Customers",
}
VOLUMES_AND_SPEND = {**VOLUMES, "Incremental Spend EUR": "Incremental Spend EUR"}
SALES = {"Incremental Gross Sales GBP": "Incremental Gross Sales", "Incremental Gross Sales EUR": "Incremental Gross Sales"}
SPEND = {"Spend GBP": "Marketing Spend", "Spend EUR": "Marketing Spend"}


def _one(kpi: str) -> dict[str, str]:
    return {kpi: VOLUMES[kpi]}


@dataclass(frozen=True)
class CampaignCheck:
    """What to compare, over which period, labelled or as the 'All' level, and how strictly."""

    metrics: dict[str, str]
    period: str = "year_month_day"
    scope: str = DAY
    labelled: bool = True
    tolerance: float = 1.0
    how: str = "full_outer"
    by_line: bool = True

    @property
    def keys(self) -> list[str]:
        labels = ["category", "sub_category"] if self.labelled else []
        return [self.period, *(["product_pl"] if self.by_line else []), "region", *labels, "metric_name"]


WEEKLY = "week_commencing_date"
CHECKS = {
    "campaign_day": CampaignCheck(VOLUMES_AND_SPEND, tolerance=0.0),
    "campaign_summary": CampaignCheck(VOLUMES_AND_SPEND, WEEKLY, labelled=False, by_line=False),
    "campaign_week": CampaignCheck(VOLUMES, WEEKLY, WEEK),
    "incremental_sales_day": CampaignCheck(SALES),
    "incremental_sales_summary": CampaignCheck(SALES, WEEKLY, WEEK, labelled=False),
    "incremental_sales_week": CampaignCheck(SALES, WEEKLY, WEEK),
    "marketing_spend_day": CampaignCheck(SPEND),
    "marketing_spend_summary": CampaignCheck(SPEND, WEEKLY, labelled=False),
    "marketing_spend_week": CampaignCheck(SPEND, WEEKLY, WEEK),
    **{
        f"{name}_{level}": CampaignCheck(_one(kpi), labelled=level == "day", tolerance=0.0, how="inner")
        for name, kpi in {
            "incremental_customers": "Incremental New Customers", "clicks": "Clicks", "impressions": "Impressions",
            "installs": "Installs",
        }.items()
        for level in ("day", "summary")
    },
}


def campaign_source(check: CampaignCheck, src: Sources, p: RunParams, cfg: MartConfig) -> DataFrame:
    """Totals straight from the source. Of a currency pair the line's own currency is kept."""
    facts = src.marketing.where(
        in_run(F.col("activity_date"), p)
        & F.col("kpi").isin(*check.metrics)
        & ~F.col("channel").isin(*EXCLUDED_CHANNELS)
    )
    day = F.col("activity_date")
    period = (sunday_of(day) if check.period == WEEKLY else day).alias(check.period)
    labels = [F.coalesce(v, F.lit(cfg.null_dimension)).alias(k) for k, v in campaign_labels().items()] if check.labelled else []
    raw = facts.groupBy(period, CAMPAIGN_PL, CAMPAIGN_REGION, *labels, "kpi").agg(sum_units(F.col("value")).alias("units"))
    mapped = region_fanout(raw, CAMPAIGN_PL, CAMPAIGN_REGION, src.region_map)
    if len(check.metrics) > len(set(check.metrics.values())):
        mapped = mapped.where(F.col("kpi").endswith("GBP") == (F.col("product_pl") == "UK"))
    metric = F.create_map(*[F.lit(v) for pair in check.metrics.items() for v in pair])[F.col("kpi")]
    return (
        mapped.withColumn("metric_name", metric)
        .groupBy(*check.keys)
        .agg(from_units(merge_units(F.col("units"))).alias("source_value"))
        .where(F.col("source_value") > 0)
    )


def campaign_check(check: CampaignCheck, mart: DataFrame, src: Sources, p: RunParams, cfg: MartConfig) -> DataFrame:
    rows = rows_of(mart, check.scope, sorted(set(check.metrics.values())))
    category, sub_category = F.col("category"), F.col("sub_category")
    level = (category != ALL) & (sub_category != ALL) if check.labelled else (category == ALL) & (sub_category == ALL)
    stored = rows.where(level).groupBy(*check.keys).agg(stable_sum(F.col("metric_value")).alias("mart_value"))
    return reconcile(stored, campaign_source(check, src, p, cfg), check.keys, check.tolerance, True, check.how)
