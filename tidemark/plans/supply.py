"""Supply mart: sales, refunds, journeys and the weekly budget."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import plan_week
from tidemark.functions.ratio import currency_pick, safe_ratio
from tidemark.operators.calendar import in_run, in_window
from tidemark.operators.gate import to_mart
from tidemark.operators.pivot import unpivot_metrics
from tidemark.operators.ratios import Ratio, with_ratios
from tidemark.operators.scopes import roll_to_week
from tidemark.params import ALL, DAY, FYTD, WEEK, MartConfig, RunParams
from tidemark.plans.common import (
    DAY_KEYS, LINE_PL, LINE_REGION, both_currencies, qualifying_lines, region_totals, round4,
)
from tidemark.plans.ytd import year_to_date
from tidemark.sources.catalog import Sources

SALES = {"gross_sales": "m_gross_sales_amount", "net_sales": "m_net_sales_amount", "refunds": "m_refunded_amount"}
ADDITIVE = ("WBR Gross Sales", "WBR Net Sales", "Total Refunds", "Total Journeys", "Unsellable Journeys")
BUDGET_METRICS = {
    "Gross Sales Budget": "gross_sales_budget", "Net Sales Budget": "net_sales_budget",
    "Total Revenue Budget": "total_revenue_budget", "Total Costs Budget": "total_costs_budget",
    "Gross Margin Budget": "gross_margin_budget", "Marketing Spend Budget": "marketing_spend_budget",
    "GM - PMS Budget": "gm_minus_pms_budget", "New Customers Budget": "new_customers_budget",
}
RATIOS = [
    Ratio("Refunds Ratio", "Total Refunds", "WBR Gross Sales"),
    Ratio("Unsellable Journey Ratio", "Unsellable Journeys", "Total Journeys"),
]
UNLABELLED = {"category": ALL, "sub_category": ALL}


def _unlabelled(df: DataFrame) -> DataFrame:
    return df.withColumns({name: F.lit(label) for name, label in UNLABELLED.items()})


def sales_metrics(src: Sources, p: RunParams, cfg: MartConfig) -> DataFrame:
    lines = qualifying_lines(src, cfg).where(in_run(F.col("year_month_day"), p))
    totals = region_totals(lines, ["year_month_day"], LINE_PL, LINE_REGION, src.region_map, both_currencies(SALES))
    pick = lambda m: currency_pick(F.col(f"{m}_gbp"), F.col(f"{m}_eur"), total=cfg.total_currency)
    picked = totals.select(*DAY_KEYS, *[pick(m).alias(m) for m in SALES])
    return unpivot_metrics(picked, DAY_KEYS, {
        "WBR Gross Sales": round4(F.col("gross_sales")),
        "WBR Net Sales": round4(F.col("net_sales")),
        "Total Refunds": round4(F.col("refunds")),
        "Refunds Ratio": round4(safe_ratio(F.col("refunds"), F.col("gross_sales"))),
    })


def journey_metrics(src: Sources, p: RunParams, cfg: MartConfig) -> DataFrame:
    """Searched train journeys; the origin country's code is the text before ' - '."""
    origin = F.split("search_odpair_country_name", " - ", 2)[0]
    searches = src.journey_searches.where(
        in_run(F.col("year_month_day"), p)
        & F.col("search_managed_group_id").isin(*cfg.managed_groups)
        & F.lower("search_result_transport_mode").like("%train%")
    )
    # reduced per origin before the country and region joins
    per_origin = searches.groupBy("year_month_day", origin.alias("origin")).agg(
        F.sum(F.coalesce("m_search_result_journey_count", F.lit(0))).alias("journeys"),
        F.sum("m_search_result_unsellable_journey_count").alias("unsellable"),
    )
    placed = per_origin.join(src.countries, F.col("origin") == F.col("country_code")).select(
        "year_month_day", "product_pl", "region", "journeys", "unsellable"
    )
    counts = {"journeys": F.col("journeys"), "unsellable": F.col("unsellable")}
    totals = region_totals(placed, ["year_month_day"], "product_pl", "region", src.region_map, counts=counts)
    return unpivot_metrics(totals, DAY_KEYS, {
        "Total Journeys": F.col("journeys"),
        "Unsellable Journeys": F.col("unsellable"),
        "Unsellable Journey Ratio": round4(safe_ratio(F.col("unsellable"), F.col("journeys"))),
    })


def supply_day(src: Sources, p: RunParams, cfg: MartConfig) -> DataFrame:
    rows = sales_metrics(src, p, cfg).unionByName(journey_metrics(src, p, cfg))
    return to_mart(_unlabelled(rows), DAY, src.calendar, p)


def weekly_budget(src: Sources, p: RunParams) -> DataFrame:
    """Budget metrics by the file's own region, neither mapped nor totalled."""
    budget = src.weekly_budget.withColumn("week_commencing_date", plan_week(F.col("report_week_commencing"))).where(
        in_window(F.col("week_commencing_date"), p.start, p.end)
    ).withColumn("product_pl", F.when(F.col("region") == "United Kingdom", "UK").otherwise("EU"))
    keys = ["week_commencing_date", "product_pl", "region"]
    return unpivot_metrics(budget, keys, {name: F.col(column) for name, column in BUDGET_METRICS.items()})


def supply_week(mart: DataFrame, src: Sources, p: RunParams, cfg: MartConfig) -> DataFrame:
    keys = ["week_commencing_date", "product_pl", "region", "category", "sub_category"]
    weekly = roll_to_week(mart, p, ADDITIVE)
    rows = with_ratios(weekly, keys, RATIOS).unionByName(_unlabelled(weekly_budget(src, p)))
    return to_mart(rows, WEEK, src.calendar, p)


def supply_fytd(mart: DataFrame, src: Sources, p: RunParams, cfg: MartConfig) -> DataFrame:
    running = year_to_date(mart, src, p, cfg, (*ADDITIVE, *BUDGET_METRICS))
    keys = [c for c in running.columns if c not in ("metric_name", "metric_value")]
    return to_mart(with_ratios(running, keys, RATIOS), FYTD, src.calendar, p)
