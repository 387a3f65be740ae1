"""Conversion mart: transactions by journey type, visits by platform, and their budget."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import plan_week
from tidemark.functions.money import from_units, merge_units, sum_units, to_units
from tidemark.functions.ratio import currency_pick, plain_ratio, round_half_up, safe_ratio
from tidemark.functions.taxonomy import journey_type
from tidemark.operators.calendar import in_run
from tidemark.operators.gate import to_mart
from tidemark.operators.pivot import unpivot_metrics
from tidemark.operators.ratios import Ratio, with_ratios
from tidemark.operators.region import region_fanout
from tidemark.operators.rollup import count_levels, grouping_levels, label_levels, over_all_tasks
from tidemark.operators.scopes import roll_to_week
from tidemark.params import ALL, DAY, FYTD, WEEK, MartConfig, RunParams
from tidemark.plans.common import (
    CAMPAIGN_PL, CAMPAIGN_REGION, DAY_KEYS, LINE_PL, LINE_REGION, is_gross_sale, qualifying_lines,
)
from tidemark.plans.ytd import year_to_date
from tidemark.sources.catalog import Sources

ADDITIVE = ("Gross Sales", "WBR Gross Transactions", "Total Visits", "Transactions Tracked")
RATIOS = [
    Ratio("Avg Trans Value", "Gross Sales", "WBR Gross Transactions", missing=0.0, drop_zero=True),
    Ratio("Conversion Ratio", "Transactions Tracked", "Total Visits", missing=0.0, drop_zero=True),
]
PLAN_RATIO = Ratio("Avg Trans Value Budget", "Gross Sales Budget", "Gross Transactions Budget")


def journey_sales(src: Sources, p: RunParams, cfg: MartConfig) -> DataFrame:
    """Orders and gross sales by journey type and in total.

    Lines are dealt by day and order before the fan-out, so it and the two levels multiply rows
    within a task only, and the distinct count spreads over order ids.
    """
    lines = qualifying_lines(src, cfg).where(in_run(F.col("year_month_day"), p) & is_gross_sale())
    kind = journey_type(
        F.col(LINE_PL), F.col(LINE_REGION),
        F.col("fare_train_classification_name_longest_duration"), F.col("product_train_speed_code"),
    )
    narrow = lines.select(
        "year_month_day", LINE_PL, LINE_REGION, kind.alias("sub_category"), "order_id",
        to_units(F.col("m_gross_sales_amount_gbp")).alias("gbp"), to_units(F.col("m_gross_sales_amount_eur")).alias("eur"),
    )
    mapped = region_fanout(over_all_tasks(narrow, "year_month_day", "order_id"), LINE_PL, LINE_REGION, src.region_map)
    levels = count_levels(
        mapped, DAY_KEYS, ["sub_category"], "order_id", "orders", {c: merge_units(F.col(c)) for c in ("gbp", "eur")}
    )
    sales = currency_pick(from_units(F.col("gbp")), from_units(F.col("eur")), total=cfg.total_currency)
    rows = unpivot_metrics(levels, DAY_KEYS + ["sub_category"], {
        "WBR Gross Transactions": F.col("orders"),
        "Gross Sales": sales,
        "Avg Trans Value": safe_ratio(sales, F.col("orders")),
    })
    return label_levels(rows, category=["Journey Type", ALL])


def platform_visits(src: Sources, p: RunParams, cfg: MartConfig) -> DataFrame:
    facts = src.marketing.where(
        in_run(F.col("activity_date"), p)
        & F.col("kpi").isin("Visits", "Transactions Tracked")
        & F.col("platform").isNotNull()
    )
    raw = facts.groupBy(
        F.col("activity_date").alias("year_month_day"), CAMPAIGN_PL, CAMPAIGN_REGION, F.col("platform").alias("sub_category"),
        "kpi",
    ).agg(sum_units(F.col("value")).alias("units"))
    mapped = region_fanout(raw, CAMPAIGN_PL, CAMPAIGN_REGION, src.region_map)
    total = lambda kpi: merge_units(F.when(F.col("kpi") == kpi, F.col("units")))
    levels = grouping_levels(
        mapped, DAY_KEYS, ["sub_category"],
        [total("Visits").alias("visits"), total("Transactions Tracked").alias("tracked")],
    )
    visits, tracked = from_units(F.col("visits")), from_units(F.col("tracked"))
    rows = unpivot_metrics(levels, DAY_KEYS + ["sub_category"], {
        "Total Visits": visits,
        "Transactions Tracked": tracked,
        "Conversion Ratio": safe_ratio(tracked, visits),
    })
    return label_levels(rows, category=["Platform", ALL])


def conversion_day(src: Sources, p: RunParams, cfg: MartConfig) -> DataFrame:
    """Both families keep their label on the sub-category rows and are also filed under 'All'."""
    rows = journey_sales(src, p, cfg).unionByName(platform_visits(src, p, cfg))
    return to_mart(rows, DAY, src.calendar, p)


def conversion_budget(src: Sources, p: RunParams) -> DataFrame:
    """Budget per reporting region, from the run's start to the last budgeted week.

    The file has no product line: the United Kingdom is matched with the UK line's mapping
    and every other region with the EU line's.
    """
    plan = src.weekly_budget.withColumn("week_commencing_date", plan_week(F.col("report_week_commencing")))
    last_week = plan.agg(F.max("week_commencing_date")).scalar()
    due = plan.where(F.col("week_commencing_date").between(F.lit(p.start), last_week)).withColumn(
        "product_pl", F.when(F.col("region") == "United Kingdom", "UK").otherwise("EU")
    )
    mapped = region_fanout(due, "product_pl", "region", src.region_map)
    totals = mapped.groupBy("week_commencing_date", "product_pl", "region").agg(
        F.sum(to_units(F.col("gross_sales_budget"))).alias("sales"), F.sum("gross_transactions_budget").alias("orders")
    )
    sales, orders = from_units(F.col("sales")), F.col("orders")
    value = round_half_up(plain_ratio(sales, F.coalesce(orders, F.lit(1))), 5)
    return unpivot_metrics(totals, ["week_commencing_date", "product_pl", "region"], {
        "Avg Trans Value Budget": value,
        "Gross Transactions Budget": orders,
        "Gross Sales Budget": sales,
    }).withColumns({"category": F.lit(ALL), "sub_category": F.lit(ALL)})


def conversion_week(mart: DataFrame, src: Sources, p: RunParams, cfg: MartConfig) -> DataFrame:
    keys = ["week_commencing_date", "product_pl", "region", "category", "sub_category"]
    weekly = roll_to_week(mart, p, ADDITIVE)
    return to_mart(with_ratios(weekly, keys, RATIOS).unionByName(conversion_budget(src, p)), WEEK, src.calendar, p)


def conversion_fytd(mart: DataFrame, src: Sources, p: RunParams, cfg: MartConfig) -> DataFrame:
    """Gross sales budget is summed only to price the average; it is not reported at this scope."""
    running = year_to_date(mart, src, p, cfg, (*ADDITIVE, "Gross Transactions Budget", "Gross Sales Budget"))
    keys = [c for c in running.columns if c not in ("metric_name", "metric_value")]
    reported = F.col("metric_name") != "Gross Sales Budget"
    return to_mart(with_ratios(running, keys, [*RATIOS, PLAN_RATIO]).where(reported), FYTD, src.calendar, p)
