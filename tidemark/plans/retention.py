"""Retention mart: customer lifecycle counts and journey habits."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.money import from_units, merge_units, sum_units
from tidemark.functions.ratio import currency_pick, plain_ratio, round_half_up
from tidemark.operators.calendar import in_run
from tidemark.operators.gate import to_mart
from tidemark.operators.pivot import unpivot_metrics
from tidemark.operators.ratios import Ratio, ratio_rows
from tidemark.operators.region import line_owns_region, region_fanout
from tidemark.operators.rollup import count_each
from tidemark.operators.scopes import lag_previous_present, roll_to_week
from tidemark.params import ALL, DAY, FYTD, WEEK, MartConfig, RunParams
from tidemark.plans.common import DAY_KEYS, LINE_PL, LINE_REGION, round4
from tidemark.plans.extracts import order_rows
from tidemark.plans.ytd import year_to_date
from tidemark.sources.catalog import Sources

# Lifecycle stage -> column prefix of the summary; (category, stage) -> metric name; rates and
# journey metrics with their categories.
STAGES = {"Early Life": "el", "Retained": "ret", "Resurrected": "res"}
GROWTH_NAMES = {
    ("Volume", "Early Life"): "28d Early life Person Count",
    ("Volume", "Retained"): "28d Retained Person Count",
    ("Volume", "Resurrected"): "28d Resurrected Person Count",
    ("Volume", "Active"): "28d Active Customers",
    ("Net Sales Amount", "Early Life"): "28d Early life Person NTS Amount",
    ("Net Sales Amount", "Retained"): "28d Retained Person NTS Amount",
    ("Net Sales Amount", "Resurrected"): "28d Resurrected Person NTS Amount",
    ("Net Sales Amount", "Active"): "28d Active Person NTS Amount",
    ("Retention", "Early Life"): "28d Early life Person moved to Retained",
    ("Retention", "Retained"): "28d Retained Person moved to Retained",
    ("Retention", "Resurrected"): "28d Resurrected Person moved to Retained",
    ("Churn", "Early Life"): "28d Early life Person moved to Churned",
    ("Churn", "Retained"): "28d Retained Person moved to Churned",
    ("Churn", "Resurrected"): "28d Resurrected Person moved to Churned",
    ("Churn", "Active"): "28d Person moved Active to Inactive",
}
RATE_NAMES = {
    ("Retention %", "Early Life"): "EL moved to Retained over Previous New",
    ("Retention %", "Retained"): "Retained moved to Retained over Previous Retained",
    ("Retention %", "Resurrected"): "Resurrected moved to Retained over Previous Resurrected",
    ("Churn %", "Early Life"): "EL moved to Churn over Previous New",
    ("Churn %", "Retained"): "Retained moved to Churn over Previous Retained",
    ("Churn %", "Resurrected"): "Resurrected moved to Churn over Previous Resurrected",
    ("Churn %", "Active"): "28d Active to Inactive over Previous active",
    ("Proportion %", "Early Life"): "Current EL over Current EL + Current Retained",
    ("Proportion %", "Resurrected"): "Current Resurrected over current Retained + current Resurrected",
}
JOURNEY_ADDITIVE = ("Number of Customers", "Net Sales Amount", "Total number of Orders")
JOURNEY_CATEGORY = {
    "Number of Customers": "Volume", "Total number of Orders": "Volume Orders", "Net Sales Amount": "Sales",
    "Transactions per Customer": "Frequency",
}
PER_CUSTOMER = [Ratio("Transactions per Customer", "Total number of Orders", "Number of Customers")]


def growth_metrics(src: Sources, p: RunParams, cfg: MartConfig, scope: str) -> DataFrame:
    """Fifteen lifecycle sums per period and region, one period of look-back included.

    The weekly summary is labelled by Mondays and reports the day before. Currency follows
    the summary's own line, ahead of the region mapping.
    """
    back = {DAY: 1, WEEK: 7}[scope]
    first, last = p.start - timedelta(days=back - 1), p.end + timedelta(days=1)
    rows = src.growth_summary.where(
        (F.col("date_scope") == scope) & F.col("year_month_day").between(F.lit(first), F.lit(last))
    )
    amounts = {k: currency_pick(F.col(f"{k}_nts_gbp"), F.col(f"{k}_nts_eur")) for k in STAGES.values()}
    active_amount = amounts["el"] + amounts["ret"] + amounts["res"]
    counted = [f"{k}_{what}" for k in STAGES.values() for what in ("volume", "retention", "churned")]
    raw = rows.groupBy("year_month_day", "product_pl", "region").agg(
        *[F.sum(c).alias(c) for c in counted],
        *[sum_units(v).alias(f"{k}_amount") for k, v in amounts.items()],
        sum_units(active_amount).alias("active_amount"),
    )
    money = [f"{k}_amount" for k in (*STAGES.values(), "active")]
    totals = region_fanout(raw, "product_pl", "region", src.region_map).groupBy(*DAY_KEYS).agg(
        *[F.sum(c).alias(c) for c in counted], *[merge_units(F.col(c)).alias(c) for c in money]
    )
    total = lambda what: F.col(f"el_{what}") + F.col(f"ret_{what}") + F.col(f"res_{what}")
    value: dict[tuple[str, str], Column] = {}
    for stage, k in STAGES.items():
        value["Volume", stage] = F.col(f"{k}_volume")
        value["Net Sales Amount", stage] = round4(from_units(F.col(f"{k}_amount")))
        value["Retention", stage] = F.col(f"{k}_retention")
        value["Churn", stage] = F.col(f"{k}_churned")
    value["Volume", "Active"] = total("volume")
    value["Net Sales Amount", "Active"] = round4(from_units(F.col("active_amount")))
    value["Churn", "Active"] = total("churned")
    metrics = [
        ({"category": c, "sub_category": s, "metric_name": name}, value[c, s]) for (c, s), name in GROWTH_NAMES.items()
    ]
    out = unpivot_metrics(totals, DAY_KEYS, metrics)
    return out.withColumn("year_month_day", F.date_sub("year_month_day", 1)) if scope == WEEK else out


def lifecycle_rates(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Retention, churn and proportion rates from one pivot of the lifecycle rows.

    ``rows`` carry ``previous``, the series' previous present value.
    """
    at = lambda c, s, column: F.max(F.when((F.col("category") == c) & (F.col("sub_category") == s), F.col(column)))
    stages = (*STAGES, "Active")
    wide = rows.groupBy(*keys).agg(
        *[at("Volume", s, "metric_value").alias(f"volume_{i}") for i, s in enumerate(stages)],
        *[at("Volume", s, "previous").alias(f"previous_{i}") for i, s in enumerate(stages)],
        *[at("Retention", s, "metric_value").alias(f"kept_{i}") for i, s in enumerate(stages)],
        *[at("Churn", s, "metric_value").alias(f"lost_{i}") for i, s in enumerate(stages)],
    )
    n = {s: i for i, s in enumerate(stages)}
    retained = F.col(f"volume_{n['Retained']}")
    value: dict[tuple[str, str], Column] = {}
    for s in stages:
        value["Retention %", s] = plain_ratio(F.col(f"kept_{n[s]}"), F.col(f"previous_{n[s]}"))
        value["Churn %", s] = plain_ratio(F.col(f"lost_{n[s]}"), F.col(f"previous_{n[s]}"))
        value["Proportion %", s] = plain_ratio(F.col(f"volume_{n[s]}"), retained + F.col(f"volume_{n[s]}"))
    metrics = [
        ({"category": c, "sub_category": s, "metric_name": name}, value[c, s]) for (c, s), name in RATE_NAMES.items()
    ]
    return unpivot_metrics(wide, keys, metrics)


def lifecycle_rows(src: Sources, p: RunParams, cfg: MartConfig, scope: str) -> DataFrame:
    growth = growth_metrics(src, p, cfg, scope)
    calendar = src.calendar.where(F.col("date_scope") == scope).select("year_month_day", "week_commencing_date")
    known = growth.join(calendar, "year_month_day")
    series = ["product_pl", "region", "category", "sub_category"]
    lagged = lag_previous_present(known, series, "year_month_day", "metric_value", "previous").where(
        in_run(F.col("year_month_day"), p)
    )
    keys = [*DAY_KEYS, "week_commencing_date"]
    return lagged.drop("previous").unionByName(lifecycle_rates(lagged, keys))


def journey_totals(src: Sources, p: RunParams, cfg: MartConfig) -> DataFrame:
    """Customers, orders and net sales per journey class, day and region.

    From the run's stored order rows: one row per customer and order, with no scan of lines.
    """
    kind = F.col("journey_class")
    orders = order_rows(src, p, cfg).where(kind.isNotNull()).withColumnRenamed("journey_class", "sub_category")
    mapped = region_fanout(orders, LINE_PL, LINE_REGION, src.region_map).where(
        line_owns_region(cfg.eu_regions, with_total=False)
    )
    money = [merge_units(F.col(c)).alias(c) for c in ("gbp", "eur")]
    counted = count_each(mapped, [*DAY_KEYS, "sub_category"], {"customers": "order_customer_id", "orders": "order_id"}, money)
    return counted.select(
        *DAY_KEYS, "sub_category", "customers", "orders",
        currency_pick(from_units(F.col("gbp")), from_units(F.col("eur"))).alias("sales"),
    )


def journey_metrics(src: Sources, p: RunParams, cfg: MartConfig) -> DataFrame:
    """Per class, and 'All' as the sum of the classes: a customer of both counts twice there."""
    # each class row goes to its own class and to 'All', then one aggregate serves both
    both = journey_totals(src, p, cfg).withColumn(
        "sub_category", F.explode(F.array(F.col("sub_category"), F.lit(ALL)))
    )
    totals = both.groupBy(*DAY_KEYS, "sub_category").agg(
        F.sum("customers").alias("customers"), F.sum("orders").alias("orders"),
        F.sum(F.col("sales").cast("decimal(28,8)")).cast("double").alias("sales"),
    )
    rows = unpivot_metrics(totals, [*DAY_KEYS, "sub_category"], [
        ({"_category": JOURNEY_CATEGORY[name], "metric_name": name}, value)
        for name, value in {
            "Number of Customers": F.col("customers"),
            "Total number of Orders": F.col("orders"),
            "Net Sales Amount": round4(F.col("sales")),
            # a two-decimal quotient, as the daily mart stores it
            "Transactions per Customer": round_half_up(plain_ratio(F.col("orders"), F.col("customers")), 2),
        }.items()
    ])
    category = F.when(F.col("sub_category") == ALL, ALL).otherwise(F.col("_category"))
    return rows.withColumn("category", category).drop("_category")


def retention_day(src: Sources, p: RunParams, cfg: MartConfig) -> DataFrame:
    rows = lifecycle_rows(src, p, cfg, DAY).drop("week_commencing_date").unionByName(journey_metrics(src, p, cfg))
    return to_mart(rows, DAY, src.calendar, p)


def frequency_rows(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Orders per customer of each class; the two counts sit in different categories."""
    return ratio_rows(rows, keys, PER_CUSTOMER).withColumn("category", F.lit("Frequency"))


def retention_week(mart: DataFrame, src: Sources, p: RunParams, cfg: MartConfig) -> DataFrame:
    weeks = src.calendar.where((F.col("date_scope") == DAY) & in_run(F.col("year_month_day"), p)).select(
        "week_commencing_date"
    ).distinct()
    journeys = roll_to_week(mart, p, JOURNEY_ADDITIVE, weeks)
    frequency = frequency_rows(journeys, ["week_commencing_date", "product_pl", "region", "sub_category"])
    lifecycle = lifecycle_rows(src, p, cfg, WEEK).drop("year_month_day")
    return to_mart(lifecycle.unionByName(journeys).unionByName(frequency), WEEK, src.calendar, p)


def retention_fytd(mart: DataFrame, src: Sources, p: RunParams, cfg: MartConfig) -> DataFrame:
    running = year_to_date(mart, src, p, cfg, (*GROWTH_NAMES.values(), *JOURNEY_ADDITIVE))
    keys = ["financial_year", "week_number", "week_commencing_date", "product_pl", "region", "sub_category"]
    return to_mart(running.unionByName(frequency_rows(running, keys)), FYTD, src.calendar, p)
