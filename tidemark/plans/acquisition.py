"""Acquisition mart: marketing KPIs, payback, margins and customers."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.money import from_units, merge_units, stable_sum, sum_units
from tidemark.functions.ratio import currency_pick, plain_ratio, safe_ratio
from tidemark.functions.taxonomy import (
    channel_category, channel_sub_category, payback_category, payback_sub_category,
)
from tidemark.operators.calendar import in_run
from tidemark.operators.customers import customer_counts, customer_counts_of_sets, customer_flags
from tidemark.operators.gate import to_mart
from tidemark.operators.payback import BANDS, payback_months
from tidemark.operators.pivot import unpivot_metrics
from tidemark.operators.ratios import Ratio, ratio_rows, with_ratios
from tidemark.operators.region import line_owns_region, region_fanout
from tidemark.operators.rollup import grouping_levels, label_levels
from tidemark.operators.scopes import roll_to_week, run_weeks, touched
from tidemark.params import ALL, DAY, FYTD, WEEK, MartConfig, RunParams
from tidemark.plans.common import (
    CAMPAIGN_PL, CAMPAIGN_REGION, DAY_KEYS, LINE_PL, LINE_REGION, both_currencies, qualifying_lines, region_totals,
)
from tidemark.plans.extracts import customer_sets, purchase_lines
from tidemark.plans.ytd import year_to_date
from tidemark.sources.catalog import Sources

# Output column -> KPI of the marketing source.
KPI_COLUMNS = {
    "spend_eur": "Spend EUR", "spend_gbp": "Spend GBP", "clicks": "Clicks", "impressions": "Impressions",
    "installs": "Installs", "visits": "Visits", "inc_new": "Incremental New Customers",
    "inc_sales_eur": "Incremental Gross Sales EUR", "inc_sales_gbp": "Incremental Gross Sales GBP",
    "inc_spend_eur": "Incremental Spend EUR", "lc_new": "Last Click New Customers",
    "lc_trx": "Last Click Total Transactions", "lc_tracked": "Last Click Transactions Tracked",
    "lc_net_gbp": "Last Click Net Sales GBP", "lc_net_eur": "Last Click Net Sales EUR",
    "lc_spend_gbp": "Last Click Marketing Spend GBP", "lc_spend_eur": "Last Click Marketing Spend EUR",
    "lc_gross_gbp": "Last Click Gross Sales GBP", "lc_gross_eur": "Last Click Gross Sales EUR",
}
EXCLUDED_CHANNELS = ("TOC", "Brand")

# Metric names.
CAMPAIGN_METRICS = (
    "Marketing Spend", "Total Clicks", "Total Impressions", "Total Installs", "Total Visits",
    "Incremental New Customers", "Incremental Gross Sales", "Payback Months", "Last Click New Customers",
    "Last Click Total Transactions", "Last Click Transactions Tracked", "Last Click Net Sales",
    "Last Click Marketing Spend", "Last Click Gross Sales",
)
# Metric names.
MARGIN_METRICS = ("Total Revenue", "Total Costs", "Gross Margin", "GM - PMS")
# carried to WEEK so that the ratio they feed can be formed at FYtD
ROAS_INPUTS = ("Incremental Gross Sales EUR", "Incremental Spend EUR")
# Metric names.
CUSTOMER_METRICS = ("New Customers", "Existing Customers", "Active Customers")
WEEK_METRICS = CAMPAIGN_METRICS + MARGIN_METRICS + ROAS_INPUTS
FYTD_METRICS = CAMPAIGN_METRICS + MARGIN_METRICS + CUSTOMER_METRICS

EFFICIENCY = [
    Ratio("Incremental ROAS", "Incremental Gross Sales EUR", "Incremental Spend EUR", missing=0.0, drop_zero=True),
    Ratio("CPA", "Marketing Spend", "Last Click New Customers", missing=0.0, drop_zero=True),
    Ratio("CVR", "Last Click Transactions Tracked", "Total Visits", missing=0.0, drop_zero=True),
    Ratio("LC_CPA", "Last Click Marketing Spend", "Last Click New Customers", missing=0.0, drop_zero=True),
]
COST_PER_CLICK = Ratio("Cost / Click", "Total Costs", "Total Clicks")


def campaign_labels() -> dict[str, Column]:
    kpi, channel = F.col("kpi"), F.col("channel")
    return {
        "category": channel_category(kpi, channel),
        "sub_category": channel_sub_category(
            kpi, channel, F.col("sub_channel"), F.col("channel_source"), F.col("device")
        ),
    }


def campaign_kpis(src: Sources, p: RunParams) -> DataFrame:
    """Labelled KPI totals, still one row per KPI: one sum per fact row rather than nineteen."""
    facts = src.marketing.where(
        in_run(F.col("activity_date"), p)
        & F.col("kpi").isin(*KPI_COLUMNS.values())
        & ~F.col("channel").isin(*EXCLUDED_CHANNELS)
    )
    labels = campaign_labels()
    return facts.groupBy(
        F.col("activity_date").alias("year_month_day"), CAMPAIGN_PL, CAMPAIGN_REGION,
        *[label.alias(name) for name, label in labels.items()], "kpi",
    ).agg(sum_units(F.col("value")).alias("units"))


def acquisition_metrics(src: Sources, p: RunParams, cfg: MartConfig) -> DataFrame:
    mapped = region_fanout(campaign_kpis(src, p), CAMPAIGN_PL, CAMPAIGN_REGION, src.region_map)
    sums = [merge_units(F.when(F.col("kpi") == kpi, F.col("units"))).alias(c) for c, kpi in KPI_COLUMNS.items()]
    levels = grouping_levels(mapped, DAY_KEYS, ["category", "sub_category"], sums, cfg.null_dimension)
    c = {name: from_units(F.col(name)) for name in KPI_COLUMNS}
    pick = lambda m: currency_pick(c[f"{m}_gbp"], c[f"{m}_eur"], total=cfg.total_currency)
    spend, lc_spend = pick("spend"), pick("lc_spend")
    return unpivot_metrics(levels, DAY_KEYS + ["category", "sub_category"], {
        "Marketing Spend": spend,
        "Total Clicks": c["clicks"],
        "Total Impressions": c["impressions"],
        "Total Installs": c["installs"],
        "Total Visits": c["visits"],
        "Incremental New Customers": c["inc_new"],
        "Incremental Gross Sales": pick("inc_sales"),
        "Incremental ROAS": safe_ratio(c["inc_sales_eur"], c["inc_spend_eur"]),
        "Incremental Gross Sales EUR": c["inc_sales_eur"],
        "Incremental Spend EUR": c["inc_spend_eur"],
        "Last Click New Customers": c["lc_new"],
        "Last Click Total Transactions": c["lc_trx"],
        "Last Click Transactions Tracked": c["lc_tracked"],
        "Last Click Net Sales": pick("lc_net"),
        "Last Click Marketing Spend": lc_spend,
        "Last Click Gross Sales": pick("lc_gross"),
        "LC_CPA": safe_ratio(lc_spend, c["lc_new"], None),
        "CPA": safe_ratio(spend, c["lc_new"], None),
        "CVR": safe_ratio(c["lc_tracked"], c["visits"], None),
    }, drop="nonpositive")


def payback_metric(src: Sources, p: RunParams, cfg: MartConfig) -> DataFrame:
    """Payback months per label, added up across the labels and regions of a level."""
    facts = src.payback.where(
        in_run(F.col("activity_date"), p) & ~F.col("original_attribution") & (F.col("multiplier_level") == "Campaign")
    )
    first_margin = F.col("total_first_trx_gm_gbp")
    per_label = facts.groupBy(
        F.col("activity_date").alias("year_month_day"),
        "region",
        payback_category(F.col("channel_0")).alias("category"),
        payback_sub_category(F.col("channel_0"), F.col("channel_1")).alias("sub_category"),
    ).agg(
        F.sum(F.coalesce("new_customer_count", F.lit(0))).alias("new_customers"),
        sum_units(F.coalesce("marketing_spend_gbp", F.lit(0.0))).alias("spend"),
        *[sum_units(first_margin * F.col(multiplier)).alias(multiplier) for multiplier, _ in BANDS],
    )
    customers = F.col("new_customers")
    months = payback_months(
        plain_ratio(from_units(F.col("spend")), customers),
        [plain_ratio(from_units(F.col(multiplier)), customers) for multiplier, _ in BANDS],
        [length for _, length in BANDS],
    )
    priced = per_label.select(
        "year_month_day", "region", "category", "sub_category",
        F.when(F.col("region") == "United Kingdom", "UK").otherwise("EU").alias("product_pl"),
        months.alias("months"),
    )
    mapped = region_fanout(priced, "product_pl", "region", src.region_map)
    levels = grouping_levels(
        mapped, DAY_KEYS, ["category", "sub_category"], [stable_sum(F.col("months")).alias("months")], cfg.null_dimension
    )
    keys = DAY_KEYS + ["category", "sub_category"]
    return unpivot_metrics(levels, keys, {"Payback Months": F.col("months")}, drop="nonpositive")


def margin_totals(src: Sources, p: RunParams, cfg: MartConfig) -> DataFrame:
    lines = qualifying_lines(src, cfg).where(in_run(F.col("year_month_day"), p))
    money = both_currencies({"revenue": "m_revenue_total", "costs": "m_costs_total"})
    for cur in ("gbp", "eur"):
        money[f"margin_{cur}"] = F.col(f"m_revenue_total_{cur}") - F.col(f"m_costs_total_{cur}")
    totals = region_totals(lines, ["year_month_day"], LINE_PL, LINE_REGION, src.region_map, money)
    pick = lambda m: currency_pick(F.col(f"{m}_gbp"), F.col(f"{m}_eur"), region="region", total=cfg.total_currency)
    return totals.select(*DAY_KEYS, *[pick(m).alias(m) for m in ("revenue", "costs", "margin")])


def spend_totals(src: Sources, p: RunParams, cfg: MartConfig) -> DataFrame:
    """Marketing spend of every channel, the excluded ones too, in the customer metrics' currency."""
    facts = src.marketing.where(in_run(F.col("activity_date"), p) & F.col("kpi").isin("Spend EUR", "Spend GBP"))
    money = {f"spend_{cur.lower()}": F.when(F.col("kpi") == f"Spend {cur}", F.col("value")) for cur in ("GBP", "EUR")}
    dated = facts.withColumnRenamed("activity_date", "year_month_day")
    totals = region_totals(dated, ["year_month_day"], CAMPAIGN_PL, CAMPAIGN_REGION, src.region_map, money)
    spend = currency_pick(F.col("spend_gbp"), F.col("spend_eur"), region="region", total=cfg.total_currency)
    return totals.select(*DAY_KEYS, spend.alias("spend"))


def customer_totals(src: Sources, p: RunParams, cfg: MartConfig, period: str) -> DataFrame:
    """Customers per day or week. Daily counts look at gross sales only, weekly ones at all lines
    of the whole weeks touched.

    Both come from stored sets of persons by day and raw pair: a week is the union of its days,
    without another scan of the lines. Person ids that are no whole numbers close to each other
    are reduced to distinct rows instead.
    """
    by_week = period != "year_month_day"
    sets = customer_sets(src, p, cfg, by_week)
    if sets is None:
        first, last = (p.first_week, p.last_week + timedelta(days=6)) if by_week else (p.start, p.end)
        rows = purchase_lines(src, p, cfg, first, last)
    else:
        rows = sets
    if by_week:
        week_days = src.calendar.where((F.col("date_scope") == DAY) & run_weeks(p)).select(
            F.col("year_month_day").alias("product_issued_date"), period
        )
        dated = rows.where("by_week").join(week_days, "product_issued_date")
    else:
        dated = rows.where("by_day").withColumn(period, F.col("product_issued_date"))
    if sets is not None:
        return customer_counts_of_sets(dated, period, src.region_map)
    accounts = src.customer_accounts.where(
        F.col("managed_group_id").isin(*cfg.managed_groups) & (F.col("segment") == cfg.account_segment)
    )
    return customer_counts(customer_flags(dated, accounts, period), period, src.region_map)


def customer_rows(counts: DataFrame, period: str) -> DataFrame:
    """Customer metrics at each level of their one constant label."""
    metrics = unpivot_metrics(counts, [period, "product_pl", "region"], {
        "New Customers": F.col("new_customers"),
        "Existing Customers": F.col("active_customers") - F.col("new_customers"),
        "Active Customers": F.col("active_customers"),
    })
    return label_levels(metrics, category=["TBD", ALL], sub_category=["TBD", ALL])


def customer_metrics_day(src: Sources, p: RunParams, cfg: MartConfig) -> DataFrame:
    margins = margin_totals(src, p, cfg).join(spend_totals(src, p, cfg), DAY_KEYS, "left")
    money = unpivot_metrics(margins, DAY_KEYS, {
        "Total Revenue": F.col("revenue"),
        "Total Costs": F.col("costs"),
        "Gross Margin": F.col("margin"),
        "GM - PMS": F.col("margin") - F.col("spend"),
    }).withColumns({"category": F.lit(ALL), "sub_category": F.lit(ALL)})
    people = customer_rows(customer_totals(src, p, cfg, "year_month_day"), "year_month_day")
    return money.unionByName(people).where(line_owns_region())


def acquisition_day(src: Sources, p: RunParams, cfg: MartConfig) -> DataFrame:
    rows = (
        acquisition_metrics(src, p, cfg)
        .unionByName(payback_metric(src, p, cfg))
        .unionByName(customer_metrics_day(src, p, cfg))
    )
    return to_mart(rows, DAY, src.calendar, p)


def customer_metrics_week(mart: DataFrame, weekly: DataFrame, src: Sources, p: RunParams, cfg: MartConfig) -> DataFrame:
    week = "week_commencing_date"
    # only weeks with stored days count, as for every other weekly metric
    weeks = touched(mart.where(run_weeks(p)), DAY, week, p)
    counts = customer_totals(src, p, cfg, week).join(weeks, week, "left_semi")
    keys = [week, "product_pl", "region", "category", "sub_category"]
    rows = customer_rows(counts, week).unionByName(ratio_rows(weekly, keys, [COST_PER_CLICK]))
    return rows.where(line_owns_region(cfg.weekly_customer_eu_regions))


def acquisition_week(mart: DataFrame, src: Sources, p: RunParams, cfg: MartConfig) -> DataFrame:
    keys = ["week_commencing_date", "product_pl", "region", "category", "sub_category"]
    weekly = roll_to_week(mart, p, WEEK_METRICS)
    rows = with_ratios(weekly, keys, EFFICIENCY).unionByName(customer_metrics_week(mart, weekly, src, p, cfg))
    return to_mart(rows, WEEK, src.calendar, p)


def acquisition_fytd(mart: DataFrame, src: Sources, p: RunParams, cfg: MartConfig) -> DataFrame:
    running = year_to_date(mart, src, p, cfg, (*FYTD_METRICS, *ROAS_INPUTS), calendar_years=True)
    keys = [c for c in running.columns if c not in ("metric_name", "metric_value")]
    reported = ~F.col("metric_name").isin(*ROAS_INPUTS)
    return to_mart(with_ratios(running, keys, [*EFFICIENCY, COST_PER_CLICK]).where(reported), FYTD, src.calendar, p)
