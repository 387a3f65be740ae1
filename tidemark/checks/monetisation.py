"""Monetisation mart against order lines, the ad server, hotel feeds and web events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.checks.reconcile import reconcile
from tidemark.functions.money import from_units, sum_units
from tidemark.functions.ratio import currency_pick, plain_ratio
from tidemark.operators.calendar import in_run, outside
from tidemark.operators.region import pair_fanout, raw_region_label
from tidemark.operators.scopes import rows_of
from tidemark.params import DAY, MartConfig, RunParams
from tidemark.plans import monetisation as mon
from tidemark.plans.common import DAY_KEYS, LINE_PL, LINE_REGION, qualifying_lines, round4
from tidemark.sources.catalog import Sources

COVERAGE, TAKE_RATE, REVENUE = "Percent of Tickets", "Take Rate", "Revenue"
FEE_CHECKS = {
    **{f"{mon.fee_key(fee)}_take_rate": (fee, TAKE_RATE) for fee in mon.FEES},
    **{f"{mon.fee_key(fee)}_revenue": (fee, REVENUE) for fee in mon.FEES},
    **{f"{mon.fee_key(fee)}_coverage": (fee, COVERAGE) for fee in mon.TICKET_FEES},
}
ADS_METRICS = ("CPM", "CTR", "Impressions", "Revenue")


def base_pair(pl: Column, region: Column) -> tuple[Column, Column]:
    """Line and region a raw pair is reported under first; unknown pairs count as EU, France."""
    unknown = pl.isNull() & region.isNull()
    return (
        F.when(unknown | (pl == "INT"), "EU").otherwise(pl),
        F.when(unknown, "France").otherwise(raw_region_label(F.when(pl == "INT", "EU").otherwise(pl), region)),
    )


def fee_check(name: str, mart: DataFrame, src: Sources, p: RunParams, cfg: MartConfig) -> DataFrame:
    """Coverage, take rate or revenue of one fee family, recounted at base-region grain."""
    fee, metric = FEE_CHECKS[name]
    column = mon.FEES[fee][0]
    pl, region = base_pair(F.col(LINE_PL), F.col(LINE_REGION))
    lines = qualifying_lines(src, cfg).where(in_run(F.col("year_month_day"), p)).withColumns({"product_pl": pl, "base": region})
    if fee == "Refund Fee" and metric != COVERAGE:
        lines = lines.where(outside(F.col("year_month_day"), cfg.refund_fee_gaps) | (F.col("product_pl") != "EU"))
    tickets = F.col("product_number_of_tickets")
    amount = lambda c: {cur: from_units(sum_units(F.col(f"{c}_{cur}"))) for cur in ("gbp", "eur")}
    fees, sales = amount(column), amount("m_net_sales_amount")
    grouped = lines.groupBy("year_month_day", "product_pl", F.col("base").alias("region"))
    if metric == COVERAGE:
        covered = F.when(F.col(f"{column}_eur") + F.col(f"{column}_gbp") > 0, tickets)
        source = grouped.agg(round4(plain_ratio(F.sum(covered), F.sum(tickets))).alias("source_value"))
    else:
        sums = grouped.agg(
            *[v.alias(f"fee_{k}") for k, v in fees.items()], *[v.alias(f"net_{k}") for k, v in sales.items()]
        )
        paid = currency_pick(F.col("fee_gbp"), F.col("fee_eur"))
        value = plain_ratio(paid, currency_pick(F.col("net_gbp"), F.col("net_eur"))) if metric == TAKE_RATE else paid
        source = sums.select(*DAY_KEYS, round4(value).alias("source_value"))
    stored = rows_of(mart, DAY, [metric]).where(
        (F.col("category") == "Trx") & (F.col("sub_category") == fee) & in_run(F.col("year_month_day"), p)
    ).select(*DAY_KEYS, F.col("metric_value").alias("mart_value"))
    return reconcile(stored, source, DAY_KEYS, 0.001 if metric == REVENUE else 0.0, how="inner")


def ads_check(metric: str, mart: DataFrame, src: Sources, p: RunParams) -> DataFrame:
    """An ads metric of either line against the day's de-duplicated ad-server rows."""
    shown = F.col("impressions")
    paid = F.sum(F.when(~F.lower("event_line_item_name").like("%house%"), shown)).cast("double")
    revenue = F.sum("revenue_micros").cast("double") / F.lit(1e6)
    value = {
        "Revenue": round4(revenue),
        "Impressions": F.sum(shown).cast("double"),
        "CTR": round4(plain_ratio(F.sum("clicks"), F.sum(shown))),
        "CPM": round4(plain_ratio(revenue, paid / F.lit(1000.0))),
    }[metric]
    daily = mon.ad_rows(src, p).groupBy(F.col("event_date").alias("year_month_day")).agg(value.alias("source_value"))
    # the day's value is expected of both lines the mart reports ads under
    source = pair_fanout(daily, "UK", "United Kingdom", src.region_map)
    stored = rows_of(mart, DAY, [metric]).where(F.col("sub_category") == "Ads").select(
        *DAY_KEYS, F.col("metric_value").alias("mart_value")
    )
    return reconcile(stored, source, DAY_KEYS, 0.001 if metric in ("Revenue", "Impressions") else 0.0, how="inner")


def _partner_rows(mart: DataFrame, metric: str) -> DataFrame:
    return rows_of(mart, DAY, [metric]).where(F.col("sub_category") == mon.PARTNER).select(
        *DAY_KEYS, F.col("metric_value").alias("mart_value")
    )


def hotel_bookings_check(mart: DataFrame, src: Sources, p: RunParams, cfg: MartConfig) -> DataFrame:
    source = mon.placed_bookings(src, p, cfg).groupBy(*DAY_KEYS).agg(
        F.countDistinct("booking_id").cast("double").alias("source_value")
    )
    return reconcile(_partner_rows(mart, "No. of Hotel Bookings"), source, DAY_KEYS, how="inner")


def hotel_web_check(metric: str, mart: DataFrame, src: Sources, p: RunParams, cfg: MartConfig) -> DataFrame:
    counts = mon.hotel_web_counts(src, p, cfg)
    value = F.col("shown").cast("double") if metric == "Impressions" else round4(plain_ratio(F.col("clicks"), F.col("shown")))
    source = counts.select(*DAY_KEYS, value.alias("source_value"))
    return reconcile(_partner_rows(mart, metric), source, DAY_KEYS, 0.0001 if metric == "CTR" else 0.0, how="inner")
