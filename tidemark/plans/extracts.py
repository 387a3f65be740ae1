"""What several marts and checks need of the order lines, read from them once a run."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.money import sum_units
from tidemark.functions.taxonomy import journey_class
from tidemark.operators.bitmaps import BUCKET, dealt, dealt_if_many, dense, member_sets, merged_sets, numbered, set_sizes
from tidemark.operators.calendar import in_run, in_window
from tidemark.operators.customers import customer_flags
from tidemark.operators.region import region_fanout
from tidemark.operators.rollup import distinct_then_count
from tidemark.params import DAY, MartConfig, RunParams
from tidemark.plans.common import LINE_PL, LINE_REGION, is_gross_sale, looked_at, qualifying_lines
from tidemark.sources.catalog import Sources


def order_rows(src: Sources, p: RunParams, cfg: MartConfig) -> DataFrame:
    """One row per day, raw pair, journey class, customer, order and kind of sale over the run and its look-back.

    ``order_id`` is NULL on rows that are no gross sale, ``gbp`` and ``eur`` are net sales in
    units. Distinct orders and customers, by day or class, and the classes' sales follow from
    it without the lines. Stored on first use, which is one scan, and shared by all plans of
    these sources for the run. Grouped by the order of every line: lines that lie together by
    order, as in buckets by it, are not shuffled.
    """

    def build() -> DataFrame:
        kind = journey_class(
            F.col("fare_train_classification_name_longest_duration"), F.col("product_travel_classification_name")
        )
        lines = qualifying_lines(src, cfg).where(looked_at(p, cfg))
        keys = ["year_month_day", LINE_PL, LINE_REGION, "journey_class", "order_customer_id"]
        sums = ["gbp", "eur"]
        orders = lines.groupBy(
            *keys[:3], kind.alias("journey_class"), keys[4], "order_id", F.coalesce(is_gross_sale(), F.lit(False)).alias("_gross")
        ).agg(*[sum_units(F.col(f"m_net_sales_amount_{c}")).alias(c) for c in sums])
        return orders.select(*keys, F.when(F.col("_gross"), F.col("order_id")).alias("order_id"), *sums)

    return src.kept("order-rows", (p.start, p.end, cfg), build)


def order_sets(src: Sources, p: RunParams, cfg: MartConfig) -> DataFrame | None:
    """Gross orders by day and raw pair as sets of one; None where order ids lie too far apart for bits.

    Dealt by bucket before the fan-out multiplies them, so their union shuffles nothing. A row without an
    order has no members: its bucket may be any, and is one of its day's, as all in one would meet in one task.
    """
    orders = order_rows(src, p, cfg)
    if not dense(orders, "order_id"):
        return None
    sets = numbered(orders.select("year_month_day", LINE_PL, LINE_REGION, "order_id"), "order_id").drop("order_id")
    return dealt_if_many(sets.withColumn(BUCKET, F.coalesce(BUCKET, F.unix_date("year_month_day"))), BUCKET)


def distinct_orders(src: Sources, p: RunParams, cfg: MartConfig, *period: str) -> DataFrame:
    """Distinct gross orders of a period per reporting line and region; without any, zero.

    ``period`` are columns of the calendar, or ``year_month_day``. The sets of its days and raw pairs
    are united in one shuffle, whatever the period.
    """
    sets = order_sets(src, p, cfg)
    rows = order_rows(src, p, cfg).select("year_month_day", LINE_PL, LINE_REGION, "order_id").distinct() if sets is None else sets
    if period != ("year_month_day",):
        days = src.calendar.where(F.col("date_scope") == DAY).select("year_month_day", *period)
        rows = rows.join(days, "year_month_day")
    keys = [*period, "product_pl", "region"]
    mapped = region_fanout(rows, LINE_PL, LINE_REGION, src.region_map)
    if sets is None:
        return distinct_then_count(mapped, keys, "order_id", "orders")
    return set_sizes(merged_sets(mapped, keys), keys, orders="members")


#: stands for an account without a person, which counts as one
NO_PERSON = -(2**62)


def purchase_lines(src: Sources, p: RunParams, cfg: MartConfig, first: date, last: date) -> DataFrame:
    """Purchases issued on the days of a window, with who made them and whether they count by day or by week.

    By day: gross sales, both dates in the run. By week: any line on the day it was issued.
    Literal bounds of both dates let the scan skip all other lines.
    """
    day, issued = F.col("year_month_day"), F.col("product_issued_date")
    lines = qualifying_lines(src, cfg).where(in_window(day, first, last) & in_window(issued, first, last))
    daily = in_run(day, p) & in_run(issued, p) & (F.col("product_gross_sales_flag") == "Y")
    return lines.select(
        F.col("order_customer_id").alias("customer_id"), F.coalesce(daily, F.lit(False)).alias("by_day"), (day == issued).alias("by_week"),
        "product_issued_date", F.col(LINE_PL).alias("product_pl"), F.col(LINE_REGION).alias("region"),
    ).where("by_day or by_week")


def customer_sets(src: Sources, p: RunParams, cfg: MartConfig, by_week: bool) -> DataFrame | None:
    """Persons by day of issue, raw pair, newness and what they count for, as stored bitmaps; None where ids lie too far apart.

    The window is the run's whole weeks if they are asked for or the run is a week or longer; daily
    and weekly counts then share one scan.
    """
    accounts = src.customer_accounts.where(
        F.col("managed_group_id").isin(*cfg.managed_groups) & (F.col("segment") == cfg.account_segment)
    )
    if not dense(accounts, "person_id"):
        return None
    whole = by_week or p.end - p.start >= timedelta(days=6)
    first, last = (p.first_week, p.last_week + timedelta(days=6)) if whole else (p.start, p.end)

    def build() -> DataFrame:
        keys = ["product_issued_date", "by_day", "by_week"]
        # one shuffle by customer serves the distinct rows and the join; a purchase of nobody joins no account
        bought = purchase_lines(src, p, cfg, first, last).where(F.col("customer_id").isNotNull())
        flags = customer_flags(dealt(bought, "customer_id"), accounts, *keys)
        persons = flags.withColumn("person_id", F.coalesce("person_id", F.lit(NO_PERSON)))
        return member_sets(persons, [*keys, "product_pl", "region", "is_new"], "person_id")

    return src.kept("customer-sets", (p.start, p.end, first, last, cfg), build)
