"""Monetisation mart: revenue, transaction fees, ads and the hotel partnership."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.money import stable_sum
from tidemark.functions.ratio import currency_pick, plain_ratio, safe_ratio
from tidemark.functions.taxonomy import COUNTRY_CODE_REPAIRS, COUNTRY_NAME_REPAIRS, repaired
from tidemark.operators.bitmaps import dealt_if_many
from tidemark.operators.calendar import in_run, outside
from tidemark.operators.dedup import latest_per_key
from tidemark.operators.fx import fx_interval_join
from tidemark.operators.gate import to_mart
from tidemark.operators.pivot import unpivot_metrics
from tidemark.operators.ratios import Ratio, with_ratios
from tidemark.operators.region import pair_fanout, region_fanout
from tidemark.operators.rollup import distinct_then_count
from tidemark.operators.scopes import roll_to_week_by_year
from tidemark.params import ALL, DAY, FYTD, WEEK, MartConfig, RunParams
from tidemark.plans.common import (
    CAMPAIGN_PL, CAMPAIGN_REGION, DAY_KEYS, LINE_PL, LINE_REGION, both_currencies, looked_at, qualifying_lines,
    region_totals, round4,
)
from tidemark.plans.extracts import distinct_orders
from tidemark.plans.ytd import year_to_date
from tidemark.sources.catalog import Sources

# Summed metrics, the partner's label, ratios with their names, the ad server's key.
ADDITIVE = (
    "Total Revenue", "Fee Revenue", "Non-Fee Revenue", "Gross Transactions", "Total Visits", "Revenue", "Net Sale",
    "Impressions", "Monetised Impressions", "Clicks", "No. of Hotel Bookings", "Number of Tickets",
    "Total Number of Tickets",
)
PARTNER = "Partnerships-booking.com"

# Fee family -> amount column of the source, and whether its tickets are counted.
FEES = {
    "Booking Fee": ("m_revenue_booking_fee", True),
    "Refund Fee": ("m_revenue_refund_admin_fee", True),
    "COJ Fee": ("m_revenue_coj_admin_fee", True),
    "Commission": ("m_revenue_product_commission_amount", False),
    "Ancillary": ("m_revenue_insurance_commission_amount", False),
    "MCP": ("m_revenue_fx_margin", True),
}
TICKET_FEES = tuple(fee for fee, (_, tickets) in FEES.items() if tickets)

RATIOS = [
    Ratio("CTR", "Clicks", "Impressions", num_sub=PARTNER),
    Ratio("CTR", "Clicks", "Impressions", num_sub="Ads"),
    Ratio("CPM", "Revenue", "Monetised Impressions", num_sub="Ads", den_scale=1000.0),
    *[
        Ratio("Percent of Tickets", "Number of Tickets", "Total Number of Tickets", num_sub=fee, den_sub="Transaction")
        for fee in TICKET_FEES
    ],
    *[Ratio("Take Rate", "Revenue", "Net Sale", num_sub=fee, den_sub="Transaction") for fee in FEES],
    Ratio("Fee Revenue / Transaction", "Fee Revenue", "Gross Transactions", num_sub=ALL),
    Ratio("Non-Fee Revenue / Visit", "Non-Fee Revenue", "Total Visits", num_sub=ALL),
]
AD_KEY = [
    "event_order_id", "event_programmatic_channel_name", "event_advertiser_name", "event_creative_id", "event_date",
    "event_ad_unit_name", "event_device_category_name", "event_ad_unit_id", "event_mobile_app_name",
    "event_line_item_id", "event_order_name", "event_advertiser_id", "event_device_category_id",
    "event_mobile_inventory_type", "event_country_criteria_id", "event_country_name", "event_line_item_type",
]


def _filed(df: DataFrame, category: str, sub_category: str) -> DataFrame:
    return df.withColumns({"category": F.lit(category), "sub_category": F.lit(sub_category)})


# --- order lines -----------------------------------------------------------------------------

def fee_key(fee: str) -> str:
    return fee.lower().replace(" ", "_")


def line_extract(src: Sources, p: RunParams, cfg: MartConfig) -> DataFrame:
    """Money, ticket and order totals per day and region over the run and its look-back."""
    lines = qualifying_lines(src, cfg).where(looked_at(p, cfg))
    money = both_currencies({
        "total": "m_revenue_total", "fees": "m_revenue_total_fees", "net_sales": "m_net_sales_amount",
        **{fee_key(fee): column for fee, (column, _) in FEES.items()},
    })
    for cur in ("gbp", "eur"):
        money[f"non_fee_{cur}"] = F.col(f"m_revenue_total_{cur}") - F.col(f"m_revenue_total_fees_{cur}")
    tickets = F.col("product_number_of_tickets")
    counts = {"tickets": tickets}
    for fee in TICKET_FEES:
        column = FEES[fee][0]
        counts[f"{fee_key(fee)}_tickets"] = F.when(F.col(f"{column}_eur") + F.col(f"{column}_gbp") > 0, tickets)
    return region_totals(lines, ["year_month_day"], LINE_PL, LINE_REGION, src.region_map, money, counts)


def order_counts(src: Sources, p: RunParams, cfg: MartConfig) -> DataFrame:
    """Distinct gross orders per day and region, from the run's stored sets.

    Days and regions with lines but no gross sale count zero orders.
    """
    return distinct_orders(src, p, cfg, "year_month_day")


def picked(name: str, cfg: MartConfig, region: str | None = None) -> Column:
    return currency_pick(F.col(f"{name}_gbp"), F.col(f"{name}_eur"), region=region, total=cfg.total_currency)


Pairs = list[tuple[dict[str, str], Column]]


def _labels(category: str, sub_category: str, name: str) -> dict[str, str]:
    return {"category": category, "sub_category": sub_category, "metric_name": name}


def revenue_pairs(cfg: MartConfig) -> Pairs:
    orders, fees = F.col("orders"), picked("fees", cfg)
    return [
        (_labels(ALL, ALL, "Total Revenue"), round4(picked("total", cfg))),
        (_labels(ALL, ALL, "Fee Revenue"), round4(fees)),
        (_labels(ALL, ALL, "Non-Fee Revenue"), round4(picked("non_fee", cfg))),
        (_labels(ALL, ALL, "Gross Transactions"), orders),
        (_labels(ALL, ALL, "Fee Revenue / Transaction"), round4(plain_ratio(fees, orders))),
    ]


def per_visit_pairs(cfg: MartConfig) -> Pairs:
    """Revenue and visits are both totalled before they meet, so no amount repeats per visit row."""
    visits = F.col("visits")
    value = F.when(visits.isNotNull(), safe_ratio(picked("non_fee", cfg, "region"), visits))
    return [(_labels(ALL, ALL, "Non-Fee Revenue / Visit"), value)]


def transaction_pairs(cfg: MartConfig) -> Pairs:
    """Tickets, coverage, take rate and revenue of every fee family."""
    sales, tickets = picked("net_sales", cfg), F.col("tickets")
    in_gap = (F.col("product_pl") == "EU") & ~outside(F.col("year_month_day"), cfg.refund_fee_gaps)

    def known(fee: str, value: Column) -> Column:
        return F.when(~in_gap, value) if fee == "Refund Fee" else value

    pairs: Pairs = []
    for fee in FEES:
        amount = picked(fee_key(fee), cfg)
        if fee in TICKET_FEES:
            covered = F.col(f"{fee_key(fee)}_tickets")
            pairs.append((_labels("Trx", fee, "Number of Tickets"), covered))
            pairs.append((_labels("Trx", fee, "Percent of Tickets"), round4(plain_ratio(covered, tickets))))
        pairs.append((_labels("Trx", fee, "Take Rate"), known(fee, round4(plain_ratio(amount, sales)))))
        pairs.append((_labels("Trx", fee, "Revenue"), known(fee, round4(amount))))
    pairs.append((_labels("Trx", "Transaction", "Total Number of Tickets"), tickets))
    pairs.append((_labels("Trx", "Transaction", "Net Sale"), round4(sales)))
    return pairs


def revenue_metrics(src: Sources, p: RunParams, cfg: MartConfig) -> DataFrame:
    joined = line_extract(src, p, cfg).join(order_counts(src, p, cfg), DAY_KEYS)
    return unpivot_metrics(joined, DAY_KEYS, revenue_pairs(cfg))


def transaction_metrics(src: Sources, p: RunParams, cfg: MartConfig) -> DataFrame:
    return unpivot_metrics(line_extract(src, p, cfg), DAY_KEYS, transaction_pairs(cfg))


def visit_totals(src: Sources, p: RunParams) -> DataFrame:
    facts = src.marketing.where(in_run(F.col("activity_date"), p) & (F.col("kpi") == "Visits"))
    dated = facts.withColumnRenamed("activity_date", "year_month_day")
    return region_totals(
        dated, ["year_month_day"], CAMPAIGN_PL, CAMPAIGN_REGION, src.region_map, {"visits": F.col("value")}
    )


def total_visits(src: Sources, p: RunParams, cfg: MartConfig) -> DataFrame:
    return _filed(unpivot_metrics(visit_totals(src, p), DAY_KEYS, {"Total Visits": F.col("visits")}), ALL, ALL)


def non_fee_revenue_per_visit(src: Sources, p: RunParams, cfg: MartConfig) -> DataFrame:
    joined = line_extract(src, p, cfg).join(visit_totals(src, p), DAY_KEYS)
    return unpivot_metrics(joined, DAY_KEYS, per_visit_pairs(cfg))


def line_metrics(src: Sources, p: RunParams, cfg: MartConfig) -> DataFrame:
    """The three families over order lines together: one extract, unpivoted once."""
    joined = (
        line_extract(src, p, cfg)
        .join(order_counts(src, p, cfg), DAY_KEYS)
        .join(visit_totals(src, p), DAY_KEYS, "left")
    )
    return unpivot_metrics(joined, DAY_KEYS, [*revenue_pairs(cfg), *per_visit_pairs(cfg), *transaction_pairs(cfg)])


# --- ad server -------------------------------------------------------------------------------

def ad_rows(src: Sources, p: RunParams) -> DataFrame:
    """Latest version of every ad-server row, over the run and the day before it."""
    billable = src.ad_report.where(
        in_run(F.col("event_date"), p, 1) & (F.lower("event_advertiser_name") != "intowownonbillable")
    )
    return latest_per_key(billable, AD_KEY, ["header_eventtime"])


def ads_metrics(src: Sources, p: RunParams, cfg: MartConfig) -> DataFrame:
    shown = F.col("impressions")
    paid = F.when(~F.lower("event_line_item_name").like("%house%"), shown)
    daily = ad_rows(src, p).groupBy(F.col("event_date").alias("year_month_day")).agg(
        F.sum("revenue_micros").alias("micros"), F.sum(shown).alias("shown"), F.sum(paid).alias("paid"),
        F.sum("clicks").alias("clicks"),
    )
    # the ad server only serves the UK line
    mapped = pair_fanout(daily, "UK", "United Kingdom", src.region_map)
    revenue = F.col("micros").cast("double") / F.lit(1_000_000.0)
    return _filed(unpivot_metrics(mapped, DAY_KEYS, {
        "Revenue": round4(revenue),
        "Impressions": F.col("shown"),
        "Monetised Impressions": F.col("paid"),
        "Clicks": F.col("clicks"),
        "CTR": round4(plain_ratio(F.col("clicks"), F.col("shown"))),
        "CPM": round4(plain_ratio(revenue, F.col("paid").cast("double") / F.lit(1000.0))),
    }), "Non Trx", "Ads")


# --- hotel partnership -----------------------------------------------------------------------

def _place_feed(feed: DataFrame, src: Sources) -> DataFrame:
    code = repaired(F.upper("event_accommodation_details_location_country"), COUNTRY_CODE_REPAIRS)
    places = src.countries.select("country_code", "product_pl", "region").distinct()
    return feed.join(places, code == F.col("country_code"), "left").drop("country_code")


def _place_manual(manual: DataFrame, src: Sources) -> DataFrame:
    name = repaired(F.lower("booker_country"), COUNTRY_NAME_REPAIRS)
    codes = src.country_names.select(F.lower("country_lookup_value").alias("_name"), "country_code")
    places = src.countries.select("country_code", "product_pl", "region")
    return manual.join(codes, name == F.col("_name"), "left").join(places, "country_code", "left").drop("_name", "country_code")


def hotel_feed(src: Sources, p: RunParams, cfg: MartConfig) -> DataFrame:
    """The booking feed, which replaces the manual file from the cut-over on."""
    feed = src.hotel_feed.where(F.col("event_created") >= F.lit(cfg.hotel_feed_cutover).cast("timestamp"))
    return feed if p.end >= cfg.hotel_feed_cutover else feed.where(F.lit(False))


def hotel_manual(src: Sources, p: RunParams, cfg: MartConfig) -> DataFrame:
    manual = src.hotel_manual.where(F.col("booking_date") < F.lit(cfg.hotel_feed_cutover))
    return manual if p.start < cfg.hotel_feed_cutover else manual.where(F.lit(False))


def _remap(rows: DataFrame, src: Sources) -> DataFrame:
    """Second aggregate after the region mapping; rows without a country stay out."""
    keys = DAY_KEYS + ["category", "sub_category", "metric_name"]
    mapped = region_fanout(rows.dropna(subset=DAY_KEYS), "product_pl", "region", src.region_map, null_keys=False)
    return mapped.groupBy(*keys).agg(stable_sum(F.col("metric_value")).alias("metric_value"))


def placed_bookings(src: Sources, p: RunParams, cfg: MartConfig) -> DataFrame:
    """Each booking's latest version, feed and manual file together, with its country's region."""
    feed = hotel_feed(src, p, cfg).select(
        F.col("event_booking_orders_id").cast("string").alias("booking_id"), "event_created", "event_id",
        "event_accommodation_details_location_country",
    )
    manual = hotel_manual(src, p, cfg).select(
        F.col("booking_number").cast("string").alias("booking_id"), "event_time", "booking_date", "booker_country"
    )
    latest_feed = latest_per_key(feed, ["booking_id"], ["event_created", "event_id"])
    latest_manual = latest_per_key(manual, ["booking_id"], ["event_time"])
    return (
        _place_feed(latest_feed, src)
        .select(F.to_date("event_created").alias("year_month_day"), "product_pl", "region", "booking_id")
        .unionByName(
            _place_manual(latest_manual, src)
            .select(F.col("booking_date").alias("year_month_day"), "product_pl", "region", "booking_id")
        )
    )


def hotel_bookings(src: Sources, p: RunParams, cfg: MartConfig) -> DataFrame:
    """Distinct bookings per day and region; a booking counts on the day of its latest version."""
    counts = distinct_then_count(placed_bookings(src, p, cfg), DAY_KEYS, "booking_id", "bookings")
    rows = unpivot_metrics(counts, DAY_KEYS, {"No. of Hotel Bookings": F.col("bookings")})
    return _remap(_filed(rows, "Non Trx", PARTNER), src)


def hotel_commissions(src: Sources, p: RunParams, cfg: MartConfig) -> DataFrame:
    """Commission in sterling per booking: actual, else estimated, at the rate of its creation time."""
    feed = latest_per_key(
        hotel_feed(src, p, cfg).select(
            "event_id", "event_time", "event_created", "event_booking_orders_id", "event_currency_booker",
            "event_accommodation_details_location_country",
            "event_commission_actual_amount_orders", "event_commission_estimated_amount_booker_currency",
        ),
        ["event_id"], ["event_time"],
    )
    amount = F.coalesce(
        "event_commission_actual_amount_orders", "event_commission_estimated_amount_booker_currency", F.lit(0.0)
    )
    priced = _place_feed(fx_interval_join(feed, src.fx_rates, "event_currency_booker", "event_created"), src)
    from_feed = priced.select(
        F.to_date("event_created").alias("year_month_day"), "product_pl", "region",
        F.col("event_booking_orders_id").cast("string").alias("booking_id"),
        F.round(F.coalesce("rate_gbp", F.lit(1.0)) * amount, 10).alias("commission"),
    )
    manual = latest_per_key(
        hotel_manual(src, p, cfg).select(
            F.col("booking_number").cast("string").alias("booking_id"), "event_time", "booking_date", "booker_country",
            F.col("your_commission_in_your_currency").alias("commission"),
        ),
        ["booking_id"], ["event_time"],
    )
    from_manual = _place_manual(manual, src).select(
        F.col("booking_date").alias("year_month_day"), "product_pl", "region", "booking_id", "commission"
    )
    # two feed events of one booking with the same day and amount are one commission
    return from_feed.unionByName(from_manual).distinct()


def hotel_revenue(src: Sources, p: RunParams, cfg: MartConfig) -> DataFrame:
    totals = hotel_commissions(src, p, cfg).groupBy(*DAY_KEYS).agg(
        stable_sum(F.col("commission"), 10).alias("revenue")
    )
    return _remap(_filed(unpivot_metrics(totals, DAY_KEYS, {"Revenue": F.col("revenue")}), "Non Trx", PARTNER), src)


def hotel_web_counts(src: Sources, p: RunParams, cfg: MartConfig) -> DataFrame:
    """Distinct partner impressions and clicks per day and country's region."""
    action = F.col("event_params_kv_event_action")
    events = src.web_events.where(
        in_run(F.col("event_date"), p, 1)
        & (F.col("event_params_kv_event_category") == "partnership")
        & action.isin("product impression", "product selected")
        & (F.col("event_params_kv_event_label") == "accommodation")
        & outside(F.col("event_date"), cfg.web_outages)
    )
    places = src.countries.select(F.lower("country_name").alias("geo"), "product_pl", "region")
    # one row per event, action and region: the counts that follow are then plain counts
    once = dealt_if_many(events, "event_id", "event_date").join(places, F.lower("geo_country") == F.col("geo"), "left").select(
        F.col("event_date").alias("year_month_day"), "product_pl", "region", action.alias("action"), "event_id"
    ).distinct()
    count_of = lambda name: F.count(F.when(F.col("action") == name, F.col("event_id")))
    return once.groupBy(*DAY_KEYS).agg(
        count_of("product impression").alias("shown"), count_of("product selected").alias("clicks")
    )


def hotel_web_metrics(src: Sources, p: RunParams, cfg: MartConfig) -> DataFrame:
    rows = unpivot_metrics(hotel_web_counts(src, p, cfg), DAY_KEYS, {
        "Impressions": F.col("shown"),
        "Clicks": F.col("clicks"),
        "CTR": round4(plain_ratio(F.col("clicks"), F.col("shown"))),
    })
    return _remap(_filed(rows, "Non Trx", PARTNER), src)


# --- the mart --------------------------------------------------------------------------------

FAMILIES = (line_metrics, total_visits, ads_metrics, hotel_bookings, hotel_revenue, hotel_web_metrics)


def monetisation_metrics(src: Sources, p: RunParams, cfg: MartConfig) -> DataFrame:
    return reduce(DataFrame.unionByName, [family(src, p, cfg) for family in FAMILIES])


def monetisation_day(src: Sources, p: RunParams, cfg: MartConfig) -> DataFrame:
    return to_mart(monetisation_metrics(src, p, cfg), DAY, src.calendar, p)


def monetisation_week(mart: DataFrame, src: Sources, p: RunParams, cfg: MartConfig) -> DataFrame:
    weekly = roll_to_week_by_year(mart, src.calendar, p, ADDITIVE)
    keys = ["week_commencing_date", "product_pl", "region", "category"]
    return to_mart(with_ratios(weekly, keys, RATIOS), WEEK, src.calendar, p)


def monetisation_fytd(mart: DataFrame, src: Sources, p: RunParams, cfg: MartConfig) -> DataFrame:
    running = year_to_date(mart, src, p, cfg, ADDITIVE)
    keys = ["financial_year", "week_number", "week_commencing_date", "product_pl", "region", "category"]
    return to_mart(with_ratios(running, keys, RATIOS), FYTD, src.calendar, p)
