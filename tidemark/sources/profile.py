"""Row counts and exact totals of a source table per group: what arrived, at a glance."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.money import from_units, sum_units


@dataclass(frozen=True)
class Profile:
    by: tuple[str, ...]
    amounts: tuple[str, ...] = ()
    counts: tuple[str, ...] = ()


PROFILES = {
    "order_lines": Profile(
        ("year_month_day", "product_pl_code", "order_region_name", "source_system", "record_type"),
        ("m_gross_sales_amount_gbp", "m_net_sales_amount_eur", "m_revenue_total_gbp", "m_costs_total_gbp"),
        ("product_number_of_tickets",),
    ),
    "marketing": Profile(("activity_date", "kpi", "channel", "pnl_segment", "region"), ("value",)),
    "customer_accounts": Profile(("managed_group_id", "segment", "person_first_eu_transaction_order_region")),
    "journey_searches": Profile(
        ("year_month_day", "search_odpair_country_name", "search_result_transport_mode"),
        counts=("m_search_result_journey_count", "m_search_result_unsellable_journey_count"),
    ),
    "growth_summary": Profile(
        ("date_scope", "year_month_day", "product_pl"), ("el_nts_gbp", "ret_nts_eur", "res_nts_gbp"),
        ("el_volume", "ret_retention", "res_churned"),
    ),
    "weekly_budget": Profile(("report_week_commencing",), ("gross_sales_budget",), ("gross_transactions_budget",)),
    "monthly_budget": Profile(("version", "year_month"), ("gross_sales_budget", "total_costs_budget"), ("gross_transactions_budget",)),
    "ad_report": Profile(("event_date", "event_advertiser_name", "event_line_item_name"), counts=("revenue_micros", "impressions", "clicks")),
    "hotel_feed": Profile(("event_accommodation_details_location_country", "event_currency_booker"), ("event_commission_actual_amount_orders",)),
    "hotel_manual": Profile(("booking_date", "booker_country"), ("your_commission_in_your_currency",)),
    "web_events": Profile(("event_date", "event_params_kv_event_action", "event_params_kv_event_category", "geo_country")),
    "payback": Profile(
        ("activity_date", "region", "channel_0", "multiplier_level"), ("marketing_spend_gbp", "total_first_trx_gm_gbp"),
        ("new_customer_count",),
    ),
}


def profile(table: DataFrame, spec: Profile) -> DataFrame:
    return table.groupBy(*spec.by).agg(
        F.count("*").alias("records"),
        *[from_units(sum_units(F.col(c))).alias(f"total_{c}") for c in spec.amounts],
        *[F.sum(c).alias(f"total_{c}") for c in spec.counts],
    )
