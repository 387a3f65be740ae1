"""Source tables derived from the TPC-H-like test data (see FIXTURES.md).

One SQL text per table, in the dialect Spark and DuckDB share, so both sides of every
comparison start from the same rows. ``{name}`` stands for a test table.
"""

from __future__ import annotations

import re
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.bitmaps import tasks_for
from tidemark.params import MartConfig, RunParams
from tidemark.sources import lookups
from tidemark.sources.catalog import Sources

TABLES = ("nation", "customer", "orders", "lineitem", "events")

CALENDAR_FIRST, CALENDAR_LAST = date(1995, 1, 1), date(2025, 12, 31)
# orders run 1995 to 2001 and events through January 2024; the whole of both is one run
RUN = RunParams(date(1995, 1, 1), date(2024, 12, 31), as_of=date(2001, 8, 1))
CONFIG = MartConfig(
    hotel_feed_cutover=date(2024, 1, 16),
    web_outages=((date(2024, 1, 10), date(2024, 1, 12)),),
    refund_fee_gaps=((date(1998, 1, 1), date(1998, 1, 31)),),
)

# KPI and channel names dealt to events by id.
KPIS = (
    "Spend", "Spend GBP", "Spend EUR", "Clicks", "Impressions", "New Customers", "Sales", "Installs", "Visits",
    "Incremental New Customers", "Incremental Gross Sales EUR", "Incremental Gross Sales GBP",
    "Incremental Spend EUR", "Last Click New Customers", "Last Click Total Transactions",
    "Last Click Net Sales GBP", "Last Click Net Sales EUR", "Last Click Marketing Spend GBP",
    "Last Click Marketing Spend EUR", "Last Click Gross Sales GBP", "Last Click Gross Sales EUR",
    "Last Click Transactions Tracked", "Transactions Tracked",
)
CHANNELS = (
    "Web - Paid Search", "App - Paid Social", "Affiliates", "Organic Search", "App Organic", "Web Direct", "Email",
    "Paid Display", "Paid Search", "Social", "TOC", "Brand",
)


def _numbered(names) -> str:
    return ", ".join(f"({i}, '{name}')" for i, name in enumerate(names))


def _money(name: str, expr: str) -> str:
    return f"{expr} as m_{name}_eur, ({expr})*0.85 as m_{name}_gbp"


_REVENUE = "l.l_extendedprice*l.l_tax"


def _share(name: str, factor: str, condition: str | None = None) -> str:
    gbp = {"0.5": "0.425", "0.3": "0.255", "0.1": "0.085", "0.4": "0.34"}[factor]
    wrap = lambda f: f"{_REVENUE}*{f}" if condition is None else f"case when {condition} then {_REVENUE}*{f} else 0e0 end"
    return f"{wrap(factor)} as m_{name}_eur, {wrap(gbp)} as m_{name}_gbp"


_REGION_OF_NATION = (
    "case when n.n_regionkey=0 then 'Inbound' when n.n_regionkey=1 then 'RoE' "
    "when n.n_regionkey=2 then 'France' when n.n_regionkey=4 then 'United Kingdom' end"
)
_CUSTOMER_REGION = "case {c} % 4 when 0 then 'United Kingdom' when 1 then 'France' when 2 then '{inbound}' else '{roe}' end"
_ORDER_JOINS = (
    "{orders} o join {customer} c on o.o_custkey=c.c_custkey join {nation} n on c.c_nationkey=n.n_nationkey"
)


def _growth(scope: str, day: str) -> str:
    stages = {"el": "signup", "ret": "purchase", "res": "view"}
    gbp = lambda e: f"cast(sum(case when event_type='{e}' then cast(value as decimal(12,2))*0.85 else 0 end) as double)"
    eur = lambda e: f"cast(sum(case when event_type='{e}' then cast(value as decimal(12,2)) else 0 end) as double)"
    moved = lambda e, odd: f"sum(case when event_type='{e}' and event_id % 2={odd} then 1 else 0 end)"
    cols = []
    for k, e in stages.items():
        cols += [
            f"count(distinct case when event_type='{e}' then user_id end) as {k}_volume",
            f"{eur(e)} as {k}_nts_eur", f"{gbp(e)} as {k}_nts_gbp",
            f"{moved(e, 0)} as {k}_retention", f"{moved(e, 1)} as {k}_churned",
        ]
    return (
        f"select '{scope}' as date_scope, {day} as year_month_day, "
        "case when user_id % 4 = 0 then 'UK' else 'EU' end as product_pl, "
        + _CUSTOMER_REGION.format(c="user_id", inbound="Inbound", roe="RoE")
        + f" as region, {', '.join(cols)} from {{events}} group by 1, 2, 3, 4"
    )


_BANDS_AFTER_FIRST_FIVE = {
    "m25_36": "0.03e0", "m37_48": "0.02e0", "m49_60": "0.02e0", "m61_72": "0.01e0", "m73_84": "0.01e0",
    "m85_96": "0.01e0", "m97_108": "0.01e0", "m109_120": "0.01e0",
}
_AD_KEY_CONSTANTS = (
    "event_programmatic_channel_name", "event_creative_id", "event_ad_unit_name", "event_device_category_name",
    "event_ad_unit_id", "event_mobile_app_name", "event_order_name", "event_advertiser_id",
    "event_device_category_id", "event_mobile_inventory_type", "event_country_criteria_id", "event_country_name",
    "event_line_item_type",
)


def _ad_rows(shift: str, extra: str) -> str:
    constants = ", ".join(f"'n/a' as {c}" for c in _AD_KEY_CONSTANTS)
    return (
        "select cast(e.ts as date) as event_date, e.user_id as event_order_id, "
        "cast(floor(e.event_id / 20) as bigint) as event_line_item_id, "
        "case when e.user_id % 20 = 0 then 'IntoWowNonBillable' else 'Adv' end as event_advertiser_name, "
        f"{constants}, case when e.event_type='view' then 'House Promo' else 'Paid Line' end as event_line_item_name, "
        f"e.ts{shift} as header_eventtime, "
        f"cast(round(e.value*1000000) as bigint){extra} as revenue_micros, "
        "cast(floor(e.value*10) as bigint) as impressions, cast(floor(e.value) as bigint) as clicks from {events} e"
    )


def _budget_multiples(columns: dict[str, str]) -> str:
    return ", ".join(f"cast(round(gross * {f}, 2) as double) as {name}" for name, f in columns.items())


SQL: dict[str, str] = {
    "order_lines": f"""
select cast(l.l_shipdate as date) as year_month_day, cast(l.l_shipdate as date) as product_issued_date,
 l.l_orderkey as order_id, o.o_custkey as order_customer_id,
 case when n.n_regionkey=3 then 'UK' when n.n_regionkey=4 and l.l_linenumber=7 then cast(null as varchar(8)) else 'EU' end as product_pl_code,
 case when n.n_regionkey=3 then 'United Kingdom' when n.n_regionkey=4 and l.l_linenumber=7 then cast(null as varchar(16))
      when n.n_regionkey=0 then 'Inbound' when n.n_regionkey=1 then 'RoE' when n.n_regionkey=2 then 'France' else 'United Kingdom' end as order_region_name,
 case when c.c_mktsegment='MACHINERY' then 'Business' else 'Leisure' end as order_business_channel_code,
 case when l.l_suppkey % 10 = 0 then '99' when l.l_suppkey % 2 = 0 then '20' else '42' end as order_managed_group_id,
 case when l.l_partkey % 9 = 0 then 'hotel' when l.l_partkey % 3 = 0 then 'seasons' else 'travel' end as product_type_code,
 case when l.l_linenumber = 6 then 'OTHER' when l.l_linenumber % 2 = 0 then 'SGP' else 'TRACS' end as source_system,
 case when l.l_returnflag='R' then 'REFUND' else 'SALES' end as record_type,
 case when l.l_linestatus='F' and l.l_returnflag='N' then 'N' else 'Y' end as product_gross_sales_flag,
 cast(l.l_quantity as integer) as product_number_of_tickets,
 case l.l_partkey % 3 when 0 then 'long distance' when 1 then 'regional' else cast(null as varchar(8)) end as fare_train_classification_name_longest_duration,
 case l.l_partkey % 2 when 0 then 'high speed' else 'conventional' end as product_train_speed_code,
 case l.l_suppkey % 3 when 0 then 'Commuting' when 1 then 'Leisure' else 'Business' end as product_travel_classification_name,
 {_money('gross_sales_amount', 'l.l_extendedprice')},
 {_money('net_sales_amount', 'l.l_extendedprice*(1-l.l_discount)')},
 {_money('refunded_amount', "case when l.l_returnflag='R' then l.l_extendedprice else 0e0 end")},
 {_money('revenue_total', _REVENUE)},
 {_share('revenue_total_fees', '0.5')},
 {_share('revenue_booking_fee', '0.3', 'l.l_linenumber <= 3')},
 {_share('revenue_refund_admin_fee', '0.1', "l.l_returnflag='R'")},
 {_share('revenue_coj_admin_fee', '0.1', "l.l_returnflag='A'")},
 l.l_extendedprice*l.l_discount*0.2 as m_revenue_product_commission_amount_eur, l.l_extendedprice*l.l_discount*0.17 as m_revenue_product_commission_amount_gbp,
 case when l.l_partkey % 4 = 0 then l.l_extendedprice*0.01 else 0e0 end as m_revenue_insurance_commission_amount_eur, case when l.l_partkey % 4 = 0 then l.l_extendedprice*0.0085 else 0e0 end as m_revenue_insurance_commission_amount_gbp,
 case when l.l_suppkey % 5 = 0 then l.l_extendedprice*0.02 else 0e0 end as m_revenue_fx_margin_eur, case when l.l_suppkey % 5 = 0 then l.l_extendedprice*0.017 else 0e0 end as m_revenue_fx_margin_gbp,
 {_share('costs_total', '0.4')}
from {{lineitem}} l join {{orders}} o on l.l_orderkey=o.o_orderkey join {{customer}} c on o.o_custkey=c.c_custkey join {{nation}} n on c.c_nationkey=n.n_nationkey""",
    "marketing": f"""
select cast(e.ts as date) - 9000 as activity_date, k.kpi, ch.channel,
 case e.user_id % 3 when 0 then 'Google' when 1 then 'Brand Organic' else cast(null as varchar(8)) end as sub_channel,
 case e.user_id % 4 when 0 then 'adwords' else 'other' end as channel_source,
 case when e.event_id % 5 = 0 then 'App' else 'Web' end as device,
 case e.user_id % 5 when 0 then cast(null as varchar(8)) when 1 then 'iOS' when 2 then 'Android' else 'Web' end as platform,
 case when e.user_id % 5 = 0 then 'UK' when e.user_id % 5 = 1 then 'INT' when e.user_id % 5 = 4 and e.user_id % 7 = 0 then cast(null as varchar(8)) else 'EU' end as pnl_segment,
 case when e.user_id % 5 in (0,1) then 'United Kingdom' when e.user_id % 5 = 4 and e.user_id % 7 = 0 then cast(null as varchar(8))
      when e.user_id % 5 = 2 then 'Inbound' when e.user_id % 5 = 3 then 'RoE' else 'France' end as region,
 e.value as value
from {{events}} e join (values {_numbered(KPIS)}) as k(i,kpi) on e.event_id % {len(KPIS)} = k.i
 join (values {_numbered(CHANNELS)}) as ch(i,channel) on e.user_id % {len(CHANNELS)} = ch.i""",
    "customer_accounts": f"""
select o.o_custkey as person_id, o.o_custkey as customer_id, 'latest' as segment,
 case when o.o_custkey % 10 = 0 then '99' else '20' end as managed_group_id,
 min(case when n.n_regionkey<>3 then cast(o.o_orderdate as date) end) as person_first_eu_transaction_date,
 min(case when n.n_regionkey=3 then cast(o.o_orderdate as date) end) as person_first_uk_transaction_date,
 max({_REGION_OF_NATION}) as person_first_eu_transaction_order_region
from {_ORDER_JOINS} group by o.o_custkey""",
    "journey_searches": """
select cast(ts as date) as year_month_day,
 concat(case user_id % 3 when 0 then 'GB' when 1 then 'FR' else 'IT' end, ' - ', 'XX') as search_odpair_country_name,
 case event_id % 4 when 0 then 'Bus' else 'High-speed Train' end as search_result_transport_mode,
 case user_id % 6 when 0 then '99' else '20' end as search_managed_group_id,
 cast(1 + event_id % 5 as integer) as m_search_result_journey_count,
 case when event_type='error' then 1 else 0 end as m_search_result_unsellable_journey_count from {events}""",
    "growth_summary": _growth("DAY", "cast(ts as date)") + " union all " + _growth("WEEK", "cast(date_trunc('week', ts) as date)"),
    "weekly_budget": f"""
select concat(lpad(cast(day(w) as varchar(2)),2,'0'),'/',lpad(cast(month(w) as varchar(2)),2,'0'),'/',substr(cast(w as varchar(10)),3,2)) as report_week_commencing,
 region, orders_booked as gross_transactions_budget,
 {_budget_multiples({'gross_sales_budget': '1.1', 'net_sales_budget': '0.95', 'total_revenue_budget': '0.05', 'total_costs_budget': '0.02', 'gross_margin_budget': '0.03', 'marketing_spend_budget': '0.01', 'gm_minus_pms_budget': '0.02', 'new_customers_budget': '0.001'})}
from (select cast(date_trunc('week', cast(o_orderdate as date) + 1) as date) - 1 as w, {_CUSTOMER_REGION.format(c='o_custkey', inbound='Inbound', roe='RoE')} as region,
  sum(cast(o_totalprice as decimal(14,2))) as gross, count(*) as orders_booked from {{orders}} group by 1, 2) x""",
    "monthly_budget": f"""
select 'Budget' as version, year_month, region, orders_booked as gross_transactions_budget,
 {_budget_multiples({'gross_sales_budget': '1.1', 'net_sales_budget': '0.95', 'new_customers_budget': '0.001', 'performance_marketing_spend_budget': '0.01', 'total_revenue_budget': '0.05', 'total_costs_budget': '-0.02'})}
from (select substr(cast(cast(o_orderdate as date) as varchar(10)),1,7) as year_month, {_CUSTOMER_REGION.format(c='o_custkey', inbound='ROW', roe='ROE')} as region,
  sum(cast(o_totalprice as decimal(14,2))) as gross, count(*) as orders_booked from {{orders}} group by 1, 2) x""",
    "ad_report": _ad_rows("", "") + " union all " + _ad_rows(" - interval '1' hour", " + 7") + " where e.event_id % 10 = 0",
    "hotel_feed": f"""
select event_id, cast(floor(event_id / 3) as bigint) as event_booking_orders_id, ts as event_created, ts as event_time,
 case user_id % 4 when 0 then 'XY' when 1 then 'gb' when 2 then 'FR' else 'IT' end as event_accommodation_details_location_country,
 case event_id % 3 when 0 then 'EUR' when 1 then 'USD' else 'ZZZ' end as event_currency_booker,
 value*0.1 as event_commission_estimated_amount_booker_currency, case when event_id % 4 = 0 then value*0.12 end as event_commission_actual_amount_orders
 from {{events}} where event_type='purchase' and cast(ts as date) >= date '{CONFIG.hotel_feed_cutover}'""",
    "hotel_manual": f"""
select cast(ts as date) as booking_date, cast(floor(event_id / 3) as bigint) as booking_number, ts as event_time,
 case user_id % 4 when 0 then 'Korea, South' when 1 then 'Abkhazia' when 2 then 'France' else 'United Kingdom' end as booker_country, value*0.09 as your_commission_in_your_currency
 from {{events}} where event_type='purchase' and cast(ts as date) < date '{CONFIG.hotel_feed_cutover}'""",
    "web_events": """
select cast(ts as date) as event_date, event_id, case event_type when 'click' then 'product selected' else 'product impression' end as event_params_kv_event_action,
 case user_id % 5 when 0 then 'other' else 'partnership' end as event_params_kv_event_category, 'accommodation' as event_params_kv_event_label,
 case user_id % 3 when 0 then 'united kingdom' when 1 then 'France' else 'Italy' end as geo_country from {events} where event_type in ('click','view')""",
    "payback": f"""
select cast(ts as date) - 9000 as activity_date, {_CUSTOMER_REGION.format(c='user_id', inbound='Inbound', roe='RoE')} as region,
 case event_id % 4 when 0 then 'Organic Search' when 1 then 'Affiliates' when 2 then 'App Organic' else 'Paid X' end as channel_0, 'SEO' as channel_1, 'none' as channel_2,
 (event_id % 10 = 0) as original_attribution, case event_id % 7 when 0 then 'Channel' else 'Campaign' end as multiplier_level,
 0.20e0 as m1_multiplier, 0.15e0 as m2_m3_multiplier, 0.10e0 as m4_m6_multiplier, 0.05e0 as m7_m12_multiplier, 0.04e0 as m13_m24_multiplier,
 {', '.join(f'{v} as {k}_multiplier' for k, v in _BANDS_AFTER_FIRST_FIVE.items())},
 value as marketing_spend_gbp, 1 + event_id % 3 as new_customer_count, value * (event_id % 5) as total_first_trx_gm_gbp from {{events}}""",
}


def lines_of_orders(lineitem: DataFrame, orders: DataFrame, customer: DataFrame, nation: DataFrame, tasks: int) -> DataFrame:
    """The rows ``order_lines`` derives its columns from: each line with its order's customer, segment and region.

    The orders meet their customers first, so lines are shuffled once, by order, to ``tasks``. If these follow
    the number of lines, what a task sorts does not grow with the input.
    """
    buyers = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    lines = lineitem.where(F.col("l_orderkey").isNotNull()).select(*LINE_COLUMNS).repartition(tasks, "l_orderkey")
    bought = buyers.select("o_orderkey", "o_custkey", "c_mktsegment", "n_regionkey").repartition(tasks, "o_orderkey")
    return lines.join(bought, F.col("l_orderkey") == F.col("o_orderkey"))


# Columns of the lines that the derivation reads.
LINE_COLUMNS = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
    "l_linestatus", "l_shipdate",
)


def fixture_sources(spark: SparkSession, sf_dir: str) -> Sources:
    """Every source table over one directory of test data, opened lazily.

    The join behind ``order_lines`` is stored by order on first use and read by every scan of them; its columns are
    derived by the select list of its SQL.
    """

    opened: dict[str, DataFrame] = {}

    def table(name: str) -> DataFrame:
        if name not in opened:
            opened[name] = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        return opened[name]

    def derive(sql: str):
        return spark.sql(sql, **{t: table(t) for t in TABLES if "{" + t + "}" in sql})

    def order_lines() -> DataFrame:
        parts, tasks = [table(t) for t in ("lineitem", "orders", "customer", "nation")], tasks_for(table("lineitem"))
        joined = sources.kept_by(spark, "lines-of-orders", "l_orderkey", tasks, lambda: lines_of_orders(*parts, tasks))
        columns = SQL["order_lines"].partition("\nfrom {lineitem} l join ")[0]
        return spark.sql(re.sub(r"\b[ocn]\.(?=[ocn]_)", "l.", columns) + "\nfrom {joined} l", joined=joined)

    calendar = lookups.calendar(spark, CALENDAR_FIRST, CALENDAR_LAST)
    tables = {name: (lambda sql=sql: derive(sql)) for name, sql in SQL.items()} | {"order_lines": order_lines}
    sources = Sources({
        **tables,
        "calendar": calendar,
        "plan_calendar": lookups.plan_calendar(calendar),
        "region_map": lookups.region_map(spark),
        "countries": lookups.countries(spark),
        "country_names": lookups.country_names(spark),
        "fx_rates": lookups.fx_rates(spark),
    }, label=sf_dir)
    return sources
