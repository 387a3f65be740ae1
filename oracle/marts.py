"""DuckDB statements of the marts."""

from __future__ import annotations

from oracle.base import (
    CUTOVER, END, OUT, START, cte, dbl, dec, div, div0, exact, fan, longform, mart_rows, money4, pick, round4, total,
)

IN_RUN = f"between date '{START}' and date '{END}'"
DPR = "year_month_day, product_pl, region"
FULL = f"{DPR}, category, sub_category"
WK = "week_commencing_date, product_pl, region, category, sub_category"
UNLABELLED = "'All' as category, 'All' as sub_category"
SERIES = "product_pl, region, category, sub_category, metric_name"


def week_sum(mart: str, metrics: list[str]) -> str:
    names = ", ".join(f"'{m}'" for m in metrics)
    return (
        f"select week_commencing_date, {SERIES}, {exact('sum(' + dec('metric_value', 8) + ')')} as metric_value from {mart} "
        f"where date_scope = 'DAY' and metric_name in ({names}) group by all"
    )


def ytd(mart: str, metrics: list[str]) -> str:
    names = ", ".join(f"'{m}'" for m in metrics)
    return (
        f"select financial_year, week_number, week_commencing_date, {SERIES}, "
        + exact(f"sum({dec('metric_value', 8)}) over (partition by financial_year, {SERIES} order by week_commencing_date rows unbounded preceding)")
        + " as metric_value "
        f"from {mart} where date_scope = 'WEEK' and metric_name in ({names})"
    )


def ratio_join(
    rows: str, cols: str, name: str, num: str, den: str, on: list[str], num_sub: str | None = None, scale: str = "", category: str = "n.category"
) -> str:
    """One ratio metric by joining its numerator rows to its denominator rows."""
    match = " and ".join(f"n.{c} = d.{c}" for c in on)
    sub = f" and n.sub_category = '{num_sub}'" if num_sub else ""
    keys = ", ".join(f"n.{c.strip()}" for c in cols.split(","))
    ratio = f"case when d.metric_value > 0 then n.metric_value / (d.metric_value{scale}) else 0e0 end"
    return (
        f"select {keys}, {category} as category, n.sub_category, '{name}' as metric_name, {ratio} as metric_value "
        f"from {rows} n join {rows} d on {match} where n.metric_name = '{num}' and d.metric_name = '{den}'{sub}"
    )


def ratio_zero_filled(rows: str, keys: str, ratios: list[tuple[str, str, str]]) -> str:
    """Ratios whose missing inputs count as zero; zero results are left out."""
    names = ", ".join(f"'{m}'" for _, n, d in ratios for m in (n, d))
    val = lambda m: f"coalesce(max(case when metric_name = '{m}' then metric_value end), 0e0)"
    parts = " union all ".join(
        f"select {keys}, '{name}' as metric_name, case when {val(d)} > 0 then {val(n)} / {val(d)} end as metric_value "
        f"from {rows} where metric_name in ({names}) group by {keys}"
        for name, n, d in ratios
    )
    return f"select * from ({parts}) z where coalesce(metric_value, 0) <> 0"


# --- supply ----------------------------------------------------------------------------------

cte("x_supply_sales", f"""
select year_month_day, {OUT}, {', '.join(f"{total(f'm_{c}_amount_{cur}')} as {n}_{cur}" for n, c in (('gross', 'gross_sales'), ('net', 'net_sales'), ('refunds', 'refunded')) for cur in ('gbp', 'eur'))}
from x_lines {fan('product_pl_code', 'order_region_name')} where year_month_day {IN_RUN} group by all""")
cte("x_supply_searches", f"""
select j.year_month_day, {OUT}, sum(coalesce(m_search_result_journey_count, 0)) as journeys, sum(m_search_result_unsellable_journey_count) as unsellable
from x_journey_searches j join x_countries c on split_part(j.search_odpair_country_name, ' - ', 1) = c.country_code {fan('c.product_pl', 'c.region')}
where j.year_month_day {IN_RUN} and search_managed_group_id in ('20','42') and lower(search_result_transport_mode) like '%train%' group by all""")
SALES_ROWS = longform("x_supply_sales", DPR, {
    "WBR Gross Sales": money4(pick("gross")), "WBR Net Sales": money4(pick("net")), "Total Refunds": money4(pick("refunds")),
    "Refunds Ratio": round4(div0(pick("refunds"), pick("gross"))),
})
SEARCH_ROWS = longform("x_supply_searches", DPR, {
    "Total Journeys": "journeys", "Unsellable Journeys": "unsellable",
    "Unsellable Journey Ratio": round4(div0("unsellable", "journeys")),
})
cte("x_supply_day", mart_rows(f"select *, {UNLABELLED} from ({SALES_ROWS} union all {SEARCH_ROWS}) s", "DAY"))
cte("x_supply_w", week_sum("x_supply_day", ["WBR Gross Sales", "WBR Net Sales", "Total Refunds", "Total Journeys", "Unsellable Journeys"]))
BUDGETS = {
    "Gross Sales Budget": "gross_sales_budget", "Net Sales Budget": "net_sales_budget", "Total Revenue Budget": "total_revenue_budget",
    "Total Costs Budget": "total_costs_budget", "Gross Margin Budget": "gross_margin_budget", "Marketing Spend Budget": "marketing_spend_budget",
    "GM - PMS Budget": "gm_minus_pms_budget", "New Customers Budget": "new_customers_budget",
}
cte("x_week_plan", f"""
select *, case when region = 'United Kingdom' then 'UK' else 'EU' end as product_pl from (
  select cast(strptime(report_week_commencing, '%d/%m/%y') as date) as week_commencing_date, b.* from x_weekly_budget b) p
where week_commencing_date {IN_RUN}""")
SUPPLY_ON = ["week_commencing_date", "product_pl", "region"]
_supply_budget = longform("x_week_plan", "week_commencing_date, product_pl, region", BUDGETS)
cte("x_supply_week", mart_rows(f"""
select {WK}, metric_name, metric_value from x_supply_w
union all {ratio_join('x_supply_w', 'week_commencing_date, product_pl, region', 'Refunds Ratio', 'Total Refunds', 'WBR Gross Sales', SUPPLY_ON)}
union all {ratio_join('x_supply_w', 'week_commencing_date, product_pl, region', 'Unsellable Journey Ratio', 'Unsellable Journeys', 'Total Journeys', SUPPLY_ON)}
union all select week_commencing_date, product_pl, region, 'All', 'All', metric_name, metric_value from ({_supply_budget}) b""", "WEEK"))
cte("x_supply_y", ytd("x_supply_week", ["WBR Gross Sales", "WBR Net Sales", "Total Refunds", "Total Journeys", "Unsellable Journeys", *BUDGETS]))
YTD_COLS = "financial_year, week_number, week_commencing_date, product_pl, region"
YTD_ON = ["financial_year", "week_commencing_date", "product_pl", "region"]
cte("x_supply_fytd", mart_rows(f"""
select {YTD_COLS}, category, sub_category, metric_name, metric_value from x_supply_y
union all {ratio_join('x_supply_y', YTD_COLS, 'Refunds Ratio', 'Total Refunds', 'WBR Gross Sales', YTD_ON)}
union all {ratio_join('x_supply_y', YTD_COLS, 'Unsellable Journey Ratio', 'Unsellable Journeys', 'Total Journeys', YTD_ON)}""", "FYtD"))

# --- acquisition -----------------------------------------------------------------------------

_volume = "('Installs','New Customers','Clicks','Sales')"
_paid = "('Web - Paid Search','Web - Paid Social','App - Paid Search','App - Paid Social','Affiliates')"
_app = "(coalesce(lower(device), '') = 'app' or lower(channel) = 'app')"
_lower = "(coalesce(sub_channel, '') in ('Apple Search','Google','Google UAC') or coalesce(channel_source, '') in ('apple_search','adwords'))"
CATEGORY = f"""case when channel in ('App Organic','Web Direct','Email','Other','Paid Display','Referral','Paid Other')
  or (channel = 'Organic Search' and kpi not in {_volume}) then 'Organic Last Click'
 when starts_with(kpi, 'Incremental') then 'Paid Incremental'
 when starts_with(kpi, 'Last Click') or kpi in ('Spend','Spend GBP','Spend EUR','Impressions','Visits') then 'Paid Last Click' else 'Other' end"""
SUB_CATEGORY = f"""case when channel = 'Organic Search' and kpi not in {_volume} then coalesce(sub_channel, 'Unknown')
 when channel = 'App Organic' then 'App - Organic' when channel = 'Web Direct' then 'Web - Direct'
 when channel in ('Email','Other','Paid Display','Referral','Paid Other') then 'Other' when channel in {_paid} then channel
 when {_app} and {_lower} then 'Paid App Lower Funnel' when {_app} then 'Paid App Mid Funnel'
 when channel = 'Paid Search' then case kpi when 'Installs' then 'Paid App Lower Funnel' else 'Web Lower Funnel' end
 when channel in ('Paid Social','Display','Social') then case kpi when 'Installs' then 'Paid App Mid Funnel' else 'Web Mid Funnel' end
 when channel = 'Brand' then 'Brand' else 'Other' end"""
KPIS = {
    "spend_eur": "Spend EUR", "spend_gbp": "Spend GBP", "clicks": "Clicks", "impressions": "Impressions", "installs": "Installs",
    "visits": "Visits", "inc_new": "Incremental New Customers", "inc_sales_eur": "Incremental Gross Sales EUR",
    "inc_sales_gbp": "Incremental Gross Sales GBP", "inc_spend_eur": "Incremental Spend EUR", "lc_new": "Last Click New Customers",
    "lc_trx": "Last Click Total Transactions", "lc_tracked": "Last Click Transactions Tracked", "lc_net_gbp": "Last Click Net Sales GBP",
    "lc_net_eur": "Last Click Net Sales EUR", "lc_spend_gbp": "Last Click Marketing Spend GBP", "lc_spend_eur": "Last Click Marketing Spend EUR",
    "lc_gross_gbp": "Last Click Gross Sales GBP", "lc_gross_eur": "Last Click Gross Sales EUR",
}
cte("x_campaigns", f"""
select activity_date as year_month_day, {OUT}, {CATEGORY} as category, {SUB_CATEGORY} as sub_category, kpi, value
from (select * from x_marketing where activity_date {IN_RUN} and channel not in ('TOC','Brand')) mk {fan('mk.pnl_segment', 'mk.region')}""")
cte("x_campaign_cube", f"""
select {DPR}, case when grouping(category) = 1 then 'All' else category end as category,
 case when grouping(sub_category) = 1 then 'All' else sub_category end as sub_category,
 {', '.join(f"sum(case when kpi = '{k}' then cast(value as decimal(18,7)) end) as {c}" for c, k in KPIS.items())}
from x_campaigns group by {DPR}, cube (category, sub_category)""")
cte("x_acquisition_metrics", longform("x_campaign_cube", FULL, {
    "Marketing Spend": pick("spend"), "Total Clicks": "clicks", "Total Impressions": "impressions", "Total Installs": "installs",
    "Total Visits": "visits", "Incremental New Customers": "inc_new", "Incremental Gross Sales": pick("inc_sales"),
    "Incremental ROAS": div0("inc_sales_eur", "inc_spend_eur"), "Incremental Gross Sales EUR": "inc_sales_eur",
    "Incremental Spend EUR": "inc_spend_eur", "Last Click New Customers": "lc_new", "Last Click Total Transactions": "lc_trx",
    "Last Click Transactions Tracked": "lc_tracked", "Last Click Net Sales": pick("lc_net"), "Last Click Marketing Spend": pick("lc_spend"),
    "Last Click Gross Sales": pick("lc_gross"), "LC_CPA": div0(pick("lc_spend"), "lc_new", "null"),
    "CPA": div0(pick("spend"), "lc_new", "null"), "CVR": div0("lc_tracked", "visits", "null"),
}, "metric_value > 0"))

_bands = [("m1", 0, 1), ("m2_m3", 1, 2), ("m4_m6", 3, 3), ("m7_m12", 6, 6), ("m13_m24", 12, 12), ("m25_36", 24, 12), ("m37_48", 36, 12),
          ("m49_60", 48, 12), ("m61_72", 60, 12), ("m73_84", 72, 12), ("m85_96", 84, 12), ("m97_108", 96, 12), ("m109_120", 108, 12)]
cte("x_payback_label", f"""
select activity_date as year_month_day, region, case when region = 'United Kingdom' then 'UK' else 'EU' end as product_pl,
 case when channel_0 in ('Organic Search','App Organic','Web Direct','Email','Other','Paid Display','Referral','Paid Other') then 'Organic Last Click' else 'Paid Last Click' end as category,
 case when channel_0 = 'App Organic' then 'App - Organic' when channel_0 = 'Web Direct' then 'Web - Direct' when channel_0 = 'Organic Search' then channel_1
  when channel_0 in {_paid} then channel_0 when channel_0 in ('Email','Other','Paid Display','Referral','Paid Other') then 'Other' else 'Others' end as sub_category,
 {div(total('marketing_spend_gbp'), 'sum(new_customer_count)')} as cpa,
 {', '.join(f"{div(total(f'total_first_trx_gm_gbp * {b}_multiplier'), 'sum(new_customer_count)')} as gm_{b}" for b, _, _ in _bands)}
from x_payback where activity_date {IN_RUN} and not original_attribution and multiplier_level = 'Campaign' group by 1, 2, 3, 4, 5""")


def _earned(n: int) -> str:
    return " + ".join(f"gm_{b}" if length == 1 else f"gm_{b} * {float(length)}e0" for b, _, length in _bands[:n])


_walk = "case when gm_m1 > cpa then 1e0 " + " ".join(
    f"when {_earned(i + 1)} > cpa then {float(_bands[i][1])}e0 + (cpa - ({_earned(i)})) / nullif(gm_{_bands[i][0]}, 0)" for i in range(1, 12)
) + f" else 108e0 + (cpa - ({_earned(12)})) / nullif(gm_m109_120, 0) end"
cte("x_payback_priced", f"select year_month_day, product_pl, region, category, sub_category, {_walk} as months from x_payback_label")
cte("x_payback_months", f"""
select * from (select year_month_day, {OUT}, case when grouping(category) = 1 then 'All' else category end as category,
 case when grouping(sub_category) = 1 then 'All' else sub_category end as sub_category, 'Payback Months' as metric_name,
 cast(sum({dec('months', 8)}) as double) as metric_value
from x_payback_priced pp {fan('pp.product_pl', 'pp.region')} group by year_month_day, rm.output_product_pl, rm.output_region, cube (category, sub_category)) q
where metric_value > 0""")

cte("x_margins", f"""
select year_month_day, {OUT}, {', '.join(f"{total(f'm_revenue_total_{c}')} as revenue_{c}, {total(f'm_costs_total_{c}')} as costs_{c}" for c in ('gbp', 'eur'))}
from x_lines {fan('product_pl_code', 'order_region_name')} where year_month_day {IN_RUN} group by all""")
cte("x_spend", f"""
select activity_date as year_month_day, {OUT}, {', '.join(f"sum(case when kpi = 'Spend {c.upper()}' then cast(value as decimal(18,7)) end) as spend_{c}" for c in ('gbp', 'eur'))}
from x_marketing mk {fan('mk.pnl_segment', 'mk.region')} where activity_date {IN_RUN} and kpi in ('Spend EUR','Spend GBP') group by all""")
cte("x_margin_rows", longform(
    f"(select m.*, {dbl(pick('spend', 's.product_pl'))} as spend from x_margins m left join x_spend s using ({DPR}))", DPR, {
        "Total Revenue": pick("revenue"), "Total Costs": pick("costs"),
        "Gross Margin": f"{pick('revenue')} - {pick('costs')}",
        "GM - PMS": f"{dbl(pick('revenue') + ' - ' + pick('costs'))} - spend",
    }))


def _flagged(line_filter: str) -> str:
    week = lambda d: f"date_trunc('week', {d} + 1)"
    return f"""
select l.year_month_day, l.year_month_day - cast(dayofweek(l.year_month_day) as integer) as week_commencing_date, {OUT}, a.person_id,
 coalesce(case when l.product_pl_code = 'UK' then {week('a.person_first_uk_transaction_date')} = {week('l.product_issued_date')}
  else {week('a.person_first_eu_transaction_date')} = {week('l.product_issued_date')} and a.person_first_eu_transaction_order_region = l.order_region_name end, false) as is_new
from x_lines l join x_customer_accounts a on a.customer_id = l.order_customer_id {fan('l.product_pl_code', 'l.order_region_name')}
where a.managed_group_id in ('20','42') and a.segment = 'latest' and l.year_month_day = l.product_issued_date and l.year_month_day {IN_RUN} {line_filter}"""


cte("x_customers_daily", _flagged("and l.product_gross_sales_flag = 'Y'"))
cte("x_customers_weekly", _flagged(""))


def _customer_rows(source: str, period: str) -> str:
    counts = f"""(select {period}, product_pl, region, count(distinct case when is_new then person_id end) as fresh, count(distinct person_id) as active
      from {source} group by all)"""
    rows = longform(counts, f"{period}, product_pl, region", {
        "New Customers": "fresh", "Existing Customers": "active - fresh", "Active Customers": "active"})
    return f"""select r.*, a.label as category, b.label as sub_category from ({rows}) r
      cross join (values ('TBD'), ('All')) as a(label) cross join (values ('TBD'), ('All')) as b(label)"""


OWNED = ("((product_pl = 'EU' and region not in ('Total','United Kingdom'{extra})) or (product_pl = 'UK' and region = 'United Kingdom') "
         "or (product_pl = 'UK & EU' and region = 'Total'))")
cte("x_customer_metrics_day", f"""
select * from (select {FULL}, metric_name, metric_value from (select *, {UNLABELLED} from x_margin_rows) m
 union all select {FULL}, metric_name, metric_value from ({_customer_rows('x_customers_daily', 'year_month_day')}) c) u where {OWNED.format(extra='')}""")
cte("x_acquisition_day", mart_rows(f"""
select {FULL}, metric_name, metric_value from x_acquisition_metrics
union all select {FULL}, metric_name, metric_value from x_payback_months
union all select {FULL}, metric_name, metric_value from x_customer_metrics_day""", "DAY"))
CAMPAIGN = ["Marketing Spend", "Total Clicks", "Total Impressions", "Total Installs", "Total Visits", "Incremental New Customers",
            "Incremental Gross Sales", "Payback Months", "Last Click New Customers", "Last Click Total Transactions",
            "Last Click Transactions Tracked", "Last Click Net Sales", "Last Click Marketing Spend", "Last Click Gross Sales"]
MARGIN = ["Total Revenue", "Total Costs", "Gross Margin", "GM - PMS"]
ROAS = ["Incremental Gross Sales EUR", "Incremental Spend EUR"]
EFFICIENCY = [("Incremental ROAS", "Incremental Gross Sales EUR", "Incremental Spend EUR"), ("CPA", "Marketing Spend", "Last Click New Customers"),
              ("CVR", "Last Click Transactions Tracked", "Total Visits"), ("LC_CPA", "Last Click Marketing Spend", "Last Click New Customers")]
cte("x_acquisition_w", week_sum("x_acquisition_day", CAMPAIGN + MARGIN + ROAS))
LABELS_ON = ["product_pl", "region", "category", "sub_category"]
cte("x_cost_per_click_week", ratio_join("x_acquisition_w", "week_commencing_date, product_pl, region", "Cost / Click", "Total Costs", "Total Clicks", ["week_commencing_date", *LABELS_ON]))
cte("x_customer_metrics_week", f"""
select * from (select {WK}, metric_name, metric_value from ({_customer_rows('x_customers_weekly', 'week_commencing_date')}) c
 where week_commencing_date in (select week_commencing_date from x_acquisition_day)
 union all select {WK}, metric_name, metric_value from x_cost_per_click_week) u where {OWNED.format(extra=",'Foreign Travel'")}""")
cte("x_acquisition_week", mart_rows(f"""
select {WK}, metric_name, metric_value from x_acquisition_w
union all select {WK}, metric_name, metric_value from ({ratio_zero_filled('x_acquisition_w', WK, EFFICIENCY)}) e
union all select {WK}, metric_name, metric_value from x_customer_metrics_week""", "WEEK"))
cte("x_acquisition_y", ytd("x_acquisition_week", CAMPAIGN + MARGIN + ROAS + ["New Customers", "Existing Customers", "Active Customers"]))
YFULL = f"{YTD_COLS}, category, sub_category"
cte("x_cost_per_click_fytd", ratio_join("x_acquisition_y", YTD_COLS, "Cost / Click", "Total Costs", "Total Clicks", ["financial_year", "week_commencing_date", *LABELS_ON]))
cte("x_acquisition_fytd", mart_rows(f"""
select {YFULL}, metric_name, metric_value from x_acquisition_y where metric_name not in ('{ROAS[0]}', '{ROAS[1]}')
union all select {YFULL}, metric_name, metric_value from ({ratio_zero_filled('x_acquisition_y', YFULL, EFFICIENCY)}) e
union all select {YFULL}, metric_name, metric_value from x_cost_per_click_fytd""", "FYtD"))

# --- conversion ------------------------------------------------------------------------------

cte("x_journey_orders", f"""
select year_month_day, {OUT}, 'Journey Type' as category,
 coalesce(case when product_pl_code = 'UK' or order_region_name = 'UK' then fare_train_classification_name_longest_duration else product_train_speed_code end, 'unknown') as sub_category,
 order_id, m_gross_sales_amount_gbp as gbp, m_gross_sales_amount_eur as eur
from x_lines {fan('product_pl_code', 'order_region_name')}
where year_month_day {IN_RUN} and product_gross_sales_flag = 'Y' and record_type = 'SALES'""")
_rolled = ", ".join(f"case when grouping({c}) = 1 then 'All' else {c} end as {c}" for c in ("category", "sub_category"))
cte("x_journey_cube", f"""
select {DPR}, {_rolled}, count(distinct order_id) as orders, {total('gbp')} as sales_gbp, {total('eur')} as sales_eur
from x_journey_orders group by {DPR}, cube (category, sub_category)""")
cte("x_platform_cube", f"""
select {DPR}, {_rolled}, sum(case when kpi = 'Visits' then cast(value as decimal(18,7)) end) as visits,
 sum(case when kpi = 'Transactions Tracked' then cast(value as decimal(18,7)) end) as tracked
from (select activity_date as year_month_day, {OUT}, 'Platform' as category, platform as sub_category, kpi, value
      from x_marketing mk {fan('mk.pnl_segment', 'mk.region')}
      where activity_date {IN_RUN} and kpi in ('Visits','Transactions Tracked') and platform is not null) p
group by {DPR}, cube (category, sub_category)""")
JOURNEY_ROWS = longform("x_journey_cube", FULL, {
    "WBR Gross Transactions": "orders", "Gross Sales": pick("sales"), "Avg Trans Value": div0(pick("sales"), "orders")})
PLATFORM_ROWS = longform("x_platform_cube", FULL, {
    "Total Visits": "visits", "Transactions Tracked": "tracked", "Conversion Ratio": div0("tracked", "visits")})
cte("x_conversion_day", mart_rows(f"select * from ({JOURNEY_ROWS}) j union all select * from ({PLATFORM_ROWS}) p", "DAY"))
cte("x_conversion_w", week_sum("x_conversion_day", ["Gross Sales", "WBR Gross Transactions", "Total Visits", "Transactions Tracked"]))
cte("x_conversion_plan", f"""
select week_commencing_date, {OUT}, {total('gross_sales_budget')} as sales, sum(gross_transactions_budget) as orders
from x_week_plan b join x_region_map rm on rm.input_region = b.region
 and ((rm.input_product_pl = 'EU' and b.region <> 'United Kingdom') or (rm.input_product_pl = 'UK' and b.region = 'United Kingdom')) group by all""")
PLAN_ROWS = longform("x_conversion_plan", "week_commencing_date, product_pl, region", {
    "Avg Trans Value Budget": f"cast(round(cast({div('sales', 'coalesce(orders, 1)')} as decimal(38,9)), 5) as double)",
    "Gross Transactions Budget": "orders", "Gross Sales Budget": "sales"})
CONVERSION_RATIOS = [("Avg Trans Value", "Gross Sales", "WBR Gross Transactions"), ("Conversion Ratio", "Transactions Tracked", "Total Visits")]
cte("x_conversion_week", mart_rows(f"""
select {WK}, metric_name, metric_value from x_conversion_w
union all select {WK}, metric_name, metric_value from ({ratio_zero_filled('x_conversion_w', WK, CONVERSION_RATIOS)}) e
union all select week_commencing_date, product_pl, region, 'All', 'All', metric_name, metric_value from ({PLAN_ROWS}) b""", "WEEK"))
cte("x_conversion_y", ytd("x_conversion_week", ["Gross Sales", "WBR Gross Transactions", "Total Visits", "Transactions Tracked", "Gross Transactions Budget", "Gross Sales Budget"]))
cte("x_conversion_fytd", mart_rows(f"""
select {YFULL}, metric_name, metric_value from x_conversion_y where metric_name <> 'Gross Sales Budget'
union all select {YFULL}, metric_name, metric_value from ({ratio_zero_filled('x_conversion_y', YFULL, CONVERSION_RATIOS)}) e
union all {ratio_join('x_conversion_y', YTD_COLS, 'Avg Trans Value Budget', 'Gross Sales Budget', 'Gross Transactions Budget', ['financial_year', 'week_commencing_date', *LABELS_ON])}""", "FYtD"))

# --- monetisation ----------------------------------------------------------------------------

FEES = {
    "Booking Fee": ("booking", "m_revenue_booking_fee", True), "Refund Fee": ("refund", "m_revenue_refund_admin_fee", True),
    "COJ Fee": ("coj", "m_revenue_coj_admin_fee", True), "Commission": ("commission", "m_revenue_product_commission_amount", False),
    "Ancillary": ("insurance", "m_revenue_insurance_commission_amount", False), "MCP": ("mcp", "m_revenue_fx_margin", True),
}
_cur = ("gbp", "eur")
_fee_sums = ", ".join(f"{total(f'{col}_{c}')} as {k}_{c}" for k, col, _ in FEES.values() for c in _cur)
_fee_tickets = ", ".join(
    f"sum(case when {col}_eur + {col}_gbp > 0 then product_number_of_tickets end) as {k}_tickets" for k, col, t in FEES.values() if t)
cte("x_line_extract", f"""
select year_month_day, {OUT}, count(distinct case when product_gross_sales_flag = 'Y' and record_type = 'SALES' then order_id end) as orders,
 sum(product_number_of_tickets) as tickets, {', '.join(f"{total(f'm_revenue_total_{c}')} as all_{c}, {total(f'm_revenue_total_fees_{c}')} as fees_{c}, {total(f'm_net_sales_amount_{c}')} as net_{c}" for c in _cur)},
 {_fee_sums}, {_fee_tickets}
from x_lines {fan('product_pl_code', 'order_region_name')} group by all""")
cte("x_visits", f"""
select activity_date as year_month_day, {OUT}, {total('value')} as visits from x_marketing mk {fan('mk.pnl_segment', 'mk.region')}
where activity_date {IN_RUN} and kpi = 'Visits' group by all""")
NON_FEE = f"({pick('all')} - {pick('fees')})"
cte("x_revenue_metrics", f"select *, {UNLABELLED} from (" + longform("x_line_extract", DPR, {
    "Total Revenue": money4(pick("all")), "Fee Revenue": money4(pick("fees")), "Non-Fee Revenue": money4(NON_FEE),
    "Gross Transactions": "orders", "Fee Revenue / Transaction": round4(div(pick("fees"), "orders"))}) + ") r")
cte("x_per_visit", f"""
select {DPR}, {UNLABELLED}, 'Non-Fee Revenue / Visit' as metric_name, {div0(NON_FEE, 'visits')} as metric_value
from x_line_extract join x_visits using ({DPR})""")
cte("x_total_visits", f"select {DPR}, {UNLABELLED}, 'Total Visits' as metric_name, {dbl('visits')} as metric_value from x_visits")


def _transaction_pairs() -> list[tuple[str, str]]:
    pairs = []
    gap = "(product_pl = 'EU' and year_month_day between date '1998-01-01' and date '1998-01-31')"
    for fee, (k, _, tickets) in FEES.items():
        hide = (lambda v: f"case when not {gap} then {v} end") if fee == "Refund Fee" else (lambda v: v)
        lab = lambda m, fee=fee: f"'Trx' as category, '{fee}' as sub_category, '{m}' as metric_name"
        if tickets:
            pairs += [(lab("Number of Tickets"), f"{k}_tickets"), (lab("Percent of Tickets"), round4(div(f"{k}_tickets", "tickets")))]
        pairs += [(lab("Take Rate"), hide(round4(div(pick(k), pick("net"))))), (lab("Revenue"), hide(money4(pick(k))))]
    lab = lambda m: f"'Trx' as category, 'Transaction' as sub_category, '{m}' as metric_name"
    return pairs + [(lab("Total Number of Tickets"), "tickets"), (lab("Net Sale"), money4(pick("net")))]


cte("x_transaction_metrics", longform("x_line_extract", DPR, _transaction_pairs()))
AD_KEY = (
    "event_order_id, event_programmatic_channel_name, event_advertiser_name, event_creative_id, event_date, event_ad_unit_name, "
    "event_device_category_name, event_ad_unit_id, event_mobile_app_name, event_line_item_id, event_order_name, event_advertiser_id, "
    "event_device_category_id, event_mobile_inventory_type, event_country_criteria_id, event_country_name, event_line_item_type")
cte("x_ad_rows", f"""
select * exclude (rn) from (select *, row_number() over (partition by {AD_KEY}
  order by header_eventtime desc, event_line_item_name desc, revenue_micros desc, impressions desc, clicks desc) as rn
 from x_ad_report where event_date between date '{START}' - 1 and date '{END}' and lower(event_advertiser_name) <> 'intowownonbillable') r where rn = 1""")
cte("x_ad_days", f"""
select event_date as year_month_day, {OUT}, sum(revenue_micros) as micros, sum(impressions) as shown, sum(clicks) as clicks,
 sum(case when lower(event_line_item_name) not like '%house%' then impressions end) as paid
from x_ad_rows join x_region_map rm on rm.input_product_pl = 'UK' and rm.input_region = 'United Kingdom' group by all""")
cte("x_ads_metrics", "select *, 'Non Trx' as category, 'Ads' as sub_category from (" + longform("x_ad_days", DPR, {
    "Revenue": round4("micros / 1e6"), "Impressions": "shown", "Monetised Impressions": "paid", "Clicks": "clicks",
    "CTR": round4(div("clicks", "shown")), "CPM": round4("(micros / 1e6) / nullif(paid / 1e3, 0)")}) + ") a")
_repair = "case lower(booker_country) " + " ".join(f"when '{a}' then '{b}'" for a, b in (
    ("korea, south", "korea, republic of"), ("abkhazia", "georgia"), ("congo (brazzaville)", "congo - brazzaville"),
    ("bonaire, saint eustatius and saba", "caribbean netherlands"), ("wallis and futuna islands", "france"),
    ("united states minor outlying islands", "united states"), ("congo (kinshasa)", "congo - kinshasa"),
    ("svalbard and jan mayen islands", "svalbard & jan mayen"))) + " else lower(booker_country) end"
_feed_place = ("left join x_countries c on c.country_code = replace(upper(f.event_accommodation_details_location_country), 'XY', 'CY')")
_manual_place = f"left join x_country_names l on lower(l.country_lookup_value) = {_repair} left join x_countries c on c.country_code = l.country_code"
PARTNER = "'Non Trx' as category, 'Partnerships-booking.com' as sub_category"
REMAP = "join x_region_map rm on rm.input_product_pl = q.product_pl and rm.input_region = q.region"
cte("x_feed_bookings", f"""
select * from (select *, row_number() over (partition by event_booking_orders_id order by event_created desc, event_id desc) as rn
 from x_hotel_feed where cast(event_created as date) >= date '{CUTOVER}') f where rn = 1""")
cte("x_manual_bookings", f"""
select * from (select *, row_number() over (partition by booking_number order by event_time desc, booking_date desc, booker_country desc) as rn
 from x_hotel_manual where booking_date < date '{CUTOVER}') m where rn = 1""")
cte("x_bookings", f"""
select cast(f.event_created as date) as year_month_day, c.product_pl, c.region, cast(f.event_booking_orders_id as varchar) as booking_id from x_feed_bookings f {_feed_place}
union select m.booking_date, c.product_pl, c.region, cast(m.booking_number as varchar) from x_manual_bookings m {_manual_place}""")
cte("x_hotel_bookings", f"""
select year_month_day, {OUT}, {PARTNER}, 'No. of Hotel Bookings' as metric_name, cast(sum(n) as double) as metric_value
from (select {DPR}, count(distinct booking_id) as n from x_bookings group by all) q {REMAP} group by all""")
cte("x_rates", """
select valid_from, valid_to, base_currency, avg(case when target_currency = 'GBP' then rate end) as rate_gbp
from x_fx_rates where target_currency in ('GBP','EUR') group by all""")
cte("x_commissions", f"""
select cast(f.event_created as date) as year_month_day, c.product_pl, c.region, cast(f.event_booking_orders_id as varchar) as booking_id,
 round(coalesce(r.rate_gbp, 1) * coalesce(f.event_commission_actual_amount_orders, f.event_commission_estimated_amount_booker_currency, 0), 10) as commission
from (select * from (select *, row_number() over (partition by event_id order by event_time desc) as rn from x_hotel_feed where cast(event_created as date) >= date '{CUTOVER}') z where rn = 1) f
left join x_rates r on r.base_currency = f.event_currency_booker and f.event_created between r.valid_from and r.valid_to {_feed_place}
union select m.booking_date, c.product_pl, c.region, cast(m.booking_number as varchar), m.your_commission_in_your_currency from x_manual_bookings m {_manual_place}""")
cte("x_hotel_revenue", f"""
select year_month_day, {OUT}, {PARTNER}, 'Revenue' as metric_name, cast(sum({dec('n', 8)}) as double) as metric_value
from (select {DPR}, cast(sum({dec('commission', 10)}) as double) as n from x_commissions group by all) q {REMAP} group by all""")
cte("x_web_counts", f"""
select event_date as year_month_day, c.product_pl, c.region,
 count(distinct case when event_params_kv_event_action = 'product impression' then event_id end) as shown,
 count(distinct case when event_params_kv_event_action = 'product selected' then event_id end) as clicks
from x_web_events w left join x_countries c on lower(c.country_name) = lower(w.geo_country)
where event_date between date '{START}' - 1 and date '{END}' and event_params_kv_event_category = 'partnership' and event_params_kv_event_label = 'accommodation'
 and event_date not between date '2024-01-10' and date '2024-01-12' group by all""")
cte("x_hotel_web_metrics", f"""
select year_month_day, {OUT}, {PARTNER}, metric_name, cast(sum({dec('metric_value', 8)}) as double) as metric_value
from ({longform('x_web_counts', DPR, {'Impressions': 'shown', 'Clicks': 'clicks', 'CTR': round4(div('clicks', 'shown'))})}) q {REMAP} group by all""")
_families = ("x_revenue_metrics", "x_per_visit", "x_total_visits", "x_transaction_metrics", "x_ads_metrics", "x_hotel_bookings", "x_hotel_revenue", "x_hotel_web_metrics")
cte("x_monetisation_metrics", " union ".join(f"select {FULL}, metric_name, metric_value from {f}" for f in _families))
cte("x_monetisation_day", mart_rows(f"select {FULL}, metric_name, metric_value from x_monetisation_metrics", "DAY"))
MON = ["Total Revenue", "Fee Revenue", "Non-Fee Revenue", "Gross Transactions", "Total Visits", "Revenue", "Net Sale", "Impressions",
       "Monetised Impressions", "Clicks", "No. of Hotel Bookings", "Number of Tickets", "Total Number of Tickets"]


def _monetisation_ratios(rows: str, cols: str, on: list[str]) -> str:
    same, wide = [*on, "category", "sub_category"], [*on, "category"]
    parts = [
        ratio_join(rows, cols, "CTR", "Clicks", "Impressions", same),
        ratio_join(rows, cols, "CPM", "Revenue", "Monetised Impressions", same, "Ads", " / 1000e0"),
        *[ratio_join(rows, cols, "Percent of Tickets", "Number of Tickets", "Total Number of Tickets", wide, f) for f, (_, _, t) in FEES.items() if t],
        *[ratio_join(rows, cols, "Take Rate", "Revenue", "Net Sale", wide, f) for f in FEES],
        ratio_join(rows, cols, "Fee Revenue / Transaction", "Fee Revenue", "Gross Transactions", same),
        ratio_join(rows, cols, "Non-Fee Revenue / Visit", "Non-Fee Revenue", "Total Visits", same),
    ]
    return " union all ".join(parts)


cte("x_monetisation_w", week_sum("x_monetisation_day", MON))
cte("x_monetisation_week", mart_rows(
    f"select {WK}, metric_name, metric_value from x_monetisation_w union all "
    + _monetisation_ratios("x_monetisation_w", "week_commencing_date, product_pl, region", SUPPLY_ON), "WEEK"))
cte("x_monetisation_y", ytd("x_monetisation_week", MON))
cte("x_monetisation_fytd", mart_rows(
    f"select {YFULL}, metric_name, metric_value from x_monetisation_y union all " + _monetisation_ratios("x_monetisation_y", YTD_COLS, YTD_ON), "FYtD"))

# --- retention -------------------------------------------------------------------------------

STAGE = {"Early Life": ("el", "Early life"), "Retained": ("ret", "Retained"), "Resurrected": ("res", "Resurrected")}


def _growth_rows(scope: str) -> str:
    first = {"DAY": f"date '{START}'", "WEEK": f"date '{START}' - 6"}[scope]
    sums = []
    for k, _ in STAGE.values():
        sums += [f"sum({k}_{c}) as {k}_{c}" for c in ("volume", "retention", "churned")]
        sums.append(f"sum(cast(case when product_pl = 'UK' or product_pl is null then {k}_nts_gbp else {k}_nts_eur end as decimal(18,7))) as {k}_nts")
    amount = " + ".join(f"cast(case when product_pl = 'UK' or product_pl is null then {k}_nts_gbp else {k}_nts_eur end as decimal(18,7))" for k, _ in STAGE.values())
    base = f"""(select g.day as year_month_day, {OUT}, {', '.join(s.replace('product_pl', 'g.product_pl') for s in sums)}, sum({amount.replace('product_pl', 'g.product_pl')}) as active_nts
      from (select *, year_month_day - {1 if scope == 'WEEK' else 0} as day from x_growth_summary
            where date_scope = '{scope}' and year_month_day between {first} and date '{END}' + 1) g {fan('g.product_pl', 'g.region')} group by all)"""
    pairs = []
    lab = lambda c, s, m: f"'{c}' as category, '{s}' as sub_category, '{m}' as metric_name"
    for stage, (k, title) in STAGE.items():
        pairs += [
            (lab("Volume", stage, f"28d {title} Person Count"), f"{k}_volume"),
            (lab("Net Sales Amount", stage, f"28d {title} Person NTS Amount"), money4(f"{k}_nts")),
            (lab("Retention", stage, f"28d {title} Person moved to Retained"), f"{k}_retention"),
            (lab("Churn", stage, f"28d {title} Person moved to Churned"), f"{k}_churned"),
        ]
    three = lambda c: " + ".join(f"{k}_{c}" for k, _ in STAGE.values())
    pairs += [
        (lab("Volume", "Active", "28d Active Customers"), three("volume")),
        (lab("Net Sales Amount", "Active", "28d Active Person NTS Amount"), money4("active_nts")),
        (lab("Churn", "Active", "28d Person moved Active to Inactive"), three("churned")),
    ]
    return longform(base, DPR, pairs)


RATES = {  # category, stage -> name, numerator category, denominator
    ("Retention %", "Early Life"): ("EL moved to Retained over Previous New", "Retention"),
    ("Retention %", "Retained"): ("Retained moved to Retained over Previous Retained", "Retention"),
    ("Retention %", "Resurrected"): ("Resurrected moved to Retained over Previous Resurrected", "Retention"),
    ("Churn %", "Early Life"): ("EL moved to Churn over Previous New", "Churn"),
    ("Churn %", "Retained"): ("Retained moved to Churn over Previous Retained", "Churn"),
    ("Churn %", "Resurrected"): ("Resurrected moved to Churn over Previous Resurrected", "Churn"),
    ("Churn %", "Active"): ("28d Active to Inactive over Previous active", "Churn"),
}
for _scope in ("DAY", "WEEK"):
    _s = _scope.lower()
    cte(f"x_growth_{_s}", _growth_rows(_scope))
    cte(f"x_lifecycle_{_s}", f"""
select * from (select g.*, lag(g.metric_value) over (partition by g.product_pl, g.region, g.category, g.sub_category order by g.year_month_day) as previous
 from x_growth_{_s} g join x_calendar c on c.date_scope = '{_scope}' and c.year_month_day = g.year_month_day) l where year_month_day {IN_RUN}""")
    _on = f"using ({DPR})"
    _rates = [
        f"""select {DPR}, '{cat}' as category, '{stage}' as sub_category, '{name}' as metric_name, n.metric_value / nullif(v.previous, 0) as metric_value
        from x_lifecycle_{_s} n join x_lifecycle_{_s} v {_on} where n.category = '{num}' and v.category = 'Volume' and n.sub_category = '{stage}' and v.sub_category = '{stage}'"""
        for (cat, stage), (name, num) in RATES.items()
    ] + [
        f"""select {DPR}, 'Proportion %' as category, '{stage}' as sub_category, '{name}' as metric_name, a.metric_value / nullif(r.metric_value + a.metric_value, 0) as metric_value
        from x_lifecycle_{_s} a join x_lifecycle_{_s} r {_on} where a.category = 'Volume' and r.category = 'Volume' and a.sub_category = '{stage}' and r.sub_category = 'Retained'"""
        for stage, name in (("Early Life", "Current EL over Current EL + Current Retained"), ("Resurrected", "Current Resurrected over current Retained + current Resurrected"))
    ]
    cte(f"x_lifecycle_rates_{_s}", " union all ".join(_rates))
cte("x_journey_classes", f"""
select * from (select year_month_day, {OUT}, case when fare_train_classification_name_longest_duration = 'long distance' and product_travel_classification_name not in ('Commuting','Business') then 'Leisure and Long Distance'
   when fare_train_classification_name_longest_duration = 'regional' and product_travel_classification_name = 'Commuting' then 'Commute and Regional' end as sub_category,
  order_customer_id, case when product_gross_sales_flag = 'Y' and record_type = 'SALES' then order_id end as order_id, m_net_sales_amount_gbp as gbp, m_net_sales_amount_eur as eur
 from x_lines {fan('product_pl_code', 'order_region_name')}) j
where sub_category is not null and ((product_pl = 'EU' and region not in ('Total','United Kingdom')) or (product_pl = 'UK' and region = 'United Kingdom'))""")
cte("x_journey_classes_sum", f"""
with per_class as (select {DPR}, sub_category, count(distinct order_customer_id) as customers, count(distinct order_id) as orders,
  {total('gbp')} as sales_gbp, {total('eur')} as sales_eur from x_journey_classes group by all)
select {DPR}, sub_category, customers, orders, {pick('sales')} as sales from per_class
union all select {DPR}, 'All', sum(customers), sum(orders), sum({pick('sales')}) from per_class group by all""")
cte("x_journey_metrics", f"select {DPR}, case when sub_category = 'All' then 'All' else klass end as category, sub_category, metric_name, metric_value from (" + longform(
    "x_journey_classes_sum", f"{DPR}, sub_category", [
        ("'Volume' as klass, 'Number of Customers' as metric_name", "customers"),
        ("'Volume Orders' as klass, 'Total number of Orders' as metric_name", "orders"),
        ("'Sales' as klass, 'Net Sales Amount' as metric_name", money4("sales")),
        ("'Frequency' as klass, 'Transactions per Customer' as metric_name", f"cast(round(cast({div('orders', 'customers')} as decimal(38,9)), 2) as double)"),
    ]) + ") j")
cte("x_retention_day", mart_rows(f"""
select {FULL}, metric_name, metric_value from x_lifecycle_day
union all select {FULL}, metric_name, metric_value from x_lifecycle_rates_day
union all select {FULL}, metric_name, metric_value from x_journey_metrics""", "DAY"))
cte("x_retention_w", week_sum("x_retention_day", ["Number of Customers", "Net Sales Amount", "Total number of Orders"]))
_WKC = "year_month_day as week_commencing_date, product_pl, region, category, sub_category"
cte("x_retention_week", mart_rows(f"""
select {_WKC}, metric_name, metric_value from x_lifecycle_week
union all select {_WKC}, metric_name, metric_value from x_lifecycle_rates_week
union all select {WK}, metric_name, metric_value from x_retention_w
union all {ratio_join('x_retention_w', 'week_commencing_date, product_pl, region', 'Transactions per Customer', 'Total number of Orders', 'Number of Customers', [*SUPPLY_ON, 'sub_category'], category="'Frequency'")}""", "WEEK"))
GROWTH = [f"28d {t} Person {x}" for _, t in STAGE.values() for x in ("Count", "NTS Amount", "moved to Retained", "moved to Churned")] + [
    "28d Active Customers", "28d Active Person NTS Amount", "28d Person moved Active to Inactive"]
cte("x_retention_y", ytd("x_retention_week", GROWTH + ["Number of Customers", "Net Sales Amount", "Total number of Orders"]))
cte("x_retention_fytd", mart_rows(f"""
select {YFULL}, metric_name, metric_value from x_retention_y
union all {ratio_join('x_retention_y', YTD_COLS, 'Transactions per Customer', 'Total number of Orders', 'Number of Customers', [*YTD_ON, 'sub_category'], category="'Frequency'")}""", "FYtD"))

for _mart in ("acquisition", "conversion", "monetisation", "retention", "supply"):
    cte(f"x_{_mart}_mart", f"select * from x_{_mart}_day union all select * from x_{_mart}_week union all select * from x_{_mart}_fytd")

# --- budget ----------------------------------------------------------------------------------

cte("x_weekday_weights", f"""
with edge as (select min(report_week_commencing) as lo, max(report_week_ending) as hi from x_plan_calendar
   where report_date in (date '2001-08-01', date '2001-02-01')),
 daily as (select c.day_of_reporting_week as dow, l.year_month_day, {total('m_net_sales_amount_gbp')} as net
   from x_order_lines l join x_plan_calendar c on c.report_date = l.year_month_day, edge where l.year_month_day between edge.lo and edge.hi group by all),
 per_dow as (select dow, cast(sum(net) as double) / count(*) as avg_dow from daily group by dow)
select dow, avg_dow / ((select cast(sum({dec('avg_dow', 8)}) as double) from per_dow) / 7e0) as ratio from per_dow""")
_cents = lambda x: f"cast(round(cast({x} as decimal(38,9)), 2) as decimal(38,2))"
_share = lambda x: _cents(f"(({dbl(x)} * w.ratio) / d.days)")
cte("x_budget_day", f"""
select 'DAY' as date_scope, b.version, c.report_date as year_month_day, c.week_in_fin_year, c.report_week_commencing as week_commencing_date,
 case b.region when 'ROE' then 'RoE' when 'ROW' then 'Inbound' when 'Unknown' then 'France' else b.region end as region,
 {_share('gross_sales_budget')} as gross_sales_budget, {_share('net_sales_budget')} as net_sales_budget, {_share('new_customers_budget')} as new_customers_budget,
 {_share('gross_transactions_budget')} as gross_transactions_budget,
 {_cents(div0('gross_sales_budget', 'gross_transactions_budget'))} as average_transaction_value_budget,
 {_share('performance_marketing_spend_budget')} as marketing_spend_budget, {_share('total_revenue_budget')} as total_revenue_budget,
 {_share('total_costs_budget')} as total_costs_budget, {_share('total_revenue_budget + total_costs_budget')} as gross_margin_budget,
 {_share('total_revenue_budget + total_costs_budget - performance_marketing_spend_budget')} as gm_minus_pms_budget
from x_monthly_budget b left join x_plan_calendar c on strftime(c.report_date, '%Y-%m') = b.year_month
 left join (select strftime(report_date, '%Y-%m') as ym, max(day_of_month) as days from x_plan_calendar group by 1) d on d.ym = b.year_month
 left join x_weekday_weights w on w.dow = c.day_of_reporting_week
where b.region in ('France','Germany','ROW','Italy','ROE','Spain','UK>EU','United Kingdom')""")
_kept = lambda x: f"cast(({x}) * whole as decimal(38,2))"
cte("x_budget_week", f"""
with w as (select version, week_commencing_date, week_in_fin_year, region, case when sum(case when gross_sales_budget = 0 then 0 else 1 end) = 7 then 1 else 0 end as whole,
  {', '.join(f'sum({c}_budget) as {c}' for c in ('gross_sales', 'net_sales', 'new_customers', 'gross_transactions', 'marketing_spend', 'total_revenue', 'total_costs'))}
  from x_budget_day group by 1, 2, 3, 4)
select 'WEEK' as date_scope, version, w.week_commencing_date as year_month_day, week_in_fin_year, w.week_commencing_date, region,
 {', '.join(f'{_kept(c)} as {c}_budget' for c in ('gross_sales', 'net_sales', 'new_customers', 'gross_transactions'))},
 {_cents(div0('gross_sales * whole', 'gross_transactions'))} as average_transaction_value_budget,
 {', '.join(f'{_kept(c)} as {c}_budget' for c in ('marketing_spend', 'total_revenue', 'total_costs'))},
 {_kept('total_revenue + total_costs')} as gross_margin_budget, {_kept('total_revenue + total_costs - marketing_spend')} as gm_minus_pms_budget
from w join x_calendar c on c.date_scope = 'WEEK' and c.week_commencing_date = w.week_commencing_date""")
