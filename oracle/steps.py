"""DuckDB statements of the source profiles, single metrics, steps and stored tables."""

from __future__ import annotations

import oracle.marts as m
import oracle.reports  # noqa: F401
from oracle.base import OUT, dbl, div0, fan, longform, pick, round4, total
from tidemark.sources.fixtures import KPIS
from tidemark.sources.profile import PROFILES

DPR = "year_month_day, product_pl, region"
LABELLED = f"{DPR}, category, sub_category, metric_name, metric_value"
ALLALL = "'All' as category, 'All' as sub_category"
STEPS: dict[str, str] = {}

for _t, _p in PROFILES.items():
    _cols = [*_p.by, "count(*) as records", *[f"cast({total(c)} as double) as total_{c}" for c in _p.amounts], *[f"sum({c}) as total_{c}" for c in _p.counts]]
    STEPS[f"source_{_t}"] = f"select {', '.join(_cols)} from x_{_t} group by {', '.join(_p.by)}"

_single = {"total_revenue": ("Total Revenue", pick("all")), "fee_revenue": ("Fee Revenue", pick("fees")), "non_fee_revenue": ("Non-Fee Revenue", m.NON_FEE),
           "gross_transactions": ("Gross Transactions", "orders"), "fee_revenue_per_transaction": ("Fee Revenue / Transaction", round4(div0(pick("fees"), "orders")))}
for _n, (_metric, _v) in _single.items():
    STEPS[f"single_{_n}"] = f"select *, {ALLALL} from ({longform('x_line_extract', DPR, {_metric: _v})}) s"
for _n, _metric in (("revenue", "Revenue"), ("reach", "Impressions"), ("ctr", "CTR"), ("quality", "CPM")):
    STEPS[f"single_ads_{_n}"] = f"select {LABELLED} from x_ads_metrics where metric_name = '{_metric}'"
_growth = f"""(select g.year_month_day, {OUT}, {', '.join([f"sum({k}_{c}) as {k}_{c}" for k in ('el', 'ret', 'res') for c in ('volume', 'retention', 'churned')] + [f"{total(f'{k}_nts_{c}')} as {k}_nts_{c}" for k in ('el', 'ret', 'res') for c in ('gbp', 'eur')])}
 from x_growth_summary g {fan('g.product_pl', 'g.region')} where date_scope = 'DAY' group by all)"""
_pairs = []
for _cat, _c in (("Volume", "volume"), ("Retention", "retention"), ("Churn", "churned"), ("Sales GBP", "nts_gbp"), ("Sales EUR", "nts_eur")):
    for _stage, _k in (("Early Life", "el"), ("Retained", "ret"), ("Resurrected", "res")):
        _pairs.append((f"'{_cat}' as category, '{_stage}' as sub_category", f"{_k}_{_c}"))
    if _cat != "Retention":
        _pairs.append((f"'{_cat}' as category, 'Active' as sub_category", f"el_{_c} + ret_{_c} + res_{_c}"))
STEPS["single_lifecycle_by_currency"] = longform(_growth, DPR, _pairs)

_sub_raw = m.SUB_CATEGORY.replace("coalesce(sub_channel, 'Unknown')", "sub_channel")
STEPS["label_campaigns"] = f"select kpi, channel, sub_channel, channel_source, device, {m.CATEGORY} as category, {_sub_raw} as sub_category, count(*) as records from x_marketing group by all"
STEPS["label_payback_channels"] = """select channel_0, case when channel_0 in ('Organic Search','App Organic') then 'Organic Last Click' else 'Paid Last Click' end as category,
 case channel_0 when 'Organic Search' then channel_1 when 'App Organic' then 'App - Organic' when 'Affiliates' then 'Affiliates' else 'Others' end as sub_category, count(*) as records from x_payback group by all"""
STEPS["label_journeys"] = """select year_month_day,
 coalesce(case when product_pl_code = 'UK' or order_region_name = 'UK' then fare_train_classification_name_longest_duration else product_train_speed_code end, 'unknown') as journey_type,
 case when fare_train_classification_name_longest_duration = 'long distance' and product_travel_classification_name = 'Leisure' then 'Leisure and Long Distance'
  when fare_train_classification_name_longest_duration = 'regional' and product_travel_classification_name = 'Commuting' then 'Commute and Regional' end as journey_class, count(*) as records
 from x_order_lines group by all"""
_wk = lambda d: f"date_trunc('week', {d} + 1)"
STEPS["label_new_customers"] = f"""select year_month_day, product_pl, region, count(*) as purchases, sum(is_new) as new_purchases from (
 select distinct l.year_month_day, l.order_customer_id, l.product_pl_code as product_pl, l.order_region_name as region,
  cast(coalesce(case when l.product_pl_code = 'UK' then {_wk('a.person_first_uk_transaction_date')} = {_wk('l.product_issued_date')}
   else {_wk('a.person_first_eu_transaction_date')} = {_wk('l.product_issued_date')} and a.person_first_eu_transaction_order_region = l.order_region_name end, false) as integer) as is_new
 from x_lines l join x_customer_accounts a on a.customer_id = l.order_customer_id where l.product_gross_sales_flag = 'Y') z group by all"""
STEPS["filter_qualifying_lines"] = "select year_month_day, product_type_code, source_system, order_managed_group_id, count(*) as records from x_lines group by all"
STEPS["filter_outage_days"] = "select event_date, count(*) as records from x_web_events where not (event_date >= date '2024-01-10' and event_date <= date '2024-01-12') group by all"
STEPS["join_region_fanout"] = f"select year_month_day, {OUT}, count(*) as records from x_order_lines {fan('product_pl_code', 'order_region_name')} group by all"
STEPS["join_calendar"] = """select financial_year, week_number, week_commencing_date, count(*) as records from x_order_lines l join x_calendar c using (year_month_day)
 where c.date_scope = 'DAY' group by all"""
STEPS["join_origin_country"] = """select country_code as origin, country_name, product_pl, region, sum(m_search_result_journey_count) as journeys
 from x_journey_searches join x_countries on country_code = string_split(search_odpair_country_name, ' - ')[1] group by all"""
STEPS["join_booking_countries"] = "select * from x_bookings"
STEPS["join_exchange_rates"] = "select * from x_commissions"
STEPS["join_budget_regions"] = f"select *, {ALLALL} from ({m.PLAN_ROWS}) p"
STEPS["join_margin_and_spend"] = f"""select *, margin - spend as margin_after_spend from (select {DPR}, {dbl(pick('revenue', 'a.product_pl'))} as revenue, {dbl(pick('costs', 'a.product_pl'))} as costs,
 {dbl(pick('revenue', 'a.product_pl') + ' - ' + pick('costs', 'a.product_pl'))} as margin, {dbl(pick('spend', 's.product_pl'))} as spend from x_margins a join x_spend s using ({DPR})) z"""
STEPS["join_visits"] = f"select {DPR}, {dbl('all_gbp - fees_gbp')} as non_fee_gbp, {dbl('all_eur - fees_eur')} as non_fee_eur, {dbl('visits')} as visits from x_line_extract join x_visits using ({DPR})"
STEPS["count_orders"] = f"select {DPR}, orders from x_line_extract"
for _n, _p in (("week", "financial_year, week_commencing_date"), ("year", "financial_year")):
    STEPS[f"rollup_orders_{_n}"] = f"""select {_p}, {OUT}, count(distinct case when product_gross_sales_flag = 'Y' and record_type = 'SALES' then order_id end) as orders
     from x_lines l join (select year_month_day, {_p} from x_calendar where date_scope = 'DAY') c using (year_month_day) {fan('product_pl_code', 'order_region_name')} group by all"""
for _period, _src in (("day", "x_customers_daily"), ("week", "x_customers_weekly")):
    _col = "year_month_day" if _period == "day" else "week_commencing_date"
    STEPS[f"count_customers_{_period}"] = f"""select {_col}, product_pl, region, count(distinct case when is_new then person_id end) as new_customers,
     count(distinct case when not is_new then person_id end) as existing_customers, count(distinct person_id) as active_customers from {_src} group by all"""
STEPS["count_web_events"] = "select * from x_web_counts"
_names = {"total": "all", "fees": "fees", "net_sales": "net", "booking_fee": "booking", "refund_fee": "refund", "coj_fee": "coj", "commission": "commission", "ancillary": "insurance", "mcp": "mcp"}
STEPS["sum_line_extract"] = f"""select {DPR}, tickets, booking_tickets as booking_fee_tickets, refund_tickets as refund_fee_tickets, coj_tickets as coj_fee_tickets, mcp_tickets,
 {', '.join(f"{dbl(f'{k}_{c}')} as {n}_{c}" for n, k in _names.items() for c in ('gbp', 'eur'))}, {', '.join(f"{dbl(f'all_{c} - fees_{c}')} as non_fee_{c}" for c in ('gbp', 'eur'))} from x_line_extract"""
STEPS["sum_journey_classes"] = f"select {DPR}, sub_category, customers, orders, {dbl('sales')} as sales from x_journey_classes_sum where sub_category <> 'All'"
STEPS["latest_ad_rows"] = """select event_date, event_line_item_name, count(*) as records, sum(revenue_micros) as micros, cast(max(header_eventtime) as varchar) as latest from x_ad_rows group by all"""
STEPS["pivot_campaign_kpis"] = f"""select activity_date, {', '.join(f"cast(sum(case when kpi = '{k}' then cast(value as decimal(18,7)) end) as double) as {k.lower().replace(' ', '_')}" for k in KPIS)}
 from x_marketing group by 1"""
STEPS["unpivot_weekly_budget"] = m._supply_budget
_attrs = ("order_region_name", "record_type", "product_train_speed_code")
STEPS["level_sets"] = f"""select year_month_day, {', '.join(f"case when grouping({c}) = 1 then 'All' else {c} end as {c}" for c in _attrs)}, count(*) as records, count(distinct order_id) as orders
 from (select year_month_day, order_id, {', '.join(f"coalesce({c}, 'Unknown') as {c}" for c in _attrs)} from x_lines) l group by year_month_day, cube ({', '.join(_attrs)})"""
STEPS["window_running_year"] = "select * from x_supply_y where metric_name not like '%Budget'"
STEPS["window_previous_present"] = f"""select {DPR}, category, sub_category, metric_name, metric_value,
 lag(metric_value) over (partition by product_pl, region, category, sub_category, metric_name order by year_month_day) as previous from x_growth_day"""
STEPS["window_week_numbers"] = "select * from x_breakout_weeks"
STEPS["weights_by_weekday"] = "select dow as day_of_reporting_week, ratio from x_weekday_weights"
STEPS["sum_weeks"] = m.week_sum("x_conversion_day", ["Gross Sales", "WBR Gross Transactions", "Total Visits", "Transactions Tracked"])
STEPS["report_overview_with_future"] = """select * from x_overview union all
select s.date_scope, s.product_pl, s.region, c.financial_year, c.week_number, c.year_month_day, c.week_commencing_date, upper(replace(s.metric_name, '_', ' ')), null, null, null, null, null
from (select distinct date_scope, product_pl, region, metric_name from x_overview_base where metric_name not like '%Budget%') s,
 (select distinct financial_year, week_number, year_month_day, week_commencing_date from x_calendar where year_month_day > date '2025-12-01' and week_commencing_date > date '2025-12-01') c"""
STEPS["stored_supply_mart"] = "select * from x_supply_mart"
STEPS["stored_carried_years"] = "select * from x_supply_mart where date_scope = 'FYtD'"
STEPS["stored_checks"] = """select week_commencing_date, count(*) * t as records, (t - 1) * count(*) as repeated_keys, t = 2 as failed, run
from x_supply_day join (values (1, 1), (3, 2), (4, 1)) r(run, t) on run = 1 or week_commencing_date = date '1998-05-03' group by week_commencing_date, run, t"""
STEPS["stored_late_rows"] = "select * from x_retention_day where year_month_day between date '1999-03-28' and date '1999-05-15'"
STEPS["stored_overview_report"] = "select * from x_overview"
STEPS["stored_breakout_report"] = "select * from x_breakout"
STEPS["stored_dashboard"] = "select * from x_dashboard"
_mart_cols = "date_scope, financial_year, week_number, year_month_day, week_commencing_date, product_pl, region, category, sub_category, metric_name"
STEPS["stored_drift"] = f"""select {_mart_cols}, case when year(year_month_day) = 1999 and region = 'France' then metric_value + 1 else metric_value end as metric_value,
 case when year(year_month_day) = 1999 then cast(length(metric_name) as integer) end as name_length from x_supply_day"""
