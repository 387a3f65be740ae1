"""DuckDB statements of the checks."""

from __future__ import annotations

import oracle.marts as m
from oracle.base import END, START, cte, dec, div, exact, money4, pick, round4, total

DPR = "year_month_day, product_pl, region"
CHECKS: dict[str, str] = {}
MARTS = ("acquisition", "conversion", "monetisation", "retention", "supply")
# KPI and metric names
KPI_METRIC = {"Clicks": "Total Clicks", "Impressions": "Total Impressions", "Installs": "Total Installs", "Visits": "Total Visits",
              "Incremental New Customers": "Incremental New Customers", "Incremental Spend EUR": "Incremental Spend EUR"}
cte("x_campaign_values", f"""
select year_month_day, year_month_day - cast(dayofweek(year_month_day) as integer) as week_commencing_date, product_pl, region, category, sub_category, metric_name, value
from (select c.*, case {' '.join(f"when kpi = '{k}' then '{v}'" for k, v in KPI_METRIC.items())}
   when kpi = 'Spend GBP' and product_pl = 'UK' or kpi = 'Spend EUR' and product_pl <> 'UK' then 'Marketing Spend'
   when kpi = 'Incremental Gross Sales GBP' and product_pl = 'UK' or kpi = 'Incremental Gross Sales EUR' and product_pl <> 'UK' then 'Incremental Gross Sales' end as metric_name
 from x_campaigns c) v where metric_name is not null""")


def _campaign(metrics: list[str], period: str, scope: str, labelled: bool, tolerance: int, how: str, by_line: bool = True) -> str:
    names = ", ".join(f"'{n}'" for n in metrics)
    keys = ", ".join([period, *(["product_pl"] if by_line else []), "region", *(["category", "sub_category"] if labelled else []), "metric_name"])
    level = "category <> 'All' and sub_category <> 'All'" if labelled else "category = 'All' and sub_category = 'All'"
    gap = "cast(abs(cast(round(mart_value) as bigint) - cast(round(source_value) as bigint)) as double)"
    return f"""select {keys}, mart_value, source_value, {gap} as difference, coalesce({gap} > {tolerance}, true) as failed
from (select {keys}, cast(sum({dec('metric_value', 8)}) as double) as mart_value from x_acquisition_mart
      where date_scope = '{scope}' and metric_name in ({names}) and {level} group by all) a
{how} join (select * from (select {keys}, cast({total('value')} as double) as source_value from x_campaign_values where metric_name in ({names}) group by all) z where source_value > 0) s
using ({keys})"""


_vol = list(KPI_METRIC.values())
WC, YMD = "week_commencing_date", "year_month_day"
CHECKS |= {
    "campaign_day": _campaign(_vol, YMD, "DAY", True, 0, "full"),
    "campaign_summary": _campaign(_vol, WC, "DAY", False, 1, "full", by_line=False),
    "campaign_week": _campaign(_vol[:5], WC, "WEEK", True, 1, "full"),
}
for _n, _metric in (("incremental_sales", "Incremental Gross Sales"), ("marketing_spend", "Marketing Spend")):
    CHECKS[f"{_n}_day"] = _campaign([_metric], YMD, "DAY", True, 1, "full")
    CHECKS[f"{_n}_summary"] = _campaign([_metric], WC, "WEEK" if _n == "incremental_sales" else "DAY", False, 1, "full")
    CHECKS[f"{_n}_week"] = _campaign([_metric], WC, "WEEK", True, 1, "full")
for _n, _metric in (("incremental_customers", "Incremental New Customers"), ("clicks", "Total Clicks"), ("impressions", "Total Impressions"), ("installs", "Total Installs")):
    CHECKS[f"{_n}_day"] = _campaign([_metric], YMD, "DAY", True, 0, "inner")
    CHECKS[f"{_n}_summary"] = _campaign([_metric], YMD, "DAY", False, 0, "inner")

BASE_LINE = """case when {p} is null and {r} is null or {p} = 'INT' then 'EU' else {p} end as product_pl,
 case when {p} is null and {r} is null then 'France' when {p} in ('EU','INT') and {r} = 'United Kingdom' then 'UK>EU'
  when {p} in ('EU','INT') and {r} = 'Unknown' then 'France' when {p} = 'UK' then 'United Kingdom' else {r} end as region"""


def _compare(source: str, stored: str, keys: str, tolerance: float) -> str:
    gap = "abs(mart_value - source_value)"
    return f"""select {keys}, mart_value, source_value, {gap} as difference, coalesce({gap} > {tolerance}e0, true) as failed
from ({stored}) a join ({source}) s using ({keys})"""


def _stored(where: str) -> str:
    return f"select {DPR}, metric_value as mart_value from x_monetisation_day where {where}"


cte("x_base_lines", f"select l.* exclude (product_pl_code, order_region_name), {BASE_LINE.format(p='product_pl_code', r='order_region_name')} from x_lines l where year_month_day between date '{START}' and date '{END}'")
_key = lambda fee: fee.lower().replace(" ", "_")
for _fee, (_k, _col, _tickets) in m.FEES.items():
    _gap = "where not (product_pl = 'EU' and year_month_day between date '1998-01-01' and date '1998-01-31')" if _fee == "Refund Fee" else ""
    _sums = f"""(select {DPR}, {', '.join(f"{total(f'{_col}_{c}')} as fee_{c}, {total(f'm_net_sales_amount_{c}')} as net_{c}" for c in ('gbp', 'eur'))} from x_base_lines {_gap} group by all)"""
    _where = lambda metric, fee=_fee: f"category = 'Trx' and sub_category = '{fee}' and metric_name = '{metric}'"
    CHECKS[f"{_key(_fee)}_take_rate"] = _compare(f"select {DPR}, {round4(div(pick('fee'), pick('net')))} as source_value from {_sums} z", _stored(_where("Take Rate")), DPR, 0)
    CHECKS[f"{_key(_fee)}_revenue"] = _compare(f"select {DPR}, {money4(pick('fee'))} as source_value from {_sums} z", _stored(_where("Revenue")), DPR, 0.001)
    if _tickets:
        _cov = f"select {DPR}, {round4(div(f'sum(case when {_col}_eur + {_col}_gbp > 0 then product_number_of_tickets end)', 'sum(product_number_of_tickets)'))} as source_value from x_base_lines group by {DPR}"
        CHECKS[f"{_key(_fee)}_coverage"] = _compare(_cov, _stored(_where("Percent of Tickets")), DPR, 0)
_paid = "sum(case when lower(event_line_item_name) not like '%house%' then impressions end)"
for _metric, _value, _tol in (
    ("CPM", round4(f"(sum(revenue_micros) / 1e6) / nullif({_paid} / 1e3, 0)"), 0), ("CTR", round4(div("sum(clicks)", "sum(impressions)")), 0),
    ("Impressions", "cast(sum(impressions) as double)", 0.001), ("Revenue", round4("sum(revenue_micros) / 1e6"), 0.001),
):
    _src = f"select event_date as year_month_day, pl.product_pl, pl.region, {_value} as source_value from x_ad_rows, (values ('UK','United Kingdom'),('UK & EU','Total')) as pl(product_pl, region) group by 1, 2, 3"
    CHECKS[f"ads_{_metric.lower()}"] = _compare(_src, _stored(f"sub_category = 'Ads' and metric_name = '{_metric}'"), DPR, _tol)
_partner = lambda metric: _stored(f"sub_category = 'Partnerships-booking.com' and metric_name = '{metric}'")
CHECKS["hotel_bookings"] = _compare(f"select {DPR}, cast(count(distinct booking_id) as double) as source_value from x_bookings group by all", _partner("No. of Hotel Bookings"), DPR, 0)
CHECKS["hotel_ctr"] = _compare(f"select {DPR}, {round4(div('clicks', 'shown'))} as source_value from x_web_counts", _partner("CTR"), DPR, 0.0001)
CHECKS["hotel_impressions"] = _compare(f"select {DPR}, cast(shown as double) as source_value from x_web_counts", _partner("Impressions"), DPR, 0)


def _sides(stored: str, source: str, measures: list[str], judged: list[str], bad: str = "") -> str:
    cols = ", ".join(f"a.{c} as mart_{c}, cast(s.{c} as double) as source_{c}" for c in measures)
    bad = bad or " or ".join(f"coalesce(a.{c} <> cast(s.{c} as double), false)" for c in judged)
    return f"select {DPR}, {cols}, ({bad}) as failed from ({stored}) a join ({source}) s using ({DPR})"


def _picked(names: dict[str, str]) -> str:
    return ", ".join(f"max(case when metric_name = '{n}' then metric_value end) as {c}" for c, n in names.items())


for (_stage, (_k, _title)), (_scope, _shift) in [(x, y) for x in m.STAGE.items() for y in (("DAY", 0), ("WEEK", 1))]:
    _names = {"customers": f"28d {_title} Person Count", "net_sales": f"28d {_title} Person NTS Amount",
              "retained": f"28d {_title} Person moved to Retained", "churned": f"28d {_title} Person moved to Churned"}
    _source = f"""select {DPR}, customers, retained, churned, {money4(pick('amount'))} as net_sales from (
      select year_month_day - {_shift} as year_month_day, {BASE_LINE.format(p='product_pl', r='region')}, sum({_k}_volume) as customers, sum({_k}_retention) as retained, sum({_k}_churned) as churned,
       {total(f'{_k}_nts_gbp')} as amount_gbp, {total(f'{_k}_nts_eur')} as amount_eur from x_growth_summary g
      where date_scope = '{_scope}' and year_month_day between date '{START}' and date '{END}' + 1 group by 1, 2, 3) z"""
    _st = f"select {DPR}, {_picked(_names)} from x_retention_{_scope.lower()} where sub_category = '{_stage}' and year_month_day between date '{START}' and date '{END}' group by all"
    CHECKS[f"lifecycle_{_key(_stage)}{'_week' if _shift else ''}"] = _sides(_st, _source, list(_names), list(_names))
_habits = {"customers": "Number of Customers", "net_sales": "Net Sales Amount", "orders": "Total number of Orders"}
_leisure = "fare_train_classification_name_longest_duration = 'long distance' and product_travel_classification_name not in ('Commuting','Business')"
_commute = "fare_train_classification_name_longest_duration = 'regional' and product_travel_classification_name = 'Commuting'"
for _n, _label, _cond in (("commute", "Commute and Regional", _commute), ("leisure", "Leisure and Long Distance", _leisure), ("summary", "All", f"(({_leisure}) or ({_commute}))")):
    _source = f"""select {DPR}, customers, orders, {money4(pick('amount'))} as net_sales from (select {DPR}, count(distinct order_customer_id) as customers,
      count(distinct case when product_gross_sales_flag = 'Y' and record_type = 'SALES' then order_id end) as orders,
      {total('m_net_sales_amount_gbp')} as amount_gbp, {total('m_net_sales_amount_eur')} as amount_eur from x_base_lines where {_cond} group by all) z"""
    _st = f"select {DPR}, {_picked(_habits)} from x_retention_day where sub_category = '{_label}'{' and category = ' + chr(39) + 'All' + chr(39) if _n == 'summary' else ''} group by all"
    CHECKS[f"journey_{_n}_coarse"] = _sides(_st, _source, list(_habits), [], "coalesce(abs(a.net_sales - s.net_sales) * 100e0 / nullif(s.net_sales, 0) > 0.2, false)")
    CHECKS[f"journey_{_n}"] = _sides(_st, _source, list(_habits), ["net_sales"] if _n == "summary" else list(_habits))

_skip = {
    "acquisition": "metric_name not in ('Active Customers','Existing Customers','New Customers','Incremental ROAS','CPA','CVR','LC_CPA','Cost / Click','Payback Months')",
    "conversion": "metric_name not in ('Avg Trans Value','Avg Trans Value Budget','Conversion Ratio')",
    "monetisation": "metric_name not in ('Non-Fee Revenue / Visit','CTR','CPM','Percent of Tickets','Take Rate','Fee Revenue / Transaction')",
    "retention": "lower(metric_name) not like '% over %'", "supply": "metric_name not in ('Refunds Ratio','Unsellable Journey Ratio')",
}
for _mart in MARTS:
    _k5 = "date_scope, year_month_day, category, sub_category, metric_name"
    _series = "category, sub_category, metric_name, financial_year"
    _ft = f"select {_k5}, financial_year, week_commencing_date, region, metric_value from x_{_mart}_mart where product_pl = 'EU' and region in ('Foreign Travel','Inbound','RoE','UK>EU') and {_skip[_mart]}"
    # a running total stays what it was in the weeks in which its region has no row
    _held = f"""select {_k5}, region, last_value(metric_value ignore nulls) over (partition by {_series}, region order by year_month_day rows between unbounded preceding and current row) as metric_value
 from (select distinct {_k5}, financial_year, r.region from ft cross join (values ('Foreign Travel'),('Inbound'),('RoE'),('UK>EU')) r(region) where date_scope = 'FYtD') g
 left join ft using ({_k5}, financial_year, region)"""
    CHECKS[f"foreign_travel_{_mart}"] = f"""select {_k5}, parts, foreign_travel, abs(parts - foreign_travel) as difference,
 case when parts is null then 'no parts' when foreign_travel is null then 'no foreign travel' when lacks then 'parts lacking' else 'compared' end as status,
 coalesce(abs(parts - foreign_travel) > 10 and not lacks, false) as failed
from (with ft as ({_ft}), short_days as (
  select year_month_day, week_commencing_date from ft where date_scope = 'DAY' and metric_name = 'GM - PMS' group by all having count(*) filter (where region <> 'Foreign Travel') < 3
), short_years as (
  select financial_year, min(year_month_day) as since from ft where date_scope = 'WEEK' and metric_name = 'GM - PMS' and year_month_day in (select week_commencing_date from short_days) group by 1
), weeks as (select distinct year_month_day, financial_year from ft where date_scope = 'WEEK' and metric_name = 'GM - PMS'
), held as (select {_k5}, region, metric_value from ft where date_scope <> 'FYtD' union all {_held})
 select {_k5}, {exact('sum(case when region <> ' + chr(39) + 'Foreign Travel' + chr(39) + ' then ' + dec('metric_value', 8) + ' end)')} as parts,
  max(case when region = 'Foreign Travel' then metric_value end) as foreign_travel,
  metric_name = 'GM - PMS' and (date_scope = 'DAY' and year_month_day in (select year_month_day from short_days)
   or date_scope = 'WEEK' and year_month_day in (select week_commencing_date from short_days)
   or date_scope = 'FYtD' and year_month_day in (select w.year_month_day from weeks w join short_years y using (financial_year) where w.year_month_day >= y.since)) as lacks
  from held group by all) s order by difference desc nulls last, {_k5}"""
for _c in ("category", "sub_category"):
    CHECKS[f"{_c}_completeness"] = f"""select n as nulls, r as records, coalesce(n / nullif(r, 0) > 0.10, false) as failed
from (select count(*) filter (where {_c} is null) as n, count(*) as r from x_supply_day) z"""
_keys = "date_scope, financial_year, week_number, year_month_day, week_commencing_date, product_pl, region, category, sub_category, metric_name"
_tables = {f"{x}_mart": (f"x_{x}_mart", _keys) for x in MARTS} | {
    "budget_mart": ("(select * from x_budget_day union all select * from x_budget_week)", "date_scope, version, year_month_day, week_in_fin_year, week_commencing_date, region"),
    "breakout_report": ("x_breakout", "metric_mart_name, " + _keys),
    "overview_status": ("x_overview", _keys.replace("category, sub_category, ", "")),
}
CHECKS["unique_keys"] = " union all ".join(
    f"select '{n}' as table_name, sum(c) as records, count(*) as distinct_keys, count(*) filter (where c > 1) as repeated_keys from (select {k}, count(*) as c from {t} q group by {k}) z"
    for n, (t, k) in _tables.items())
CHECKS["not_null"] = " union all ".join(
    f"select '{x}_mart' as table_name, count(*) as records, '{c}' as column_name, count(*) - count({c}) as nulls, count(*) > count({c}) as failed from x_{x}_mart"
    for x in MARTS for c in ("metric_name", "week_commencing_date", "product_pl", "region", "category", "sub_category"))
# regions
_regions = "'France','Germany','Inbound','International','Italy','RoE','Spain','UK>EU','Foreign Travel','Total','United Kingdom'"
CHECKS["accepted_regions"] = " union all ".join(
    f"select region as value, count(*) as records, '{x}_mart' as table_name, region not in ({_regions}) as failed from x_{x}_mart group by region" for x in MARTS)
CHECKS["accepted_product_lines"] = " union all ".join(
    f"select product_pl as value, count(*) as records, '{x}_mart' as table_name, product_pl not in ('EU','UK','UK & EU') as failed from x_{x}_mart group by product_pl" for x in MARTS)
_written = {"breakout_report": ("x_breakout", True), "overview_status": ("x_overview", False)}
CHECKS["not_null_this_run"] = CHECKS["not_null"]  # one run writes all rows here
CHECKS["not_null_reports"] = " union all ".join(
    f"select '{n}' as table_name, count(*) as records, '{c}' as column_name, count(*) - count({c}) as nulls, count(*) > count({c}) as failed from {t}"
    for n, (t, labelled) in _written.items() for c in ("metric_name", "week_commencing_date", "product_pl", "region", *(("category", "sub_category") if labelled else ())))
for _c, _ok in (("region", _regions), ("product_pl", "'EU','UK','UK & EU'")):
    CHECKS["accepted_" + ("regions" if _c == "region" else "product_lines") + "_reports"] = " union all ".join(
        f"select {_c} as value, count(*) as records, '{n}' as table_name, {_c} not in ({_ok}) as failed from {t} group by {_c}" for n, (t, _) in _written.items())
CHECKS["region_count"] = " union all ".join(
    f"select '{x}_mart' as table_name, count(distinct region) as distinct_values, count(distinct region) <> 11 as failed from x_{x}_mart" for x in MARTS)


def _report(report: str, where: str, extra: list[str], mart_where: str, name: str) -> str:
    on = " and ".join(f"r.{c} = a.{c}" for c in ["date_scope", "year_month_day", "product_pl", "region", *extra])
    return f"""select date_scope, metric, count(*) as compared, sum(cast(bad as integer)) as failures from (
  select r.date_scope, upper(r.metric_name) as metric, coalesce(cast(round(r.metric_value) as bigint) <> cast(round(a.metric_value) as bigint), false) as bad
  from {report} r left join (select *, upper({name}) as metric from x_acquisition_mart where {mart_where}) a on {on} and upper(r.metric_name) = a.metric
  where r.year_month_day between date '{START}' and date '{END}' and {where}) z group by all"""


CHECKS["breakout_values"] = _report("x_breakout", "r.metric_mart_name = 'acquisition_mart'", ["category", "sub_category"], "true", "metric_name")
CHECKS["overview_values"] = _report("x_overview", "true", [], "category = 'All' and sub_category = 'All'",
                                    "case when metric_name = 'Total Visits' then 'Acquisition Visits' else metric_name end")
