"""DuckDB statements of the reports, as lagged self-joins and joined pivots."""

from __future__ import annotations

from oracle.base import cte

LIFECYCLE = "(metric_name like '28d%' or metric_name like '% over %')"
HABITS = "'Number of Customers','Net Sales Amount','Transactions per Customer'"
PARTS = {
    "breakout": {
        "acquisition": "true", "monetisation": "true", "conversion": "true", "retention": f"{LIFECYCLE} or metric_name in ({HABITS})", "supply": "true",
    },
    "overview": {
        "acquisition": "true",
        "monetisation": "metric_name in ('Fee Revenue / Transaction','Fee Revenue','Non-Fee Revenue / Visit','Non-Fee Revenue')",
        "conversion": "metric_name not in ('Gross Sales','Gross Sales Budget')",
        "retention": f"{LIFECYCLE} or metric_name in ({HABITS},'Total number of Orders')",
        "supply": "true",
    },
}
for _report, _parts in PARTS.items():
    cte(f"x_{_report}_rows", " union all ".join(
        f"select '{m}_mart' as metric_mart_name, m.* from x_{m}_mart m where {cond}" for m, cond in _parts.items()))
    cte(f"x_{_report}_weeks", f"select week_commencing_date, row_number() over (order by week_commencing_date) as week_seq from (select distinct week_commencing_date from x_{_report}_rows) w")
cte("x_breakout_base", "select r.*, w.week_seq from x_breakout_rows r join x_breakout_weeks w using (week_commencing_date)")
cte("x_overview_base", f"""
select distinct r.date_scope, r.financial_year, r.week_number, r.year_month_day, r.week_commencing_date, r.product_pl, r.region, w.week_seq,
 case when r.metric_mart_name = 'acquisition_mart' and r.metric_name = 'Total Visits' then 'Acquisition Visits' else r.metric_name end as metric_name, r.metric_value
from x_overview_rows r join x_overview_weeks w using (week_commencing_date)
where (r.metric_mart_name = 'retention_mart' and {LIFECYCLE}) or (r.category = 'All' and r.sub_category = 'All')""")


def compared(base: str, series: list[str]) -> str:
    def past(alias: str, weeks: int) -> str:
        on = " and ".join(f"t.{c} = {alias}.{c}" for c in series)
        return (f"left join {base} {alias} on {on} and t.week_seq = {alias}.week_seq + {weeks} and t.year_month_day = {alias}.year_month_day + {7 * weeks} "
                f"and t.week_commencing_date = {alias}.week_commencing_date + {7 * weeks}")

    ratio = lambda a: f"case when coalesce({a}.metric_value, 0) > 0 then (t.metric_value - {a}.metric_value) / {a}.metric_value else 0e0 end"
    cols = ", ".join(f"t.{c}" for c in series if c != "metric_name")
    return f"""select {cols}, t.financial_year, t.week_number, t.year_month_day, t.week_commencing_date, upper(replace(t.metric_name, '_', ' ')) as metric_name, t.metric_value,
 case when t.date_scope <> 'FYtD' then coalesce(t.metric_value - w.metric_value, 0e0) end as wow,
 case when t.date_scope <> 'FYtD' then {ratio('w')} end as wow_ratio,
 coalesce(t.metric_value - y.metric_value, 0e0) as yoy, {ratio('y')} as yoy_ratio
from {base} t {past('w', 1)} {past('y', 52)}"""


cte("x_breakout", compared("x_breakout_base", ["metric_mart_name", "date_scope", "product_pl", "region", "category", "sub_category", "metric_name"]))
cte("x_overview", compared("x_overview_base", ["date_scope", "product_pl", "region", "metric_name"]))

# Dashboard columns and the metric names of the overview
DASHBOARD = {
    "28_56_Day_Churned_Customers": "28d Person moved Active to Inactive", "28_56_Day_New_Customers": "28d Early life Person Count",
    "28_56_Day_Resurrected_Customers": "28d Resurrected Person Count", "28_56_Day_Retained_Customers": "28d Retained Person Count",
    "Cost_Per_Click": "Cost / Click", "Fee_Revenue_Per_Transaction": "Fee Revenue / Transaction", "GM_Minus_PMS": "GM - PMS",
    "Non_Fee_Revenue_Per_Visit": "Non-Fee Revenue / Visit", "Non_Fee_Revenue": "Non-Fee Revenue",
    "Gross_Sales": "WBR Gross Sales", "Gross_Transactions": "WBR Gross Transactions", "Net_Sales": "WBR Net Sales",
    **{n.replace(" ", "_"): n for n in (
        "Active Customers", "Avg Trans Value", "Conversion Ratio", "Existing Customers", "Fee Revenue", "Gross Margin",
        "Marketing Spend", "New Customers", "Total Clicks", "Total Costs", "Total Impressions",
        "Total Refunds", "Total Revenue", "Total Visits", "Transactions Tracked")},
}
_key = "financial_year, week_number, year_month_day, week_commencing_date, product_pl, region"


def _cell(scope: str, suffix: str, name: str) -> str:
    hide = " and region <> 'UK>EU'" if suffix == "Non_Fee_Revenue_Per_Visit" else ""
    return f"max(case when metric_name = '{name.upper()}'{hide} then metric_value end) as \"{scope}_{suffix}\""


for _scope in ("DAY", "WEEK", "FYtD"):
    cells = ", ".join(_cell(_scope, s, n) for s, n in DASHBOARD.items())
    cte(f"x_wide_{_scope.lower()}", f"select {_key}, {cells} from x_overview where date_scope = '{_scope}' and metric_name not like '%BUDGET%' group by {_key}")
cte("x_dashboard", f"select * from x_wide_day left join x_wide_week using ({_key}) left join x_wide_fytd using ({_key})")
