"""The DuckDB statement of every query that has one."""

from __future__ import annotations

import oracle.checks
import oracle.marts
import oracle.reports
import oracle.steps
from oracle.base import assemble
from tidemark.schema import BUDGET_KEY, BUDGET_MEASURES

STATEMENTS: dict[str, str] = {}


def statement(name: str, sql: str) -> None:
    STATEMENTS[name] = assemble(sql)


METRIC_COLUMNS = "year_month_day, product_pl, region, category, sub_category, metric_name, metric_value"
UNLABELLED = "year_month_day, product_pl, region, metric_name, metric_value"

for _mart in ("acquisition", "conversion", "monetisation", "retention", "supply"):
    for _scope in ("day", "week", "fytd"):
        statement(f"{_mart}_mart_{_scope}", f"select * from x_{_mart}_{_scope}")
_budget = ", ".join([*BUDGET_KEY, *[f"cast({c} as double) as {c}" for c in BUDGET_MEASURES]])
for _scope in ("day", "week"):
    statement(f"budget_mart_{_scope}", f"select {_budget} from x_budget_{_scope}")

FAMILIES = {
    "acquisition_metrics": "x_acquisition_metrics", "payback_months": "x_payback_months", "customer_metrics_day": "x_customer_metrics_day",
    "revenue_metrics": "x_revenue_metrics", "non_fee_revenue_per_visit": "x_per_visit", "total_visits": "x_total_visits",
    "ads_metrics": "x_ads_metrics", "hotel_bookings": "x_hotel_bookings", "hotel_revenue": "x_hotel_revenue",
    "hotel_web_metrics": "x_hotel_web_metrics", "transaction_metrics": "x_transaction_metrics",
    "user_journey_metrics": "x_journey_metrics", "growth_day": "x_growth_day", "growth_week": "x_growth_week",
}
for _name, _cte in FAMILIES.items():
    statement(f"metrics_{_name}", f"select {METRIC_COLUMNS} from {_cte}")
statement("metrics_monetisation_metrics", f"select {METRIC_COLUMNS} from x_monetisation_metrics where metric_value is not null")
statement("metrics_sales_metrics", f"select {UNLABELLED} from ({oracle.marts.SALES_ROWS}) s")
statement("metrics_journey_search_metrics", f"select {UNLABELLED} from ({oracle.marts.SEARCH_ROWS}) s")

statement("report_breakout", "select * from x_breakout")
statement("report_overview", "select * from x_overview")
statement("report_dashboard", "select * from x_dashboard")

for _name, _sql in oracle.checks.CHECKS.items():
    statement(f"check_{_name}", _sql)
for _name, _sql in oracle.steps.STEPS.items():
    statement(_name, _sql)
statement("stored_budget_mart", f"select {_budget} from x_budget_day union all select {_budget} from x_budget_week")
_undated = _budget
for _c in ("year_month_day", "week_in_fin_year", "week_commencing_date"):
    _undated = _undated.replace(_c, f"null as {_c}")
statement("stored_undated_budget", f"select {_budget} from x_budget_day union all select {_undated} from x_budget_day where region in ('France', 'Germany')")
