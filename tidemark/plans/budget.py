"""Budget mart: monthly budgets spread over days by weekday weight, and complete weeks of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.ratio import round_half_up, safe_ratio
from tidemark.functions.taxonomy import plan_region
from tidemark.operators.scopes import run_weeks
from tidemark.operators.spread import complete_weeks_only, spread_budget, weekday_weights
from tidemark.params import DAY, WEEK, MartConfig, RunParams
from tidemark.schema import BUDGET_DECIMAL, BUDGET_KEY, BUDGET_MEASURES
from tidemark.sources.catalog import Sources

SPREAD = {
    "gross_sales_budget": "gross_sales_budget", "net_sales_budget": "net_sales_budget",
    "new_customers_budget": "new_customers_budget", "gross_transactions_budget": "gross_transactions_budget",
    "marketing_spend_budget": "performance_marketing_spend_budget", "total_revenue_budget": "total_revenue_budget",
    "total_costs_budget": "total_costs_budget",
}


def _finish(df: DataFrame, scope: str, p: RunParams) -> DataFrame:
    money = [round_half_up(F.col(c), 2).cast(BUDGET_DECIMAL).alias(c) for c in BUDGET_MEASURES]
    stamped = df.withColumns({"date_scope": F.lit(scope), "last_modified": F.lit(p.run_ts)})
    return stamped.select(*BUDGET_KEY, "last_modified", *money)


def budget_day(src: Sources, p: RunParams, cfg: MartConfig) -> DataFrame:
    monthly = src.monthly_budget.where(F.col("region").isin(*cfg.plan_regions))
    weights = weekday_weights(src.order_lines, src.plan_calendar, p.as_of)
    daily = spread_budget(monthly, src.plan_calendar, weights)
    share = lambda amount: F.try_divide(amount.cast("double") * F.col("ratio"), F.col("days_month").cast("double"))
    revenue, costs = F.col("total_revenue_budget"), F.col("total_costs_budget")
    margin = revenue + costs
    sales, orders = F.col("gross_sales_budget"), F.col("gross_transactions_budget")
    out = daily.select(
        "version",
        F.col("report_date").alias("year_month_day"),
        "week_in_fin_year",
        F.col("report_week_commencing").alias("week_commencing_date"),
        plan_region(F.col("region")).alias("region"),
        *[share(F.col(column)).alias(name) for name, column in SPREAD.items()],
        safe_ratio(sales, orders).alias("average_transaction_value_budget"),
        share(margin).alias("gross_margin_budget"),
        share(margin - F.col("performance_marketing_spend_budget")).alias("gm_minus_pms_budget"),
    )
    return _finish(out, DAY, p)


def budget_week(mart: DataFrame, src: Sources, p: RunParams, cfg: MartConfig) -> DataFrame:
    """Week totals of the daily rows of the run's weeks; a week without budget on each of its seven days is zero.

    FYtD runs of this mart write the same rows.
    """
    days = mart.where((F.col("date_scope") == DAY) & run_weeks(p))
    keys = ["version", "week_commencing_date", "week_in_fin_year", "region"]
    weekly = complete_weeks_only(days, keys, list(SPREAD), "gross_sales_budget")
    known_weeks = src.calendar.where(F.col("date_scope") == WEEK).select("week_commencing_date")
    whole = F.col("complete")

    def kept(amount: Column) -> Column:
        return amount * whole

    margin = F.col("total_revenue_budget") + F.col("total_costs_budget")
    out = weekly.join(known_weeks, "week_commencing_date").select(
        "version", "week_in_fin_year", "week_commencing_date", "region",
        F.col("week_commencing_date").alias("year_month_day"),
        *[kept(F.col(c)).alias(c) for c in SPREAD],
        safe_ratio(kept(F.col("gross_sales_budget")), F.col("gross_transactions_budget")).alias(
            "average_transaction_value_budget"
        ),
        kept(margin).alias("gross_margin_budget"),
        kept(margin - F.col("marketing_spend_budget")).alias("gm_minus_pms_budget"),
    )
    return _finish(out, WEEK, p)
