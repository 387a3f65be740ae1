"""Table layouts: the long metric mart, the reports built on it, and the wide budget mart."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MART_KEY = [
    "date_scope", "financial_year", "week_number", "year_month_day", "week_commencing_date",
    "product_pl", "region", "category", "sub_category", "metric_name",
]
MART_UPDATE = ["metric_value", "last_modified"]

MART = T.StructType([
    T.StructField("date_scope", T.StringType()),
    T.StructField("financial_year", T.IntegerType()),
    T.StructField("week_number", T.IntegerType()),
    T.StructField("year_month_day", T.DateType()),
    T.StructField("last_modified", T.TimestampType()),
    T.StructField("week_commencing_date", T.DateType()),
    T.StructField("product_pl", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("sub_category", T.StringType()),
    T.StructField("metric_name", T.StringType()),
    T.StructField("metric_value", T.DoubleType()),
])

COMPARISON = ["wow", "wow_ratio", "yoy", "yoy_ratio"]
BREAKOUT_KEY = ["metric_mart_name"] + MART_KEY
OVERVIEW_KEY = [c for c in MART_KEY if c not in ("category", "sub_category")]

BUDGET_KEY = ["date_scope", "version", "year_month_day", "week_in_fin_year", "week_commencing_date", "region"]
BUDGET_MEASURES = [
    "gross_sales_budget", "net_sales_budget", "new_customers_budget", "gross_transactions_budget",
    "average_transaction_value_budget", "marketing_spend_budget", "total_revenue_budget",
    "total_costs_budget", "gross_margin_budget", "gm_minus_pms_budget",
]
BUDGET_DECIMAL = T.DecimalType(38, 2)
PARTITION = "week_commencing_date"


def as_mart(df: DataFrame) -> DataFrame:
    """Project to the mart layout, column by column and type by type."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in MART.fields])
