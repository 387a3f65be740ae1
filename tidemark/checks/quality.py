"""Additivity, completeness, keys, accepted values, and report against mart."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.checks.reconcile import whole
from tidemark.functions.money import stable_sum
from tidemark.operators.calendar import in_run
from tidemark.params import ALL, DAY, FYTD, REPORT_REGIONS, WEEK, RunParams
from tidemark.plans.retention import RATE_NAMES
from tidemark.sources.lookups import FOREIGN_TRAVEL

# Metrics per mart whose regions do not add up: people counted once a region, and quotients.
NOT_ADDITIVE = {
    "acquisition_mart": (
        "Active Customers", "Existing Customers", "New Customers", "Incremental ROAS", "CPA", "CVR", "LC_CPA", "Cost / Click",
        "Payback Months",
    ),
    "conversion_mart": ("Avg Trans Value", "Avg Trans Value Budget", "Conversion Ratio"),
    "monetisation_mart": (
        "Non-Fee Revenue / Visit", "CTR", "CPM", "Percent of Tickets", "Take Rate", "Fee Revenue / Transaction",
    ),
    "retention_mart": tuple(RATE_NAMES.values()),
    "supply_mart": ("Refunds Ratio", "Unsellable Journey Ratio"),
}
# Metrics that a region has on some days only, as it needs spend; their parts are whole where no region lacks a row.
PARTIAL = {"acquisition_mart": ("GM - PMS",)}
NOT_NULL_COLUMNS = ("metric_name", "week_commencing_date", "product_pl", "region", "category", "sub_category")


def carried_forward(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Year-to-date rows of each region at every week any of them has one: its last running value.

    A region without a row in a week keeps the total it had. A window partition is one series of
    one region in one year, at most 53 weeks.
    """
    series = [c for c in keys if c != "year_month_day"] + ["financial_year"]
    regions = F.explode(F.array(*[F.lit(r) for r in ("Foreign Travel", *FOREIGN_TRAVEL)]))
    grid = rows.select(*keys, "financial_year").distinct().withColumn("region", regions)
    upto = Window.partitionBy(*series, "region").orderBy("year_month_day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    held = grid.join(rows.select(*keys, "financial_year", "region", "metric_value"), [*keys, "financial_year", "region"], "left")
    return held.withColumn("metric_value", F.last("metric_value", ignorenulls=True).over(upto)).select(*keys, "region", "metric_value")


def lacking_parts(rows: DataFrame, metrics: tuple[str, ...]) -> DataFrame:
    """Scope, date and labels of rows of ``metrics`` with a day behind them on which a region has no row.

    A day lacks a part by itself, a week by any of its days, a running total by any week of its
    year so far. Window partitions are one series in one year, at most 53 weeks.
    """
    series = ["category", "sub_category", "metric_name"]
    rows = rows.where(F.col("metric_name").isin(*metrics))
    at = lambda scope: rows.where(F.col("date_scope") == scope)
    days = at(DAY).groupBy("year_month_day", "week_commencing_date", *series).agg(
        (F.count(F.when(F.col("region") != "Foreign Travel", 1)) < len(FOREIGN_TRAVEL)).alias("lacks")
    )
    weeks = days.groupBy(F.col("week_commencing_date").alias("year_month_day"), *series).agg(F.max("lacks").alias("lacks"))
    so_far = Window.partitionBy("financial_year", *series).orderBy("year_month_day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    years = at(WEEK).select("year_month_day", "financial_year", *series).distinct().join(weeks, ["year_month_day", *series], "left")
    running = years.withColumn("lacks", F.max("lacks").over(so_far))
    found = [(DAY, days), (WEEK, weeks), (FYTD, running)]
    keyed = [df.where("lacks").select(F.lit(scope).alias("date_scope"), "year_month_day", *series) for scope, df in found]
    return reduce(DataFrame.unionByName, keyed).withColumn("lacks", F.lit(True))


def foreign_travel_check(mart_name: str, mart: DataFrame, tolerance: float = 10.0) -> DataFrame:
    """Foreign Travel beside the sum of its three regions, for additive metrics.

    Running totals are carried forward to the weeks in which a region has no row. As stored
    data is judged, a side that is missing does not fail; ``status`` shows it, and also where a
    metric that needs spend lacks a region on some day.
    """
    keys = ["date_scope", "year_month_day", "category", "sub_category", "metric_name"]
    region = F.col("region")
    rows = mart.where(
        (F.col("product_pl") == "EU")
        & region.isin("Foreign Travel", *FOREIGN_TRAVEL)
        & ~F.col("metric_name").isin(*NOT_ADDITIVE[mart_name])
    )
    running = F.col("date_scope") == FYTD
    partial = PARTIAL.get(mart_name)
    lacking = lacking_parts(rows, partial) if partial else None
    rows = rows.where(~running).select(*keys, "region", "metric_value").unionByName(carried_forward(rows.where(running), keys))
    # one pass instead of joining two filtered copies of the mart
    sides = rows.groupBy(*keys).agg(
        stable_sum(F.when(region != "Foreign Travel", F.col("metric_value"))).alias("parts"),
        F.max(F.when(region == "Foreign Travel", F.col("metric_value"))).alias("foreign_travel"),
    )
    sides = sides.withColumn("lacks", F.lit(None).cast("boolean")) if lacking is None else sides.join(lacking, keys, "left")
    gap = F.abs(F.col("parts") - F.col("foreign_travel"))
    status = F.when(F.col("parts").isNull(), "no parts").when(F.col("foreign_travel").isNull(), "no foreign travel").when(F.col("lacks"), "parts lacking")
    return sides.withColumns({
        "difference": gap, "status": status.otherwise("compared"), "failed": F.coalesce((gap > tolerance) & F.col("lacks").isNull(), F.lit(False)),
    }).drop("lacks").orderBy(F.col("difference").desc_nulls_last(), *keys)


def completeness_check(mart: DataFrame, column: str, p: RunParams, allowed: float = 0.10) -> DataFrame:
    """Share of the run's DAY rows without ``column``."""
    rows = mart.where((F.col("date_scope") == DAY) & in_run(F.col("year_month_day"), p))
    counts = rows.agg(F.count(F.when(F.col(column).isNull(), 1)).alias("nulls"), F.count("*").alias("records"))
    share = F.try_divide(F.col("nulls").cast("double"), F.col("records").cast("double"))
    return counts.withColumn("failed", F.coalesce(share > allowed, F.lit(False)))


def unique_key_check(table: DataFrame, key: list[str]) -> DataFrame:
    """Key combinations that occur more than once."""
    return table.groupBy(*key).agg(F.count("*").alias("copies")).where(F.col("copies") > 1)


def unique_key_tally(tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """Rows, distinct keys and repeated keys of each table."""

    def one(name: str, table: DataFrame, key: list[str]) -> DataFrame:
        copies = table.groupBy(*key).agg(F.count("*").alias("copies"))
        return copies.agg(
            F.sum("copies").alias("records"), F.count("*").alias("distinct_keys"),
            F.count(F.when(F.col("copies") > 1, 1)).alias("repeated_keys"),
        ).select(F.lit(name).alias("table_name"), "*")

    return reduce(DataFrame.unionByName, [one(n, t, k) for n, (t, k) in tables.items()])


def not_null_check(tables: dict[str, DataFrame], columns=NOT_NULL_COLUMNS, written_at=None) -> DataFrame:
    """Nulls per table and key column the table has, all columns of a table in one pass.

    ``written_at`` looks at the rows of the run with that stamp only (a warning, not an error).
    """

    def one(name: str, table: DataFrame) -> DataFrame:
        columns = [c for c in wanted if c in table.columns]
        if written_at is not None:
            table = table.where(F.col("last_modified") == F.lit(written_at).cast("timestamp"))
        counts = table.agg(F.count("*").alias("records"), *[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in columns])
        rows = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("nulls")) for c in columns]
        return counts.select(F.lit(name).alias("table_name"), "records", F.inline(F.array(*rows)))

    wanted = columns
    return reduce(DataFrame.unionByName, [one(n, t) for n, t in tables.items()]).withColumn("failed", F.col("nulls") > 0)


def accepted_values_check(tables: dict[str, DataFrame], column: str = "region", accepted=REPORT_REGIONS) -> DataFrame:
    """Every value of a column with its rows, and whether it is accepted."""

    def one(name: str, table: DataFrame) -> DataFrame:
        return table.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("records")).withColumn("table_name", F.lit(name))

    found = reduce(DataFrame.unionByName, [one(n, t) for n, t in tables.items()])
    return found.withColumn("failed", F.coalesce(~F.col("value").isin(*accepted), F.lit(False)))


def distinct_count_check(tables: dict[str, DataFrame], column: str = "region", expected: int = len(REPORT_REGIONS)) -> DataFrame:
    """Number of distinct values of a column against the expected number (a warning, not an error)."""

    def one(name: str, table: DataFrame) -> DataFrame:
        return table.agg(F.countDistinct(column).alias("distinct_values")).select(F.lit(name).alias("table_name"), "*")

    counts = reduce(DataFrame.unionByName, [one(n, t) for n, t in tables.items()])
    return counts.withColumn("failed", F.col("distinct_values") != expected)


def report_check(report: DataFrame, mart: DataFrame, p: RunParams, labelled: bool) -> DataFrame:
    """Report rows beside the acquisition mart rows they repeat.

    The breakout is matched by label; the overview against the 'All' level, under the name it
    gives to visits. Report rows of other marts have no counterpart and cannot fail.
    """
    keys = ["date_scope", "year_month_day", "product_pl", "region", "metric"] + (["category", "sub_category"] if labelled else [])
    dated = in_run(F.col("year_month_day"), p)
    rows = report.where(dated).withColumn("metric", F.upper("metric_name"))
    stored = mart.where(dated)
    name = F.col("metric_name")
    if labelled:
        rows = rows.where(F.col("metric_mart_name") == "acquisition_mart")
    else:
        stored = stored.where((F.upper("category") == ALL.upper()) & (F.upper("sub_category") == ALL.upper()))
        name = F.when(name == "Total Visits", "Acquisition Visits").otherwise(name)
    stored = stored.select(F.upper(name).alias("metric"), F.col("metric_value").alias("mart_value"), *[k for k in keys if k != "metric"])
    both = rows.select(*keys, F.col("metric_value").alias("report_value")).join(stored, keys, "left")
    return both.withColumn(
        "failed", F.coalesce(whole(F.col("report_value")) != whole(F.col("mart_value")), F.lit(False))
    )
