"""New and existing customers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import monday_after_shift
from tidemark.operators.bitmaps import BUCKET, dealt, merged_sets, set_sizes
from tidemark.operators.region import region_fanout


def customer_flags(purchases: DataFrame, accounts: DataFrame, *periods: str) -> DataFrame:
    """Mark each person's purchases of a period as new or not.

    ``purchases`` holds customer_id, product_issued_date, product_pl, region and the period
    columns. New means the purchase falls in the week of the person's first transaction on
    that side of the business, and for EU purchases also in the first transaction's region.
    Purchases are reduced to distinct rows before they are joined to the accounts.
    """
    distinct = (
        purchases.withColumn("issued_week", monday_after_shift(F.col("product_issued_date")))
        .select("customer_id", *periods, "issued_week", "product_pl", "region")
        .distinct()
    )
    people = accounts.select(
        "customer_id",
        "person_id",
        F.col("person_first_eu_transaction_order_region").alias("first_eu_region"),
        monday_after_shift(F.col("person_first_eu_transaction_date")).alias("first_eu_week"),
        monday_after_shift(F.col("person_first_uk_transaction_date")).alias("first_uk_week"),
    )
    new_uk = F.col("first_uk_week") == F.col("issued_week")
    new_eu = (F.col("first_eu_week") == F.col("issued_week")) & (F.col("first_eu_region") == F.col("region"))
    is_new = F.when(F.col("product_pl") == "UK", new_uk).otherwise(new_eu)
    return distinct.join(people, "customer_id").select(
        *periods, "product_pl", "region", "person_id",
        F.coalesce(is_new, F.lit(False)).cast("int").alias("is_new"),
    )


def customer_counts(flags: DataFrame, period: str, region_map: DataFrame) -> DataFrame:
    """New, existing and active persons per period, line and region.

    Persons are first reduced to one row each per group, which spreads the Total group over
    all tasks; counting then is a plain sum. A person bought as new and as existing counts in
    both, and once in active.
    """
    raw = flags.groupBy(period, "product_pl", "region", "person_id").agg(
        F.max("is_new").alias("was_new"), F.max(1 - F.col("is_new")).alias("was_existing")
    )
    per_person = region_fanout(raw, "product_pl", "region", region_map).groupBy(
        period, "product_pl", "region", "person_id"
    ).agg(F.max("was_new").alias("was_new"), F.max("was_existing").alias("was_existing"))
    return per_person.groupBy(period, "product_pl", "region").agg(
        F.sum("was_new").alias("new_customers"),
        F.sum("was_existing").alias("existing_customers"),
        F.count("*").alias("active_customers"),
    )


def customer_counts_of_sets(sets: DataFrame, period: str, region_map: DataFrame) -> DataFrame:
    """As ``customer_counts``, from stored sets of persons by ``is_new`` and raw pair: unions, whatever the period."""
    keys = [period, "product_pl", "region"]
    mapped = region_fanout(dealt(sets, period, BUCKET), "product_pl", "region", region_map)
    new, old = F.col("is_new") == 1, F.col("is_new") == 0
    return set_sizes(
        merged_sets(mapped, keys, was_new=new, was_existing=old), keys,
        new_customers="was_new", existing_customers="was_existing", active_customers="members",
    )
