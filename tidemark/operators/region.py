"""Region fan-out and the product-line/region association."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NULL_KEY = "(null)"


def region_fanout(
    df: DataFrame, pl_col: str, region_col: str, region_map: DataFrame, null_keys: bool = True
) -> DataFrame:
    """Replace the raw product line and region by every reporting pair they feed.

    One input row becomes one to three output rows, so callers aggregate by the raw pair
    first. The map is small; Spark picks a broadcast join from its known size, and falls back
    to a shuffle join if someone supplies a large one.
    """
    key = (lambda c: F.coalesce(F.col(c), F.lit(NULL_KEY))) if null_keys else F.col
    rest = [c for c in df.columns if c not in (pl_col, region_col)]
    left = df.select(*rest, key(pl_col).alias("_pl"), key(region_col).alias("_region"))
    mapped = left.join(
        region_map, (F.col("_pl") == F.col("input_product_pl")) & (F.col("_region") == F.col("input_region"))
    )
    return mapped.select(
        *rest, F.col("output_product_pl").alias("product_pl"), F.col("output_region").alias("region")
    )


def pair_fanout(df: DataFrame, pl: str, region: str, region_map: DataFrame) -> DataFrame:
    """Every reporting pair that one fixed raw pair feeds, for all rows.

    The pair's few entries are read while planning: joined by constants they would make a
    nested-loop join.
    """
    mine = (F.col("input_product_pl") == pl) & (F.col("input_region") == region)
    pairs = region_map.where(mine).select("output_product_pl", "output_region").distinct().collect()
    entries = [F.struct(F.lit(a).alias("product_pl"), F.lit(b).alias("region")) for a, b in sorted(map(tuple, pairs))]
    if not entries:
        return df.where(F.lit(False)).withColumns({"product_pl": F.lit(pl), "region": F.lit(region)})
    return df.withColumn("_pair", F.explode(F.array(*entries))).select(*df.columns, "_pair.product_pl", "_pair.region")


def raw_region_label(pl: Column, region: Column) -> Column:
    """The base region a raw pair reports under, as the reconciliations see it."""
    return (
        F.when((pl == "EU") & (region == "United Kingdom"), "UK>EU")
        .when((pl == "EU") & (region == "Unknown"), "France")
        .when(pl == "UK", "United Kingdom")
        .otherwise(region)
    )


def line_owns_region(eu_regions: tuple[str, ...] | None = None, with_total: bool = True) -> Column:
    """Keep EU lines with EU regions, the UK line with the United Kingdom, UK & EU with Total."""
    pl, region = F.col("product_pl"), F.col("region")
    eu = ~region.isin("Total", "United Kingdom") if eu_regions is None else region.isin(*eu_regions)
    keep = ((pl == "EU") & eu) | ((pl == "UK") & (region == "United Kingdom"))
    return keep | ((pl == "UK & EU") & (region == "Total")) if with_total else keep
