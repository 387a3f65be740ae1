"""Steps several marts share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.money import from_units, merge_units, sum_units
from tidemark.functions.ratio import round_half_up
from tidemark.operators.calendar import in_run
from tidemark.operators.region import region_fanout
from tidemark.params import MartConfig, RunParams
from tidemark.sources.catalog import Sources

DAY_KEYS = ["year_month_day", "product_pl", "region"]
LINE_PL, LINE_REGION = "product_pl_code", "order_region_name"
CAMPAIGN_PL, CAMPAIGN_REGION = "pnl_segment", "region"


def qualifying_lines(src: Sources, cfg: MartConfig) -> DataFrame:
    """Order lines of the business channel, managed groups, product types and systems reported on."""
    return src.order_lines.where(
        (F.col("order_business_channel_code") == cfg.business_channel)
        & F.col("order_managed_group_id").isin(*cfg.managed_groups)
        & F.upper("product_type_code").isin(*cfg.product_types)
        & F.col("source_system").isin(*cfg.source_systems)
    )


def looked_at(p: RunParams, cfg: MartConfig) -> Column:
    """The run's days and its look-back, or of that the days known to have changed."""
    day = F.col("year_month_day")
    if cfg.late_days is None:
        return in_run(day, p, cfg.line_lookback_days)
    return in_run(day, p) | day.isin(*cfg.late_days) if cfg.late_days else in_run(day, p)


def is_gross_sale() -> Column:
    return (F.col("product_gross_sales_flag") == "Y") & (F.col("record_type") == "SALES")


def both_currencies(names: dict[str, str]) -> dict[str, Column]:
    """``{"fees": "m_total_fees"}`` to fees_gbp and fees_eur over the source's two columns."""
    return {f"{out}_{cur}": F.col(f"{col}_{cur}") for out, col in names.items() for cur in ("gbp", "eur")}


def region_totals(
    df: DataFrame,
    keys: list[str],
    pl: str,
    region: str,
    region_map: DataFrame,
    money: dict[str, Column] | None = None,
    counts: dict[str, Column] | None = None,
) -> DataFrame:
    """Additive totals per ``keys``, reporting line and region.

    Facts are added up by the raw pair first, so the fan-out multiplies a few rows per day
    and not the facts, and the all-regions group never collects more than that.
    """
    money, counts = money or {}, counts or {}
    raw = df.groupBy(*keys, pl, region).agg(
        *[sum_units(v).alias(n) for n, v in money.items()], *[F.sum(v).alias(n) for n, v in counts.items()]
    )
    merged = (
        region_fanout(raw, pl, region, region_map)
        .groupBy(*keys, "product_pl", "region")
        .agg(*[merge_units(F.col(n)).alias(n) for n in money], *[F.sum(n).alias(n) for n in counts])
    )
    return merged.select(
        *keys, "product_pl", "region", *[from_units(F.col(n)).alias(n) for n in money], *counts
    )


def round4(value: Column) -> Column:
    return round_half_up(value, 4)
