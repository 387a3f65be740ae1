"""Ratio metrics recomputed from sums, one aggregate pass for all of a mart's ratios."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.ratio import safe_ratio


@dataclass(frozen=True)
class Ratio:
    """``name`` = ``num`` / (``den`` / ``den_scale``).

    ``num_sub`` restricts the numerator to one sub_category. ``den_sub`` names the
    denominator's when it differs. ``missing`` says what an absent side counts as: None drops
    the ratio, a number stands in for it. ``otherwise`` is the result for a denominator that
    is not positive; ``drop_zero`` leaves zero results out.
    """

    name: str
    num: str
    den: str
    num_sub: str | None = None
    den_sub: str | None = None
    den_scale: float = 1.0
    missing: float | None = None
    otherwise: float | None = 0.0
    drop_zero: bool = False


def _pick(metric: str, sub: str | None) -> Column:
    hit = F.col("metric_name") == metric
    if sub is not None:
        hit = hit & (F.col("sub_category") == sub)
    return F.max(F.when(hit, F.col("metric_value")))


def ratio_rows(rows: DataFrame, keys: list[str], ratios: list[Ratio]) -> DataFrame:
    """Ratio metric rows from long rows, instead of one self-join per ratio.

    ``keys`` group numerator with denominator. Without ``sub_category`` among them every
    ratio needs ``num_sub``, which labels its rows.
    """
    sides: dict[tuple[str, str | None], str] = {}
    for r in ratios:
        sides.setdefault((r.num, r.num_sub), f"v{len(sides)}")
        sides.setdefault((r.den, r.den_sub or r.num_sub), f"v{len(sides)}")
    wanted = sorted({metric for metric, _ in sides})
    wide = (
        rows.where(F.col("metric_name").isin(*wanted))
        .groupBy(*keys)
        .agg(*[_pick(metric, sub).alias(col) for (metric, sub), col in sides.items()])
    )

    def value(r: Ratio) -> Column:
        num, den = F.col(sides[(r.num, r.num_sub)]), F.col(sides[(r.den, r.den_sub or r.num_sub)])
        present = num.isNotNull() & den.isNotNull()
        if r.missing is not None:
            num, den = F.coalesce(num, F.lit(r.missing)), F.coalesce(den, F.lit(r.missing))
            present = F.lit(True)
        scaled = den if r.den_scale == 1.0 else den / F.lit(r.den_scale)
        result = F.when(present, safe_ratio(num, scaled, r.otherwise))
        return F.nullif(result, F.lit(0.0)) if r.drop_zero else result

    by_sub = "sub_category" in keys
    structs = [
        F.struct(
            *([] if by_sub else [F.lit(r.num_sub).alias("sub_category")]),
            F.lit(r.name).alias("metric_name"),
            value(r).alias("metric_value"),
        )
        for r in ratios
    ]
    return wide.select(*keys, F.inline(F.array(*structs))).where(F.col("metric_value").isNotNull())


def with_ratios(rows: DataFrame, keys: list[str], ratios: list[Ratio]) -> DataFrame:
    return rows.unionByName(ratio_rows(rows, keys, ratios))
