"""Months until acquisition cost is earned back."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values: (multiplier column, months in the band) in order.
BANDS = (
    ("m1_multiplier", 1), ("m2_m3_multiplier", 2), ("m4_m6_multiplier", 3), ("m7_m12_multiplier", 6),
    ("m13_m24_multiplier", 12), ("m25_36_multiplier", 12), ("m37_48_multiplier", 12), ("m49_60_multiplier", 12),
    ("m61_72_multiplier", 12), ("m73_84_multiplier", 12), ("m85_96_multiplier", 12), ("m97_108_multiplier", 12),
    ("m109_120_multiplier", 12),
)


def payback_months(cpa: Column, margins: list[Column], lengths: list[int]) -> Column:
    """Walk the bands until the margin earned so far passes the cost, then interpolate.

    ``margins`` are monthly margins per customer of each band. The first band answers 1
    outright; the last band is not tested, it extrapolates.
    """
    starts = [0, *accumulate(lengths)][: len(lengths)]
    earned_before = [F.lit(0.0)]
    for margin, length in zip(margins, lengths):
        step = margin if length == 1 else margin * F.lit(float(length))
        earned_before.append(step if len(earned_before) == 1 else earned_before[-1] + step)

    def answer(i: int) -> Column:
        return F.lit(float(starts[i])) + F.try_divide(cpa - earned_before[i], margins[i])

    months = F.when(earned_before[1] > cpa, F.lit(1.0))
    for i in range(1, len(margins) - 1):
        months = months.when(earned_before[i + 1] > cpa, answer(i))
    return months.otherwise(answer(len(margins) - 1))
