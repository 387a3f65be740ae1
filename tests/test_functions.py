"""Hand-computed cases of the column functions."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from tidemark.functions.dates import monday_after_shift, plan_week, sunday_of
from tidemark.functions.money import from_units, stable_sum, sum_units
from tidemark.functions.ratio import currency_pick, plain_ratio, round_half_up, safe_ratio
from tidemark.functions.taxonomy import channel_category, channel_sub_category, journey_class, plan_region, repaired
from tidemark.operators.payback import payback_months
from tidemark.params import RunParams, week_start, weekly_scopes_due


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def test_sums_do_not_depend_on_order(spark):
    amounts = [0.1, 0.2, 1e9, -1e9, 0.3, 12345.6789] * 50
    up = spark.createDataFrame([(a,) for a in sorted(amounts)], "a double").repartition(7)
    down = spark.createDataFrame([(a,) for a in sorted(amounts, reverse=True)], "a double").coalesce(1)
    exact = lambda df: df.agg(from_units(sum_units(F.col("a"))).alias("u"), stable_sum(F.col("a")).alias("d")).first()
    assert exact(up) == exact(down)
    assert exact(up).u == pytest.approx(50 * 12346.2789, abs=1e-9)


def test_unit_sum_overflow_raises(spark):
    rows = spark.createDataFrame([(9e11,), (9e11,)], "a double").coalesce(1)
    with pytest.raises(Exception, match="(?i)overflow"):
        rows.agg(sum_units(F.col("a"))).collect()


@pytest.mark.parametrize("num,den,zero,null", [(6.0, 3.0, 2.0, 2.0), (6.0, 0.0, 0.0, None), (6.0, -1.0, 0.0, None)])
def test_safe_ratio(spark, num, den, zero, null):
    assert value(spark, safe_ratio(F.lit(num), F.lit(den))) == zero
    assert value(spark, safe_ratio(F.lit(num), F.lit(den), None)) == null


def test_unguarded_division_gives_nothing_for_zero(spark):
    assert value(spark, plain_ratio(F.lit(5.0), F.lit(0.0))) is None


def test_rounding_ties_go_up(spark):
    assert value(spark, round_half_up(F.lit(10260.73605) / F.lit(3.0), 4)) == 3420.2454
    assert value(spark, round_half_up(F.lit(0.00015), 4)) == 0.0002


def test_currency_follows_the_line(spark):
    rows = spark.createDataFrame(
        [("UK", "United Kingdom"), ("UK", "Other"), ("EU", "France"), ("UK & EU", "Total"), (None, None)], "product_pl string, region string"
    )
    gbp, eur = F.lit("gbp"), F.lit("eur")
    picked = rows.select(
        currency_pick(gbp, eur).alias("a"), currency_pick(gbp, eur, region="region").alias("b"), currency_pick(gbp, eur, total="GBP").alias("c")
    ).collect()
    assert [r.a for r in picked] == ["gbp", "gbp", "eur", "eur", "gbp"]
    assert [r.b for r in picked] == ["gbp", "eur", "eur", "eur", "gbp"]
    assert [r.c for r in picked] == ["gbp", "gbp", "eur", "gbp", "gbp"]


def test_weeks_run_sunday_to_saturday(spark):
    day = lambda d: F.lit(date.fromisoformat(d))
    assert value(spark, monday_after_shift(day("2024-01-07"))) == date(2024, 1, 8)
    assert value(spark, monday_after_shift(day("2024-01-06"))) == date(2024, 1, 1)
    assert value(spark, sunday_of(day("2024-01-06"))) == date(2023, 12, 31) == week_start(date(2024, 1, 6))
    assert value(spark, sunday_of(day("2024-01-07"))) == date(2024, 1, 7) == week_start(date(2024, 1, 7))


def test_plan_week_reads_months_and_both_centuries(spark):
    assert value(spark, plan_week(F.lit("05/03/24"))) == date(2024, 3, 5)
    assert value(spark, plan_week(F.lit("29/02/96"))) == date(1996, 2, 29)


BANDS = [1, 2, 3, 6] + [12] * 9


@pytest.mark.parametrize("cpa,margins,months", [
    (5.0, [6.0] + [1.0] * 12, 1.0),
    (10.0, [6.0, 4.0] + [1.0] * 11, 2.0),
    (1000.0, [1.0] * 13, 1000.0),
    (None, [1.0] * 13, None),
])
def test_payback_walks_the_bands(spark, cpa, margins, months):
    got = value(spark, payback_months(F.lit(cpa).cast("double"), [F.lit(m) for m in margins], BANDS))
    assert got == months


def test_channel_labels(spark):
    cases = {
        ("Visits", "Organic Search", "Brand Organic", None, "Web"): ("Organic Last Click", "Brand Organic"),
        ("Clicks", "Organic Search", "Brand Organic", None, "Web"): ("Other", "Other"),
        ("Clicks", "Email", None, None, "App"): ("Organic Last Click", "Other"),
        ("Incremental Spend EUR", "Affiliates", None, None, "Web"): ("Paid Incremental", "Affiliates"),
        ("Visits", "Paid Search", "Google", None, "App"): ("Paid Last Click", "Paid App Lower Funnel"),
        ("Visits", "Paid Search", None, None, "App"): ("Paid Last Click", "Paid App Mid Funnel"),
        ("Visits", "Paid Search", None, "adwords", None): ("Paid Last Click", "Web Lower Funnel"),
        ("Installs", "Social", None, None, "Web"): ("Other", "Paid App Mid Funnel"),
        ("Spend", "Social", None, None, "Web"): ("Paid Last Click", "Web Mid Funnel"),
    }
    rows = spark.createDataFrame(list(cases), "kpi string, channel string, sub string, source string, device string")
    got = rows.select(
        channel_category(F.col("kpi"), F.col("channel")),
        channel_sub_category(F.col("kpi"), F.col("channel"), F.col("sub"), F.col("source"), F.col("device")),
    ).collect()
    assert [tuple(r) for r in got] == list(cases.values())


def test_small_labels(spark):
    assert value(spark, journey_class(F.lit("regional"), F.lit("Commuting"))) == "Commute and Regional"
    assert value(spark, journey_class(F.lit("long distance"), F.lit("Business"))) is None
    assert value(spark, plan_region(F.lit("ROW"))) == "Inbound"
    assert value(spark, repaired(F.lit("x"), {"x": "y"})) == "y"


def test_run_parameters():
    with pytest.raises(ValueError):
        RunParams(date(2024, 1, 2), date(2024, 1, 1))
    saturday = date(2024, 1, 6)
    assert weekly_scopes_due(saturday) and not weekly_scopes_due(date(2024, 1, 7))
    assert RunParams.weekly(saturday).start == date(2023, 12, 31)
    assert RunParams.year_to_date(saturday).start == date(2023, 1, 7)
    assert RunParams.daily(saturday).first_week == date(2023, 12, 31)
