"""Hand-made frames for the operators, and properties that must hold on the test data."""

from dataclasses import replace
from datetime import date, datetime, timedelta
from itertools import combinations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import bitmaps
from tidemark.operators.bitmaps import MEMBERS, TASK_ROWS, dealt, dense, member_sets, merged_sets, set_sizes
from tidemark.operators.compare import future_placeholders, lagged_compare
from tidemark.operators.dedup import latest_per_key
from tidemark.operators.fx import bucketed_intervals, fx_interval_join, rates_by_interval
from tidemark.operators.ratios import Ratio, ratio_rows
from tidemark.operators.region import region_fanout
from tidemark.operators.rollup import count_levels, grouping_levels, label_chains, over_all_tasks
from tidemark.operators.scopes import lag_previous_present, roll_to_week, running_ytd
from tidemark.operators.spread import complete_weeks_only, spread_budget, weekday_weights
from tidemark.params import RunParams
from tidemark.plans import extracts
from tidemark.plans.acquisition import customer_totals
from tidemark.plans.common import qualifying_lines
from tidemark.plans.conversion import journey_sales
from tidemark.plans.extracts import distinct_orders, order_sets
from tidemark.plans.monetisation import ad_rows, hotel_web_counts
from tidemark.queries import QUERIES
from tidemark.sources import lookups
from tidemark.sources.catalog import Sources
from tidemark.sources.fixtures import CONFIG, RUN, SQL, fixture_sources, lines_of_orders

MART = (
    "date_scope string, financial_year int, week_number int, year_month_day date, week_commencing_date date, "
    "product_pl string, region string, category string, sub_category string, metric_name string, metric_value double"
)


def mart_row(scope, day, value, metric="Gross Sales", fy=2024, week=None):
    week = week or day - timedelta(days=(day.weekday() + 1) % 7)
    return (scope, fy, 1, day, week, "EU", "France", "All", "All", metric, value)


@pytest.fixture(scope="module")
def region_map(spark):
    return lookups.region_map(spark)


def test_region_fanout(spark, region_map):
    rows = spark.createDataFrame(
        [(1, "EU", "United Kingdom"), (2, None, None), (3, "UK", "United Kingdom"), (4, "EU", "Nowhere"), (5, None, "France")],
        "id int, pl string, rg string",
    )
    got = {}
    for r in region_fanout(rows, "pl", "rg", region_map).collect():
        got.setdefault(r.id, set()).add((r.product_pl, r.region))
    assert got == {
        1: {("EU", "UK>EU"), ("EU", "Foreign Travel"), ("UK & EU", "Total")},
        2: {("EU", "France"), ("UK & EU", "Total")},
        3: {("UK", "United Kingdom"), ("UK & EU", "Total")},
    }
    assert region_fanout(rows, "pl", "rg", region_map, null_keys=False).where("id = 2").count() == 0


def test_levels_equal_the_surviving_part_of_a_cube(src):
    lines = qualifying_lines(src, CONFIG).fillna("none", ["order_region_name"])
    dims = ["year_month_day", "order_region_name", "record_type"]
    aggs = [F.count("*").alias("n"), F.countDistinct("order_id").alias("orders")]
    levels = grouping_levels(lines, dims[:1], dims[1:], aggs)
    cube = lines.cube(*dims).agg(*aggs, *[F.grouping(d).alias(f"g_{d}") for d in dims]).where("g_year_month_day = 0")
    cube = cube.select(dims[0], *[F.when(F.col(f"g_{d}") == 1, "All").otherwise(F.col(d)).alias(d) for d in dims[1:]], "n", "orders")
    assert levels.exceptAll(cube).count() == 0 and cube.exceptAll(levels).count() == 0


def test_a_missing_label_is_not_the_rolled_up_level(spark):
    rows = spark.createDataFrame([("k", None, 1), ("k", "x", 2)], "k string, c string, v int")
    got = {r.c: r.v for r in grouping_levels(rows, ["k"], ["c"], [F.sum("v").alias("v")]).collect()}
    assert got == {"Unknown": 1, "x": 2, "All": 3}


def test_latest_per_key_is_deterministic_on_ties(spark):
    rows = [(1, datetime(2024, 1, 1), "a"), (1, datetime(2024, 1, 2), "b"), (1, datetime(2024, 1, 2), "c"), (2, datetime(2024, 1, 1), "z")]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "k int, at timestamp, v string").repartition(3)
        assert {(r.k, r.v) for r in latest_per_key(df, ["k"], ["at"]).collect()} == {(1, "c"), (2, "z")}


def test_latest_per_key_equals_a_ranked_window(spark):
    """Ties, copies, NULL keys and times, a second time column, and a key that holds most rows."""
    rows = [(i % 7 or None, "ab"[i % 2] if i % 5 else None, datetime(2024, 1, 1 + i % 3) if i % 4 else None, i % 6, f"v{i % 11}" if i % 13 else None) for i in range(400)]
    rows += [(99, "hot", datetime(1960, 1, 1 + i % 9), i % 2, "same") for i in range(900)]
    df = spark.createDataFrame(rows, "k int, l string, at timestamp, n int, v string")
    for keys, newest in ((["k", "l"], ["at"]), (["k"], ["at", "n"]), (["l"], ["n"]), (["k"], ["v"]), (["k", "l", "at"], ["n"])):
        rest = [c for c in df.columns if c not in keys and c not in newest]
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in newest + rest]))
        want = df.withColumn("rank", rank).where("rank = 1").select(*keys, *newest, *rest)
        got = latest_per_key(df, keys, newest)
        assert got.columns == want.columns
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert latest_per_key(df.limit(0), ["k"], ["at"]).count() == 0


def _sorts_before_a_shuffle(df):
    plan = df._jdf.queryExecution().sparkPlan().toString()
    return [line for line in plan.splitlines() if "SortAggregate" in line]


def test_latest_per_key_hashes_raw_rows(spark, src):
    """Whole rows are compared only above the join that leaves keys that still tie."""
    found = _sorts_before_a_shuffle(ad_rows(src, RUN))
    plan = ad_rows(src, RUN)._jdf.queryExecution().sparkPlan().toString().splitlines()
    assert len(found) == 2 and sum("HashAggregate" in line for line in plan) >= 4
    for line in (k for k, text in enumerate(plan) if "SortAggregate" in text):
        below = [text for text in plan[line + 1 :] if "Aggregate" in text or "Join" in text]
        assert any("Join" in text for text in below[:2])


def _hashed_before_a_shuffle(df):
    """Aggregates of the plan with no shuffle below them."""
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    depth = [len(line) - len(line.lstrip(" :+-*(0123456789)")) for line in lines]
    below = [next((j for j in range(k + 1, len(lines)) if depth[j] <= depth[k]), len(lines)) for k in range(len(lines))]
    return [line for k, line in enumerate(lines) if "Aggregate" in line and not any("Exchange" in x for x in lines[k + 1 : below[k]])]


def test_many_rows_are_dealt_before_they_are_hashed(spark, src, monkeypatch):
    """No task hashes what a scan's part of a file holds: ad rows, web events and order sets, with the rows of undealt ones."""
    run = replace(RUN, start=date(1999, 1, 1))
    builds = [
        lambda: ad_rows(src, run), lambda: hotel_web_counts(src, run, CONFIG), lambda: distinct_orders(src, run, CONFIG, "year_month_day"),
        lambda: distinct_orders(src, run, CONFIG, "financial_year"),
    ]
    few = [build().localCheckpoint() for build in builds]
    monkeypatch.setattr(bitmaps, "TASK_ROWS", 150)
    for build, want in zip(builds, few, strict=True):
        got = build()
        assert not _hashed_before_a_shuffle(got)
        if build is builds[0]:  # nothing is dealt to the session's number of tasks
            plan = got._jdf.queryExecution().executedPlan().toString()
            assert "REPARTITION_BY_NUM" in plan and "ENSURE_REQUIREMENTS" not in plan and "ShuffledHashJoin" in plan
        assert want.count() > 0 and got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_latest_of_dealt_rows_equals_a_ranked_window(spark, monkeypatch):
    """As below one task: ties, copies, NULL keys and times; versions of one key and rows without an order lie in many tasks."""
    monkeypatch.setattr(bitmaps, "TASK_ROWS", 60)
    test_latest_per_key_equals_a_ranked_window(spark)
    hot = spark.range(3000).select(F.lit(1).alias("k"), F.timestamp_seconds("id").alias("at"), F.col("id").alias("v"))
    got = latest_per_key(hot, ["k"], ["at"])
    assert [tuple(r)[::2] for r in got.collect()] == [(1, 2999)]
    orders = spark.createDataFrame([(date(1999, 1, 1 + i % 31), "EU", "France", None) for i in range(600)], "year_month_day date, product_pl_code string, order_region_name string, order_id long")
    monkeypatch.setattr(extracts, "order_rows", lambda *_: orders)
    parts = order_sets(None, RUN, CONFIG).rdd.glom().map(len).collect()
    assert len(parts) == 10 and max(parts) < 300


def test_sets_merge_and_count_like_distinct_rows(spark):
    rows = [(i % 5, "ab"[i % 2], (i * 7919) % 70_000 - 500 if i % 11 else None, i % 3) for i in range(3000)]
    df = spark.createDataFrame(rows, "day int, raw string, id long, kind int")
    sets = member_sets(df, ["day", "raw", "kind"], "id")
    for keys in (["day", "raw"], ["raw"], ["day"], ["kind"]):
        want = df.groupBy(*keys).agg(F.countDistinct("id").alias("n"), F.countDistinct(F.when(F.col("kind") == 1, F.col("id"))).alias("ones"))
        got = set_sizes(merged_sets(sets, keys, ones=F.col("kind") == 1), keys, n="members", ones="ones")
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    none = spark.createDataFrame([(1, None), (2, 5)], "day int, id long")
    assert {tuple(r) for r in set_sizes(member_sets(none, ["day"], "id"), ["day"], n="members").collect()} == {(1, 0), (2, 1)}
    assert set_sizes(member_sets(none.limit(0), ["day"], "id"), ["day"], n="members").count() == 0


def test_sparse_sets_cost_a_long_each_and_are_hashed(spark):
    """Numbers alone in their bucket take two longs, not kilobytes of bits, and no task sorts sets."""
    df = spark.createDataFrame([(i % 7, i * 1000 - 9000) for i in range(200)], "day int, id long")
    sets = member_sets(df, ["day"], "id")
    assert sets.schema[MEMBERS].dataType.simpleString() == "bigint" and sets.count() == 200
    united = set_sizes(merged_sets(sets, ["day"], few=F.col("day") < 3), ["day"], n="members", few="few")
    plan = united._jdf.queryExecution().sparkPlan().toString()
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
    close = spark.createDataFrame([(1, i) for i in range(-64, 128)], "day int, id long")
    assert member_sets(close, ["day"], "id").count() == 3  # 64 to a row
    assert set_sizes(member_sets(close, ["day"], "id"), ["day"], n="members").first().n == 192


def test_stored_rows_are_dealt_to_tasks_by_their_number(spark):
    assert dealt(spark.range(2 * TASK_ROWS + 1), "id").rdd.getNumPartitions() == 3
    assert dealt(spark.range(0), "id").rdd.getNumPartitions() == 1


def test_only_close_numbers_become_bits(spark):
    frame = lambda ids, kind="long": spark.createDataFrame([(i,) for i in ids], f"id {kind}")
    assert dense(frame(range(100)), "id") and dense(frame([]), "id") and dense(frame([None]), "id")
    assert not dense(frame([1, 10**12]), "id") and not dense(frame(["a"], "string"), "id")


def test_counts_do_not_depend_on_the_kind_of_ids(spark, src):
    """Ids that are far apart are counted by rows, with the same results."""
    run = RunParams(date(1999, 5, 9), date(1999, 5, 22), as_of=RUN.as_of)
    far = lambda c: (F.col(c).cast("long") * 10**10).alias(c)
    spread = {
        "order_lines": src.order_lines.withColumns({"order_id": far("order_id"), "order_customer_id": far("order_customer_id")}),
        "customer_accounts": src.customer_accounts.withColumns({"person_id": far("person_id").cast("string"), "customer_id": far("customer_id")}),
    }
    own = Sources({n: spread.get(n, getattr(src, n)) for n in ("order_lines", "customer_accounts", "calendar", "region_map")})
    assert order_sets(own, run, CONFIG) is None and order_sets(src, run, CONFIG) is not None
    for build in (
        lambda s: distinct_orders(s, run, CONFIG, "week_commencing_date"), lambda s: customer_totals(s, run, CONFIG, "year_month_day"),
        lambda s: customer_totals(s, run, CONFIG, "week_commencing_date"),
    ):
        a, b = build(src), build(own)
        assert a.count() > 0 and a.exceptAll(b.select(*a.columns)).count() == 0 and b.select(*a.columns).exceptAll(a).count() == 0


def test_fx_interval_join(spark):
    facts = spark.createDataFrame(
        [(1, "EUR", datetime(2024, 1, 23, 23)), (2, "EUR", datetime(2024, 1, 24)), (3, "ZZZ", datetime(2024, 1, 5)), (4, "EUR", datetime(2023, 1, 1))],
        "id int, cur string, at timestamp",
    )
    got = {r.id: r.rate_gbp for r in fx_interval_join(facts, lookups.fx_rates(spark), "cur", "at").collect()}
    assert got == {1: 0.85, 2: 0.86, 3: None, 4: None}


def test_twenty_years_of_daily_rates_meet_a_fact_week_by_week(spark):
    start = datetime(2004, 1, 1)
    days = 20 * 365
    rows = [(start + timedelta(days=i), start + timedelta(days=i, hours=23, minutes=59), c, t, 1.0 + i / 1000) for i in range(days) for c in ("EUR", "USD") for t in ("GBP",)]
    rows += [(datetime(1990, 1, 1), datetime(9999, 12, 31), "XAU", "GBP", 7.0), (start, start - timedelta(days=1), "EUR", "GBP", 99.0)]
    rates = spark.createDataFrame(rows, "valid_from timestamp, valid_to timestamp, base_currency string, target_currency string, rate double")
    facts = spark.createDataFrame(
        [(i, ("EUR", "USD", "XAU", "ZZZ", None)[i % 5], None if i % 97 == 0 else start + timedelta(days=(i * 37) % (days + 400) - 200, minutes=i)) for i in range(2000)],
        "id int, cur string, at timestamp",
    )
    by_interval = rates_by_interval(rates)
    want = facts.join(by_interval, (F.col("cur") == F.col("base_currency")) & F.col("at").between(F.col("valid_from"), F.col("valid_to")), "left")
    got = fx_interval_join(facts, rates, "cur", "at")
    assert got.columns == [*facts.columns, "rate_gbp", "rate_eur"]
    assert got.exceptAll(want.select(*got.columns)).count() == 0 and got.count() == want.count()
    first, last = date(1990, 1, 1), date(2023, 12, 26)
    met = bucketed_intervals(by_interval, first, last).groupBy("base_currency", "_bucket").count().agg(F.max("count")).first()[0]
    assert met <= 8  # intervals of a currency in a bucket
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "_fact_bucket" in plan and "(_fact_bucket" in next(line for line in plan.splitlines() if "Join LeftOuter" in line)
    assert fx_interval_join(facts, rates.limit(0), "cur", "at").where("rate_gbp is not null").count() == 0


def test_ratio_rows_missing_sides(spark):
    d = date(2024, 1, 7)
    rows = spark.createDataFrame(
        [mart_row("WEEK", d, 6.0, "n"), mart_row("WEEK", d, 0.0, "d"), mart_row("WEEK", d + timedelta(days=7), 6.0, "n")], MART
    )
    keys = ["week_commencing_date", "category", "sub_category"]
    plain = ratio_rows(rows, keys, [Ratio("r", "n", "d")]).collect()
    assert [(r.week_commencing_date, r.metric_value) for r in plain] == [(d, 0.0)]
    assert ratio_rows(rows, keys, [Ratio("r", "n", "d", drop_zero=True)]).count() == 0
    filled = ratio_rows(rows, keys, [Ratio("r", "d", "n", missing=0.0)]).collect()
    assert sorted(r.metric_value for r in filled) == [0.0, 0.0]


def test_ratio_rows_across_sub_categories(spark):
    d = date(2024, 1, 7)
    row = lambda sub, metric, v: ("WEEK", 2024, 1, d, d, "EU", "France", "Trx", sub, metric, v)
    rows = spark.createDataFrame([row("Fee", "Revenue", 5.0), row("Transaction", "Net Sale", 50.0), row("Other", "Revenue", 9.0)], MART)
    ratio = Ratio("Take Rate", "Revenue", "Net Sale", num_sub="Fee", den_sub="Transaction")
    got = ratio_rows(rows, ["week_commencing_date", "category"], [ratio]).collect()
    assert [(r.sub_category, r.metric_name, r.metric_value) for r in got] == [("Fee", "Take Rate", 0.1)]


def test_lag_uses_the_previous_present_row(spark):
    rows = spark.createDataFrame([("s", 1, 10.0), ("s", 2, 20.0), ("s", 4, 40.0)], "k string, d int, v double")
    got = {r.d: r.p for r in lag_previous_present(rows, ["k"], "d", "v", "p").collect()}
    assert got == {1: None, 2: 10.0, 4: 20.0}


def test_week_sum_takes_whole_touched_weeks_only(spark):
    days = [date(2024, 1, 7), date(2024, 1, 8), date(2024, 1, 13), date(2024, 1, 14), date(2024, 1, 22)]
    mart = spark.createDataFrame([mart_row("DAY", d, 1.0) for d in days], MART)
    run = RunParams(date(2024, 1, 8), date(2024, 1, 21))
    got = {r.week_commencing_date: r.metric_value for r in roll_to_week(mart, run).collect()}
    # the week of the 7th is whole though the run starts on the 8th; the week of the 21st has no day in the run
    assert got == {date(2024, 1, 7): 3.0, date(2024, 1, 14): 1.0}


def test_running_sum_restarts_with_the_financial_year_and_keeps_ties(spark):
    w = [date(2024, 2, 18), date(2024, 2, 25), date(2024, 3, 3)]
    rows = [mart_row("WEEK", w[0], 1.0, fy=2023), mart_row("WEEK", w[1], 2.0, fy=2023), mart_row("WEEK", w[2], 5.0, fy=2024)]
    cal = lookups.calendar(spark, date(2022, 1, 1), date(2025, 12, 31))
    got = {r.week_commencing_date: r.metric_value for r in running_ytd(spark.createDataFrame(rows, MART), cal, RunParams(w[0], w[2])).collect()}
    assert got == {w[0]: 1.0, w[1]: 3.0, w[2]: 5.0}
    last = RunParams(w[2], w[2])
    assert [r.metric_value for r in running_ytd(spark.createDataFrame(rows, MART), cal, last).collect()] == [5.0]
    # by calendar year the run touches both financial years
    assert running_ytd(spark.createDataFrame(rows, MART), cal, last, calendar_years=True).count() == 3


SERIES = ["date_scope", "product_pl", "region", "category", "sub_category", "metric_name"]


def compared(spark, rows):
    out = lagged_compare(spark.createDataFrame(rows, MART), SERIES).collect()
    return {(r.date_scope, r.year_month_day): r for r in out}


def test_week_on_week_needs_the_week_before(spark):
    w = [date(2024, 1, 7) + timedelta(weeks=i) for i in range(4)]
    other = [mart_row("WEEK", d, 1.0, "Other") for d in w]
    got = compared(spark, [mart_row("WEEK", w[0], 10.0), mart_row("WEEK", w[2], 30.0), mart_row("WEEK", w[3], 45.0), *other])
    rows = lagged_compare(spark.createDataFrame([mart_row("WEEK", w[0], 10.0), mart_row("WEEK", w[2], 30.0), mart_row("WEEK", w[3], 45.0), *other], MART), SERIES)
    sales = {r.year_month_day: r for r in rows.where("metric_name = 'Gross Sales'").collect()}
    assert (sales[w[2]].wow, sales[w[2]].wow_ratio) == (0.0, 0.0)
    assert (sales[w[3]].wow, sales[w[3]].wow_ratio) == (15.0, 0.5)
    assert len(got) == 4


def test_growth_from_zero_or_less_is_zero(spark):
    w = [date(2024, 1, 7), date(2024, 1, 14)]
    got = compared(spark, [mart_row("WEEK", w[0], -5.0), mart_row("WEEK", w[1], 5.0)])
    assert (got["WEEK", w[1]].wow, got["WEEK", w[1]].wow_ratio) == (10.0, 0.0)


def test_year_on_year_and_year_to_date(spark):
    weeks = [date(2023, 1, 1) + timedelta(weeks=i) for i in range(53)]
    rows = [mart_row(scope, d, float(i + 1)) for scope in ("WEEK", "FYtD") for i, d in enumerate(weeks)]
    got = compared(spark, rows)
    assert got["WEEK", weeks[52]].yoy == 52.0 and got["WEEK", weeks[52]].yoy_ratio == 52.0
    assert got["FYtD", weeks[52]].yoy == 52.0
    assert got["FYtD", weeks[52]].wow is None and got["FYtD", weeks[52]].wow_ratio is None
    # a week missing from the data shifts the week numbers, and the comparison is off
    gap = compared(spark, [r for r in rows if r[3] != weeks[20]])
    assert gap["WEEK", weeks[52]].yoy == 0.0


def test_future_placeholders(spark):
    calendar = lookups.calendar(spark, date(2024, 1, 1), date(2024, 1, 27))
    series = spark.createDataFrame([("WEEK", "Sales"), ("WEEK", "Sales Budget")], "date_scope string, metric_name string")
    got = future_placeholders(series, calendar, date(2024, 1, 10)).collect()
    # the running week has started, so days from the 14th on, and no budget series
    assert sorted(r.year_month_day for r in got) == [date(2024, 1, 14) + timedelta(days=i) for i in range(14)]
    assert {r.metric_name for r in got} == {"Sales"} and all(r.metric_value is None for r in got)


def test_equal_weekdays_spread_a_month_evenly(spark):
    calendar = lookups.plan_calendar(lookups.calendar(spark, date(2023, 1, 1), date(2024, 12, 31)))
    lines = spark.sql(
        "select explode(sequence(date '2023-06-01', date '2024-06-30')) as year_month_day, 7.0D as m_net_sales_amount_gbp"
    )
    weights = weekday_weights(lines, calendar, date(2024, 6, 15))
    assert [r.ratio for r in weights.collect()] == [1.0] * 7
    monthly = spark.createDataFrame([("2024-02", 290.0)], "year_month string, budget double")
    days = spread_budget(monthly, calendar, weights).select(F.col("budget") * F.col("ratio") / F.col("days_month")).collect()
    assert [r[0] for r in days] == [10.0] * 29


def test_incomplete_weeks_are_zeroed(spark):
    rows = [("a", float(i != 3), 5.0) for i in range(7)] + [("b", 1.0, 5.0) for _ in range(7)]
    weekly = complete_weeks_only(spark.createDataFrame(rows, "w string, flag double, m double"), ["w"], ["m"], "flag")
    assert {r.w: r.complete for r in weekly.collect()} == {"a": 0, "b": 1}


def test_calendar(spark):
    rows = {(r.date_scope, r.year_month_day): r for r in lookups.calendar(spark, date(2023, 1, 1), date(2024, 12, 31)).collect()}
    assert rows["WEEK", date(2024, 3, 3)].week_number == 1 and rows["WEEK", date(2024, 3, 3)].financial_year == 2024
    assert rows["DAY", date(2024, 3, 2)].financial_year == 2023
    assert ("WEEK", date(2024, 3, 4)) not in rows


def test_year_to_date_ends_at_the_sum_of_weeks(spark, src, sf_dir):
    from tidemark.plans.store import MartStore

    store = MartStore(spark, sf_dir, src, RUN, CONFIG)
    weeks = store.stored("supply_mart", ["WEEK"]).where("metric_name = 'WBR Gross Sales' and region = 'Total'")
    ends = store.stored("supply_mart", ["FYtD"]).where("metric_name = 'WBR Gross Sales' and region = 'Total'")
    total = {r.financial_year: r.v for r in weeks.groupBy("financial_year").agg(F.sum("metric_value").alias("v")).collect()}
    last = {r.financial_year: r.v for r in ends.groupBy("financial_year").agg(F.max_by("metric_value", "week_number").alias("v")).collect()}
    assert last == pytest.approx(total)


def test_a_shorter_run_repeats_the_longer_ones_rows(src):
    from tidemark.plans.supply import supply_day

    short = replace(RUN, start=date(1998, 3, 4), end=date(1998, 3, 20))
    whole = supply_day(src, RUN, CONFIG).where(F.col("year_month_day").between(short.start, short.end))
    part = supply_day(src, short, CONFIG)
    assert part.exceptAll(whole).count() == 0 and whole.exceptAll(part).count() == 0


def test_chains_of_labels_begin_with_every_subset():
    for n in range(1, 6):
        labels = list("abcde"[:n])
        chains = label_chains(labels)
        assert {frozenset(c[:k]) for c in chains for k in range(1, len(c) + 1)} == {
            frozenset(s) for k in range(1, n + 1) for s in combinations(labels, k)
        }
    assert len(label_chains(list("abc"))) == 3


@pytest.mark.parametrize("labels", [["a"], ["a", "b"], ["a", "b", "c"]])
def test_counted_levels_equal_distinct_counts(spark, labels):
    """Rows that repeat, items and labels that are missing, and a label that is called All."""
    names = ("All", None, "x", "y")
    rows = [(i % 3 or None, (i * 31) % 23 if i % 10 else None, *[names[(i * k) % 4] for k in (1, 3, 7)], float(i)) for i in range(400)]
    df = spark.createDataFrame(rows, "day int, id long, a string, b string, c string, v double")
    df = df.union(df.limit(50)).select("day", "id", *labels, "v")
    want = grouping_levels(df, ["day"], labels, [F.sum("v").alias("v"), F.countDistinct("id").alias("ids")])
    got = count_levels(df, ["day"], labels, "id", "ids", {"v": F.sum("v")})
    assert got.columns == want.columns and got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_levels_multiply_sums_and_not_orders(spark, sf_dir, src):
    """Neither the levels nor the distinct counts repeat order rows: what they expand was aggregated before."""
    for df in (QUERIES["level_sets"](spark, sf_dir), journey_sales(src, RUN, CONFIG)):
        plan = df._jdf.queryExecution().sparkPlan().toString().splitlines()
        at = [n for n, line in enumerate(plan) if "Expand" in line]
        assert at and all("HashAggregate" in next(x for x in plan[n + 1 :] if "Aggregate" in x or "Window" in x) for n in at)
        assert not any("distinct" in line for line in plan) and any("Window" in line for line in plan)


def test_tasks_of_sorted_lines_follow_their_number(spark):
    assert over_all_tasks(spark.range(5 * TASK_ROWS + 1), "id").rdd.getNumPartitions() == 6
    assert over_all_tasks(spark.range(10), "id").rdd.getNumPartitions() == 4


def test_order_lines_are_joined_once_and_lie_by_order(spark, tmp_path):
    """Stored rows are those of the table's SQL, also where keys are missing or repeat, and groupings by order shuffle nothing."""
    line = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    day = datetime(1999, 5, 9)
    tables = {
        "lineitem": spark.createDataFrame(
            [(o, o or 7, o or 8, n, 1.0, 10.0, 0.5, 0.25, "R", "F", day) for o in (1, 2, 2, 3, 9, None) for n in (1, 7)], line
        ),
        "orders": spark.createDataFrame([(1, 10), (1, 11), (2, 10), (3, None), (None, 10), (4, 11)], "o_orderkey long, o_custkey long"),
        "customer": spark.createDataFrame(
            [(10, 1, "MACHINERY"), (11, 2, None), (11, 2, None), (12, 1, "x")], "c_custkey long, c_nationkey int, c_mktsegment string"
        ),
        "nation": spark.createDataFrame([(1, 4), (2, 3), (3, None)], "n_nationkey int, n_regionkey int"),
    }
    for name, df in tables.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    lines = fixture_sources(spark, str(tmp_path)).order_lines
    want = spark.sql(SQL["order_lines"], **tables)
    assert lines.schema == want.schema and lines.count() == want.count() == 10
    assert lines.exceptAll(want).count() == 0 and want.exceptAll(lines).count() == 0
    text = lines.groupBy("year_month_day", "order_id").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and "Join" not in text and "Bucketed: true" in text
    parts = lines_of_orders(*tables.values(), tasks=3)
    assert parts.rdd.getNumPartitions() == 3
