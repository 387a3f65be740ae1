"""Upserts, a whole refresh, and checks that must notice a damaged mart."""

import os
import tempfile
from dataclasses import replace
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.checks import campaigns, monetisation, moved, quality, retention
from tidemark.checks.reconcile import failing, reconcile, tally
from tidemark.operators.compare import weeks_to_read, weeks_to_rebuild
from tidemark.params import RunParams
from tidemark.plans import acquisition, extracts, ytd
from tidemark.plans import monetisation as monetisation_plans
from tidemark.plans import retention as retention_plans
from tidemark.plans.late import LateDays
from tidemark.plans.refresh import MARTS, METRIC_MARTS, refresh
from tidemark.plans.reports import breakout_report
from tidemark.plans.store import MartStore
from tidemark.schema import MART_KEY, OVERVIEW_KEY
from tidemark.sinks.upsert import alone, merge_rows, read_parts, read_table, upsert
from tidemark.sources.catalog import FACTS, LOOKUPS, Sources
from tidemark.sources.fixtures import CONFIG, RUN

TABLE = "k string, week_commencing_date date, v double, note string"
W1, W2 = date(2024, 1, 7), date(2024, 1, 14)


@pytest.fixture(scope="module")
def store(spark, src, sf_dir):
    return MartStore(spark, sf_dir, src, RUN, CONFIG)


def test_merge_updates_only_the_update_columns(spark):
    old = spark.createDataFrame([("a", W1, 1.0, "old"), (None, W1, 9.0, "old")], TABLE)
    new = spark.createDataFrame([("a", W1, 2.0, "new"), ("b", W1, 3.0, "new"), (None, W1, 8.0, "new")], TABLE).withColumn("extra", F.lit(1))
    got = {tuple(r) for r in merge_rows(old, new, ["k", "week_commencing_date"], ["v"]).collect()}
    assert got == {
        ("a", W1, 2.0, "old", 1), ("b", W1, 3.0, "new", 1), (None, W1, 9.0, "old", None), (None, W1, 8.0, "new", 1),
    }


def test_upsert_is_idempotent_and_leaves_other_weeks_alone(spark):
    path = tempfile.mkdtemp(prefix="run-", dir="/tmp") + "/table"
    key = ["k", "week_commencing_date"]
    upsert(path, spark.createDataFrame([("a", W1, 1.0, "x"), ("a", W2, 1.0, "x")], TABLE), key, ["v"])
    change = spark.createDataFrame([("a", W1, 5.0, "y"), ("b", W1, 6.0, "y")], TABLE)
    want = {("a", W1, 5.0, "x"), ("b", W1, 6.0, "y"), ("a", W2, 1.0, "x")}
    second_week = lambda: [f for f in spark.read.parquet(path).inputFiles() if f"={W2}" in f]
    untouched = second_week()
    for _ in range(2):
        upsert(path, change, key, ["v"])
        got = [tuple(r) for r in spark.read.parquet(path).select("k", "week_commencing_date", "v", "note").collect()]
        assert sorted(got) == sorted(want)
    assert untouched and second_week() == untouched


def fresh() -> str:
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def test_upsert_keeps_rows_without_a_week(spark):
    path, key = fresh() + "/table", ["k", "week_commencing_date"]
    for k in ("a", "b"):
        upsert(path, spark.createDataFrame([(k, None, 1.0, "x"), (k, W1, 2.0, "x")], TABLE), key, ["v"])
    got = sorted((r.k, str(r.week_commencing_date)) for r in read_table(spark, path).collect())
    assert got == [("a", "2024-01-07"), ("a", "None"), ("b", "2024-01-07"), ("b", "None")]


def test_upsert_keeps_a_column_that_drifted_in(spark):
    path, key = fresh() + "/table", ["k", "week_commencing_date"]
    rows = spark.createDataFrame([("a", W1, 1.0, "x"), ("b", W1, 1.0, "x"), ("c", W2, 1.0, "x")], TABLE)
    upsert(path, rows, key, None)
    upsert(path, rows.where("k = 'a'").withColumn("extra", F.lit(7)), key, ["v"])
    upsert(path, rows.withColumn("v", F.lit(5.0)), key, None)
    got = {r.k: (r.v, r.extra) for r in read_table(spark, path).collect()}
    assert got == {"a": (5.0, 7), "b": (5.0, None), "c": (5.0, None)}


def test_upsert_refuses_repeated_keys_at_every_write(spark):
    path, key = fresh() + "/table", ["k", "week_commencing_date"]
    twice = spark.createDataFrame([("a", W1, 1.0, "x"), ("a", W1, 2.0, "x")], TABLE)
    with pytest.raises(ValueError, match="repeat keys"):
        upsert(path, twice, key)
    upsert(path, twice.limit(1), key, ["v"])
    with pytest.raises(ValueError, match="repeat keys"):
        upsert(path, twice, key)
    assert read_table(spark, path).count() == 1


def test_upsert_stages_under_names_of_its_own_and_cleans_up(spark):
    folder = fresh()
    rows = spark.createDataFrame([("a", W1, 1.0, "x")], TABLE)
    for _ in range(2):
        assert upsert(folder + "/table", rows, ["k", "week_commencing_date"], ["v"], staging=folder + "/staged") == [W1]
    staged = [f for _, _, files in os.walk(folder + "/staged") for f in files]
    assert staged == [] and sorted(os.listdir(folder)) == ["staged", "table"]


def test_upsert_lists_and_reads_its_own_weeks_only(spark):
    path, key = fresh() + "/table", ["k", "week_commencing_date"]
    rows = spark.createDataFrame([("a", W1, 1.0, "x"), ("a", W2, 1.0, "x"), ("n", None, 1.0, "x")], TABLE)
    upsert(path, rows, key, ["v"])
    other = f"{path}/week_commencing_date={W2}/part-broken.parquet"
    with open(other, "wb") as f:
        f.write(b"no footer")  # whoever opens a file of this week fails
    change = rows.where(F.col("week_commencing_date") == F.lit(W1))
    assert upsert(path, change.withColumns({"v": F.lit(3.0), "extra": F.lit(1)}), key, None) == [W1]
    own = read_parts(spark, path, read_table(spark, path).schema, "week_commencing_date", [W1, None, date(2030, 1, 6)])
    assert {f.split("/")[-2] for f in own.inputFiles()} == {f"week_commencing_date={W1}", "week_commencing_date=__HIVE_DEFAULT_PARTITION__"}
    assert {(r.k, r.v, r.extra) for r in own.collect()} == {("a", 3.0, 1), ("n", 1.0, None)}
    read_table(spark, path).explain("formatted")  # planning opens no footer either
    os.remove(other)
    assert read_table(spark, path).count() == 3


def test_columns_are_described_once_and_keep_their_types(spark):
    path, key = fresh() + "/table", ["k", "week_commencing_date"]
    rows = spark.createDataFrame([("a", W1, 1.0, "x")], TABLE)
    for _ in range(2):
        upsert(path, rows, key, None)
    upsert(path, rows.withColumn("extra", F.lit(1)), key, None)
    assert sorted(f for f in os.listdir(f"{path}/_columns") if not f.startswith(".")) == ["0.json", "1.json"]
    with pytest.raises(ValueError, match="column v is double in the table, string"):
        upsert(path, rows.withColumn("v", F.lit("x")), key, None)
    assert read_table(spark, path).columns == ["k", "v", "note", "extra", "week_commencing_date"]


def test_a_table_from_before_descriptions_gets_one(spark):
    path, key = fresh() + "/table", ["k", "week_commencing_date"]
    rows = spark.createDataFrame([("a", W1, 1.0, "x"), ("b", W2, 1.0, "x")], TABLE)
    rows.where("k = 'a'").write.partitionBy("week_commencing_date").parquet(path)
    rows.where("k = 'b'").withColumn("extra", F.lit(2)).write.mode("append").partitionBy("week_commencing_date").parquet(path)
    upsert(path, rows.where("k = 'a'").withColumn("v", F.lit(4.0)), key, None)
    assert {(r.k, r.v, r.extra) for r in read_table(spark, path).collect()} == {("a", 4.0, None), ("b", 1.0, 2)}


def test_two_upserts_of_one_week_at_once_are_refused(spark):
    path, key = fresh() + "/table", ["k", "week_commencing_date"]
    rows = spark.createDataFrame([("a", W1, 1.0, "x"), ("a", W2, 1.0, "x")], TABLE)
    first, second = (rows.where(F.col("week_commencing_date") == F.lit(w)) for w in (W1, W2))
    upsert(path, rows, key, None)
    with alone(spark, path, [f"week_commencing_date={W1}"]):
        with pytest.raises(RuntimeError, match="is being written by"):
            upsert(path, first, key, None)
        upsert(path, second.withColumn("v", F.lit(2.0)), key, None)  # another week goes on
    upsert(path, first.withColumn("v", F.lit(3.0)), key, None)
    assert {r.v for r in read_table(spark, path).collect()} == {2.0, 3.0}
    assert os.listdir(f"{path}/_writing") == []


def test_store_tells_runs_of_one_label_apart(spark, src):
    run = RunParams(date(1999, 5, 9), date(1999, 5, 15), as_of=RUN.as_of)
    long = MartStore(spark, "one label", src, replace(RUN, run_ts=datetime(2024, 1, 1)), CONFIG).stored("supply_mart", ["DAY"])
    short = MartStore(spark, "one label", src, run, CONFIG).stored("supply_mart", ["DAY"])
    assert 0 < short.count() < long.count()
    assert short.agg(F.max("year_month_day")).first()[0] <= run.end


def test_a_run_past_the_calendar_is_refused(spark, src):
    beyond = RunParams(date(2025, 12, 1), date(2026, 1, 15))
    with pytest.raises(ValueError, match="calendar runs from"):
        MARTS["supply_mart"].day(src, beyond, CONFIG)


ONE_WEEK = RunParams(date(1999, 5, 9), date(1999, 5, 15), as_of=RUN.as_of)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def scans(df, needle: str) -> list[str]:
    """The file scans of the formatted plan that mention ``needle``."""
    text = df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    parts = [part.strip() for part in text.split("\n\n")]
    return [part for part in parts if "Scan parquet" in part.split("\n")[0] and needle in part]


def test_weekly_customers_scan_is_bounded_by_literal_dates(spark, src):
    stored = fresh() + "/lines"
    src.order_lines.where(F.col("year_month_day") < F.lit(date(1996, 1, 1))).write.parquet(stored)
    tables = {n: getattr(src, n) for n in ("calendar", "customer_accounts", "region_map")}
    own = Sources({**tables, "order_lines": spark.read.parquet(stored)})
    weeks = ONE_WEEK.first_week, ONE_WEEK.last_week + timedelta(days=6)
    found = scans(extracts.purchase_lines(own, ONE_WEEK, CONFIG, *weeks), "product_issued_date")
    assert found
    for part in found:
        for column in ("year_month_day", "product_issued_date"):
            assert f"GreaterThanOrEqual({column},1999-05-09)" in part and f"LessThanOrEqual({column},1999-05-15)" in part
    counts = acquisition.customer_totals(own, ONE_WEEK, CONFIG, "week_commencing_date")
    assert counts.columns and not scans(counts, stored)  # the week is a union of stored sets


@pytest.mark.parametrize("mart", [*METRIC_MARTS, "budget_mart"])
def test_week_and_year_to_date_read_only_their_partitions(spark, src, store, mart):
    path, m = fresh() + "/mart", MARTS[mart]
    rows = store.stored(mart, ["DAY"] if mart == "budget_mart" else ["DAY", "WEEK"])
    rows.limit(200).write.partitionBy("week_commencing_date").parquet(path)
    for build in filter(None, (m.week, m.fytd)):
        own = scans(build(spark.read.parquet(path), src, ONE_WEEK, CONFIG), path)
        assert own
        for part in own:
            filters = next(x for x in part.split("\n") if x.startswith("PartitionFilters"))
            assert "week_commencing_date" in filters and ">= 199" in filters and "<= " in filters, part


def test_one_week_rebuilds_that_week_and_those_compared_with_it(spark, src, store):
    folder = fresh()
    weeks = lambda name: {f.split("week_commencing_date=")[1].split("/")[0]: f for f in sorted(read_table(spark, f"{folder}/{name}").inputFiles())}
    run = RunParams(date(1999, 4, 25), date(1999, 5, 29), as_of=RUN.as_of)
    refresh(spark, src, run, folder, CONFIG, scopes=("DAY", "WEEK"))
    reports = ("breakout_report", "overview_status", "dashboard")
    before = {name: weeks(name) for name in reports}
    refresh(spark, src, replace(ONE_WEEK, run_ts=datetime(2024, 5, 5)), folder, CONFIG, marts=["supply_mart"], scopes=("DAY", "WEEK"))
    for name in reports:
        after = weeks(name)
        changed = {w for w in after if after[w] != before[name].get(w)}
        # weeks of budgets reach a year ahead in the reports; the dashboard shows weeks with daily rows only
        assert changed == {"1999-05-09", "1999-05-16", "2000-05-07"} & set(after) and set(after) == set(before[name])
    assert "2000-05-07" in before["breakout_report"]
    whole = {n: read_table(spark, f"{folder}/{n}") for n in METRIC_MARTS}
    again = breakout_report(whole, run).drop("last_modified")
    held = read_table(spark, f"{folder}/breakout_report").drop("last_modified").select(*again.columns)
    assert again.exceptAll(held).count() == 0 and held.exceptAll(again).count() == 0


def test_weeks_to_rebuild():
    w = [date(2023, 1, 1) + timedelta(weeks=i) for i in range(110)]
    assert weeks_to_rebuild([w[10]], w) == [w[10], w[11], w[62]]
    assert weeks_to_rebuild([w[109]], w[:109]) == [w[109]]
    gap = w[:10] + w[11:]
    assert weeks_to_rebuild([w[10]], gap) == w[10:63]
    assert weeks_to_read([w[60]]) == [w[8], w[59], w[60]]


def test_plans_hold_no_dealt_facts_nested_loops_or_multiplied_lines(spark, src, sf_dir):
    for build in (monetisation_plans.monetisation_day, retention_plans.retention_day):
        plan = plan_of(build(src, RUN, CONFIG))
        assert "REPARTITION_BY_NUM" not in plan and "NestedLoop" not in plan
    assert "Expand" not in plan_of(retention_plans.journey_totals(src, RUN, CONFIG))


def test_one_scan_of_the_order_lines(spark, src, store):
    """The marts and checks that count orders and customers share one stored extract, read once from the lines."""
    path = fresh() + "/lines"
    src.order_lines.where(F.col("year_month_day") < F.lit(date(1996, 1, 1))).write.parquet(path)
    own = Sources({**{n: (lambda n=n: getattr(src, n)) for n in (*FACTS, *LOOKUPS)}, "order_lines": spark.read.parquet(path)})
    mart = store.stored("retention_mart", ["DAY"])
    plans = {
        "retention": retention_plans.retention_day(own, RUN, CONFIG), "monetisation": monetisation_plans.monetisation_day(own, RUN, CONFIG),
        **{j: retention.journey_check(j, mart, own, RUN, CONFIG) for j in retention.JOURNEYS},
    }
    lines = {name: len(scans(df, path)) for name, df in plans.items()}
    assert lines == {"retention": 0, "monetisation": 1, **{j: 0 for j in retention.JOURNEYS}}
    stored = {f.rsplit("/", 1)[0] for df in plans.values() for f in df.inputFiles() if "/order-rows-" in f}
    assert len(stored) == 1
    before = plans["leisure"].count()
    own.drop_kept(spark)
    assert not os.path.exists(stored.pop().removeprefix("file:"))
    assert retention.journey_check("leisure", mart, own, RUN, CONFIG).count() == before


def test_refresh_writes_marts_and_reports(spark, src):
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    run = RunParams(date(1999, 5, 9), date(1999, 5, 22), as_of=RUN.as_of, run_ts=datetime(2024, 5, 1))
    first = refresh(spark, src, run, folder, CONFIG)
    rows = {name: df.count() for name, df in first.items()}
    assert all(rows.values()) and set(rows) >= {"breakout_report", "overview_status", "dashboard", "budget_mart"}
    again = refresh(spark, src, replace(run, run_ts=datetime(2024, 5, 2)), folder, CONFIG, marts=["supply_mart"], with_reports=False)
    assert again["supply_mart"].count() == rows["supply_mart"]
    assert again["supply_mart"].groupBy(*MART_KEY).count().where("count > 1").count() == 0
    assert {r[0] for r in again["supply_mart"].select("last_modified").distinct().collect()} == {datetime(2024, 5, 2)}
    assert os.path.isdir(f"{folder}/_ytd/supply_mart")
    long = replace(run, start=date(1998, 1, 4), run_ts=datetime(2024, 5, 3))  # a backfill does not carry
    refresh(spark, src, long, folder, CONFIG, marts=["supply_mart"], scopes=("FYtD",), with_reports=False)
    assert not os.path.exists(f"{folder}/_ytd/supply_mart")


def test_reconcile_notices_differences_and_missing_sides(spark):
    mart = spark.createDataFrame([("a", 10.0), ("b", 10.4), ("c", 1.0)], "k string, mart_value double")
    source = spark.createDataFrame([("a", 10.6), ("b", 10.0), ("d", 1.0)], "k string, source_value double")
    exact = {r.k: r.failed for r in reconcile(mart, source, ["k"], whole_numbers=True).collect()}
    assert exact == {"a": True, "b": False, "c": True, "d": True}
    inner = reconcile(mart, source, ["k"], 1.0, True, "inner")
    assert failing(inner).count() == 0 and tally(inner, ["failed"]).first().compared == 2


def damaged(mart, condition):
    return mart.withColumn("metric_value", F.when(condition, F.col("metric_value") + 1000).otherwise(F.col("metric_value")))


def test_campaign_checks_pass_on_the_mart_and_fail_on_a_damaged_one(store):
    mart = store.whole("acquisition_mart")
    for name in ("campaign_day", "incremental_sales_summary", "marketing_spend_week", "clicks_summary"):
        check = campaigns.CHECKS[name]
        run = lambda m: failing(campaigns.campaign_check(check, m, store.src, store.p, store.cfg)).count()  # noqa: E731, B023
        assert run(mart) == 0, name
        assert run(damaged(mart, F.col("region") == "RoE")) > 0, name


def test_monetisation_checks(store):
    mart = store.stored("monetisation_mart", ["DAY"])
    bad = damaged(mart, F.col("region") == "France")
    for name in ("booking_fee_take_rate", "refund_fee_revenue", "mcp_coverage"):
        run = lambda m: failing(monetisation.fee_check(name, m, store.src, store.p, store.cfg)).count()  # noqa: E731, B023
        assert run(mart) == 0 and run(bad) > 0, name
    ads = lambda m: failing(monetisation.ads_check("CPM", m, store.src, store.p)).count()
    assert ads(mart) == 0 and ads(damaged(mart, F.col("sub_category") == "Ads")) > 0


def test_retention_checks(store):
    mart = store.stored("retention_mart", ["DAY"])
    assert failing(retention.lifecycle_check("Early Life", mart, store.src, store.p)).count() == 0
    assert failing(retention.journey_check("leisure", mart, store.src, store.p, store.cfg)).count() == 0
    assert failing(retention.journey_check("summary", mart, store.src, store.p, store.cfg, coarse=True)).count() == 0
    bad = damaged(mart, F.col("region") == "France")
    assert failing(retention.lifecycle_check("Early Life", bad, store.src, store.p)).count() > 0
    assert failing(retention.journey_check("leisure", bad, store.src, store.p, store.cfg)).count() > 0
    weekly = store.stored("retention_mart", ["WEEK"])
    assert failing(retention.lifecycle_check("Retained", weekly, store.src, store.p, "WEEK")).count() == 0


def test_quality_checks_notice_bad_tables(store):
    mart = store.stored("supply_mart", ["DAY"])
    assert quality.unique_key_check(mart, MART_KEY).count() == 0
    assert quality.unique_key_check(mart.unionAll(mart), MART_KEY).count() == mart.count()
    hollow = mart.withColumn("category", F.when(F.col("region") == "Total", F.lit(None)).otherwise(F.col("category")))
    assert quality.completeness_check(hollow, "category", RUN).first().failed
    assert not quality.completeness_check(mart, "category", RUN).first().failed
    assert failing(quality.not_null_check({"m": hollow})).first().column_name == "category"
    odd = mart.withColumn("region", F.lit("Atlantis"))
    assert failing(quality.accepted_values_check({"m": odd})).first().value == "Atlantis"
    assert quality.distinct_count_check({"m": odd}).first().failed
    added_up = store.whole("supply_mart")
    bad = damaged(added_up, F.col("region") == "RoE")
    assert failing(quality.foreign_travel_check("supply_mart", added_up)).count() == 0
    assert failing(quality.foreign_travel_check("supply_mart", bad)).count() > 0


def test_margin_after_spend_is_judged_where_no_region_lacks_a_row(spark):
    columns = "date_scope string, financial_year int, year_month_day date, week_commencing_date date, product_pl string, region string, category string, sub_category string, metric_name string, metric_value double"
    parts = ("Inbound", "RoE", "UK>EU")

    def rows(scope, day, values, total, week=None, year=2024):
        named = [*zip(parts, values), ("Foreign Travel", total)]
        return [(scope, year, day, week or day, "EU", r, "All", "All", "GM - PMS", v) for r, v in named if v is not None]

    table = [
        *rows("DAY", W1, (100.0, 200.0, 300.0), 600.0), *rows("WEEK", W1, (100.0, 200.0, 300.0), 600.0), *rows("FYtD", W1, (100.0, 200.0, 300.0), 650.0),
        *rows("DAY", W2, (100.0, None, 300.0), 900.0), *rows("WEEK", W2, (100.0, 50.0, 300.0), 900.0), *rows("FYtD", W2, (200.0, 250.0, 600.0), 1500.0),
        *rows("DAY", W2 + timedelta(days=1), (1.0, 50.0, 1.0), 90.0, W2),
    ]
    found = quality.foreign_travel_check("acquisition_mart", spark.createDataFrame(table, columns)).collect()
    assert {(r.date_scope, r.year_month_day): (r.status, r.failed) for r in found} == {
        ("DAY", W1): ("compared", False), ("WEEK", W1): ("compared", False), ("FYtD", W1): ("compared", True),
        ("DAY", W2): ("parts lacking", False), ("WEEK", W2): ("parts lacking", False), ("FYtD", W2): ("parts lacking", False),
        ("DAY", W2 + timedelta(days=1)): ("compared", True),
    }


def test_year_to_date_is_carried_from_the_week_that_changed(spark, src, store):
    """Runs over single weeks, in any order, with series that come, change and leave gaps: as adding up anew, week by week."""
    folder = fresh()
    path, state = folder + "/supply_mart", folder + "/_ytd/supply_mart"
    cfg = replace(CONFIG, ytd_state=(path, state))
    weekly = store.stored("supply_mart", ["WEEK"]).where(F.col("week_commencing_date").between(F.lit(date(1998, 8, 2)), F.lit(date(1999, 9, 5)))).where("region in ('France', 'RoE')")
    keys = ["week_commencing_date", "region", "metric_name"]
    thin = weekly.where(F.pmod(F.xxhash64(*keys), F.lit(3)) > 0)
    week = F.col("week_commencing_date")
    steps = [
        (thin.where(week < F.lit(date(1999, 2, 7))), RunParams(date(1998, 8, 2), date(1999, 2, 6))),
        (thin.where(week == F.lit(date(1999, 2, 7))), RunParams(date(1999, 2, 7), date(1999, 2, 13))),
        (weekly.where(week == F.lit(date(1998, 10, 11))).withColumn("metric_value", F.col("metric_value") * 2), RunParams(date(1998, 10, 13), date(1998, 10, 14))),
        (weekly.where(week == F.lit(date(1998, 11, 8))), None),  # written without carrying: the next run of the year must see it
        (weekly.where(week == F.lit(date(1999, 1, 3))), RunParams(date(1999, 1, 3), date(1999, 1, 9))),
        (weekly.where(week == F.lit(date(1999, 5, 9))), RunParams(date(1999, 5, 9), date(1999, 5, 15))),
    ]
    for rows, run in steps:
        upsert(path, rows)
        if run is None:
            continue
        run = replace(run, as_of=RUN.as_of)
        carried = MARTS["supply_mart"].fytd(read_table(spark, path), src, run, cfg)
        upsert(path, carried)
        ytd.remember(spark, path, state, src.calendar, run)
        stored = read_table(spark, path)
        whole = MARTS["supply_mart"].fytd(stored, src, replace(RUN, start=date(1998, 8, 2), end=date(1999, 9, 11)), CONFIG).drop("last_modified")
        held = stored.where("date_scope = 'FYtD'").drop("last_modified").select(*whole.columns)
        years = [r[0] for r in held.select("financial_year").distinct().collect()]
        whole = whole.where(F.col("financial_year").isin(years))
        assert held.count() > 0 and whole.exceptAll(held).count() == 0 and held.exceptAll(whole).count() == 0
    # a run of one week reads that week's rows, the state of the week before, and what lies behind
    one = replace(run, start=date(1999, 2, 7), end=date(1999, 2, 13))
    found = ytd.carried_ytd(read_table(spark, path), path, state, src.calendar, one)
    assert min(f.split("week_commencing_date=")[1][:10] for f in found.inputFiles()) == "1999-02-07"
    assert [p for p in scans(found, path + "/") if "PartitionFilters" not in p] == []


def test_checks_look_at_moved_weeks_only(spark):
    path, key = fresh() + "/table", ["k", "week_commencing_date"]
    note = path + "/_checked/keys"
    rows = spark.createDataFrame([("a", W1, 1.0, "x"), ("b", W1, 1.0, "x"), ("a", W2, 1.0, "x")], TABLE)
    upsert(path, rows, key, None)
    check = lambda: moved.unique_keys_where_moved(spark, note, path, key)
    weeks, found = check()
    assert weeks == [W1, W2] and {(r.week_commencing_date, r.records, r.failed) for r in found.collect()} == {(W1, 2, False), (W2, 1, False)}
    weeks, found = check()
    assert weeks == [] and found.count() == 0 and not found.inputFiles()
    upsert(path, rows.where("k = 'b'"), key, None)  # other files, the same rows
    assert check()[0] == [] and check()[0] == []
    rows.where(F.col("week_commencing_date") == F.lit(W2)).write.mode("append").partitionBy("week_commencing_date").parquet(path)
    for _ in range(2):  # until it is mended
        weeks, found = check()
        assert weeks == [W2] and [(r.records, r.repeated_keys, r.failed) for r in found.collect()] == [(2, 1, True)]
        assert {f.split("/")[-2] for f in found.inputFiles()} == {f"week_commencing_date={W2}"}


def test_reports_are_compared_where_they_or_the_mart_moved(spark, store):
    folder, v1, v2 = fresh(), date(1999, 5, 9), date(1999, 5, 16)
    mart = store.whole("acquisition_mart").where(F.col("week_commencing_date").isin(v1, v2))
    upsert(f"{folder}/mart", mart)
    upsert(f"{folder}/report", store.report("overview_status").where(F.col("week_commencing_date").isin(v1, v2)), OVERVIEW_KEY, None)
    check = lambda: moved.report_where_moved(spark, f"{folder}/_checked/overview", f"{folder}/report", f"{folder}/mart", RUN, False)
    weeks, found = check()
    assert weeks == [v1, v2] and found.count() > 0 and found.where("failed").count() == 0
    assert check()[0] == []
    upsert(f"{folder}/mart", damaged(mart.where(F.col("week_commencing_date") == F.lit(v2)), F.lit(True)))
    weeks, found = check()
    assert weeks == [v2] and found.where("failed").count() > 0


def test_fingerprints_ignore_order_and_stamps(spark):
    rows = spark.createDataFrame([(i % 3, W1 if i % 2 else W2, float(i)) for i in range(50)], "k int, week_commencing_date date, v double")
    a = moved.fingerprints(rows.withColumn("last_modified", F.lit(1)))
    b = moved.fingerprints(rows.orderBy(F.desc("v")).repartition(5).withColumn("last_modified", F.lit(2)).select("last_modified", "v", "k", "week_commencing_date"))
    assert a.exceptAll(b).count() == 0 and a.count() == 2
    assert moved.fingerprints(rows.where("v < 49")).exceptAll(a).count() == 1


def test_a_late_row_changes_only_its_weeks(spark, src):
    """Two runs; between them lines of one day come late. As a run over the whole look-back, other weeks' files untouched."""
    day, late = F.col("year_month_day"), date(1999, 4, 20)
    tables = {n: (lambda n=n: getattr(src, n)) for n in (*FACTS, *LOOKUPS)}
    runs = [RunParams(date(1999, 3, 14), date(1999, 5, 8), as_of=RUN.as_of), replace(ONE_WEEK, run_ts=datetime(2024, 5, 5))]
    thin = Sources({**tables, "order_lines": src.order_lines.where((day != F.lit(late)) | (F.col("order_id") % 2 == 0))})
    full = Sources(tables)
    folders = {only: fresh() for only in (True, False)}
    files, built = {}, []
    for only, folder in folders.items():
        run = lambda own, p: refresh(spark, own, p, folder, CONFIG, ["retention_mart"], ["DAY"], with_reports=False, changed_days_only=only)  # noqa: E731, B023
        run(thin, runs[0])
        before = set(read_table(spark, folder + "/retention_mart").inputFiles())
        if only:
            built.append(LateDays(spark, full, runs[1], CONFIG, folder).days)
        run(full, runs[1])
        after = set(read_table(spark, folder + "/retention_mart").inputFiles())
        files[only] = {f.split("week_commencing_date=")[1][:10] for f in after - before}
    assert built == [(late,)] and files[True] == {"1999-04-18", "1999-05-09"} and len(files[False]) > 5
    own, whole = (read_table(spark, folders[only] + "/retention_mart").drop("last_modified") for only in (True, False))
    assert own.count() > 0 and own.exceptAll(whole).count() == 0 and whole.exceptAll(own).count() == 0
    assert LateDays(spark, full, runs[1], CONFIG, folders[True]).days == ()
