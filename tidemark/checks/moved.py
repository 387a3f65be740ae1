"""Checks over stored tables that look only at weeks whose content has moved since they passed.

Beside the tables a note per check holds, for each table and week that passed, the names and sizes of
its files and a fingerprint of its rows: their number and the sum of their hashes, whatever their order.
A run lists the weeks; where files are others than noted it takes the fingerprint; where that differs
too, the week is checked. An unchanged table is not read at all, a week written again with the same
rows is read once, a week that fails is looked at again until it passes.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.checks.quality import report_check
from tidemark.params import RunParams
from tidemark.schema import PARTITION
from tidemark.sinks.columns import columns_of
from tidemark.sinks.upsert import read_parts
from tidemark.sinks.weeks import newest_note, signature, stored_weeks, write_note

#: columns that say when a row was written, not what it is
STAMPS = ("last_modified",)


def fingerprints(table: DataFrame) -> DataFrame:
    """Rows and sum of row hashes per week; equal for equal rows in any order."""
    columns = sorted(c for c in table.columns if c not in STAMPS)
    return table.groupBy(PARTITION).agg(
        F.count("*").alias("records"), F.sum(F.xxhash64(*columns).cast("decimal(38,0)")).cast("string").alias("hashes")
    )


def weeks_of(rows: DataFrame) -> DataFrame:
    """Weeks of check rows, by their week or else their day."""
    day = F.col("year_month_day")
    week = F.col(PARTITION) if PARTITION in rows.columns else F.date_sub(day, F.dayofweek(day) - 1)
    return rows.select(week.alias(PARTITION)).distinct()


def check_moved(
    spark: SparkSession, note: str, tables: dict[str, str], check: Callable[[dict[str, DataFrame]], DataFrame]
) -> tuple[list[date], DataFrame]:
    """The weeks that have moved in any of ``tables`` (paths by name), and the rows of ``check`` over those weeks alone.

    ``check`` gets the tables cut to the weeks and returns rows with ``failed`` and a week or day. Weeks
    without a failed row are noted in ``note`` as passed.
    """
    number, passed = newest_note(spark, note)
    held = {name: passed.get(name, {}) for name in tables}
    found = {name: {str(w): signature(spark, path, w) for w in stored_weeks(spark, path)} for name, path in tables.items()}
    columns = {name: columns_of(spark, path) for name, path in tables.items()}
    cut = lambda name, weeks: read_parts(spark, tables[name], columns[name][1], PARTITION, weeks)
    moved: set[str] = set()
    for name, weeks in found.items():
        other = [w for w, files in weeks.items() if held[name].get(w, [None])[0] != files]
        prints = {str(r[0]): [r.records, r.hashes] for r in fingerprints(cut(name, [date.fromisoformat(w) for w in other])).collect()} if other else {}
        gone = [w for w in held[name] if w not in weeks]
        moved |= {w for w in other if held[name].get(w, [None, None])[1] != prints.get(w)} | set(gone)
        held[name] = {w: held[name][w] for w in held[name] if w not in gone} | {w: [weeks[w], prints.get(w)] for w in other}
    weeks = sorted(date.fromisoformat(w) for w in moved)
    rows = check({name: cut(name, weeks) for name in tables})
    failed = {str(r[0]) for r in weeks_of(rows.where("failed")).collect()} if weeks else set()
    write_note(spark, note, number, {name: {w: x for w, x in seen.items() if w not in failed} for name, seen in held.items()})
    return weeks, rows


def keys_by_week(table: DataFrame, key: list[str]) -> DataFrame:
    """Rows and repeated keys per week; ``key`` holds the week, so a key never crosses weeks."""
    copies = table.groupBy(*key).agg(F.count("*").alias("copies"))
    repeated = F.count(F.when(F.col("copies") > 1, 1))
    return copies.groupBy(PARTITION).agg(
        F.sum("copies").alias("records"), repeated.alias("repeated_keys"), (repeated > 0).alias("failed")
    )


def unique_keys_where_moved(spark: SparkSession, note: str, path: str, key: list[str]) -> tuple[list[date], DataFrame]:
    return check_moved(spark, note, {"table": path}, lambda t: keys_by_week(t["table"], key))


def report_where_moved(spark: SparkSession, note: str, report: str, mart: str, p: RunParams, labelled: bool) -> tuple[list[date], DataFrame]:
    """Report rows beside the mart rows they repeat, for weeks that moved in either."""
    return check_moved(spark, note, {"report": report, "mart": mart}, lambda t: report_check(t["report"], t["mart"], p, labelled))
