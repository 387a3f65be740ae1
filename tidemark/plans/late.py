"""Which days of the look-back have changed since the run before, so that only those are built again.

Orders are amended and refunded for weeks, so a run looks back over its lines. Most of those days are as
they were: a fingerprint of each day's lines, kept beside the marts, tells which are not. Taking it
scans the look-back once and shuffles a row per day and task; the marts then aggregate the days that
changed instead of all of them.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.calendar import in_run
from tidemark.params import MartConfig, RunParams
from tidemark.plans.common import qualifying_lines
from tidemark.sinks.weeks import newest_note, write_note
from tidemark.sources.catalog import Sources


def day_fingerprints(lines: DataFrame) -> DataFrame:
    """Lines and sum of line hashes per day; equal for equal lines in any order."""
    return lines.groupBy("year_month_day").agg(
        F.count("*").alias("records"), F.sum(F.xxhash64(*sorted(lines.columns)).cast("decimal(38,0)")).cast("string").alias("hashes")
    )


class LateDays:
    """The note of one folder of marts on the lines its days were built from."""

    def __init__(self, spark: SparkSession, src: Sources, p: RunParams, cfg: MartConfig, folder: str):
        self.spark, self.path = spark, f"{folder}/_late/order_lines"
        self.number, held = newest_note(spark, self.path)
        self.first, self.last = p.start - timedelta(days=cfg.line_lookback_days), p.end
        lines = qualifying_lines(src, cfg).where(in_run(F.col("year_month_day"), p, cfg.line_lookback_days))
        # a row per day of the run and its look-back
        self.now = {str(r.year_month_day): [r.records, r.hashes] for r in day_fingerprints(lines).collect()}
        before = {d: x for d, x in held.items() if self.first <= date.fromisoformat(d) < p.start}
        back = {d: x for d, x in self.now.items() if date.fromisoformat(d) < p.start}
        changed = [d for d in {*before, *back} if before.get(d) != back.get(d)]
        #: days before the run to be built again; None if nothing is known of them
        self.days = tuple(sorted(map(date.fromisoformat, changed))) if self.number >= 0 else None
        self.held = held

    def remember(self) -> None:
        """Note the lines the marts have been built from, once they are written; days past any look-back are let go."""
        later = {d: x for d, x in self.held.items() if date.fromisoformat(d) > self.last}
        write_note(self.spark, self.path, self.number, later | self.now)
