"""The tables a run reads."""

from __future__ import annotations

from collections.abc import Callable, Hashable, Mapping

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import drop_table, scratch_table

FACTS = (
    "order_lines", "marketing", "customer_accounts", "journey_searches", "growth_summary", "weekly_budget",
    "monthly_budget", "ad_report", "hotel_feed", "hotel_manual", "web_events", "payback",
)
LOOKUPS = ("calendar", "plan_calendar", "region_map", "countries", "country_names", "fx_rates")


_KEPT: dict[tuple, str] = {}


class Sources:
    """Named source tables, each opened on first use.

    A table is given as a DataFrame or as a function returning one. Nothing is read until a
    plan asks for it, and Catalyst prunes columns and pushes filters into each scan.
    """

    def __init__(self, tables: Mapping[str, DataFrame | Callable[[], DataFrame]], label: str | None = None):
        """Sources of one ``label`` hold the same rows for as long as the application lives, and share what is kept."""
        unknown = set(tables) - set(FACTS) - set(LOOKUPS)
        if unknown:
            raise ValueError(f"unknown source tables {sorted(unknown)}")
        self._tables = dict(tables)
        self._label = label
        self._kept: dict[tuple, str] = _KEPT if label is not None else {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._tables:
            raise AttributeError(f"source table {name!r} was not provided")
        table = self._tables[name]
        if callable(table) and not isinstance(table, DataFrame):
            table = self._tables[name] = table()
        return table

    def kept(self, name: str, key: Hashable, build: Callable[[], DataFrame]) -> DataFrame:
        """What ``build`` gives, stored in the shared folder on first use and read from there by all who ask with this key."""
        rows = build()
        spark = rows.sparkSession
        key = (spark.sparkContext.applicationId, self._label, name, key)
        if key not in self._kept:
            path = scratch_table(spark, name)
            rows.write.parquet(path)
            self._kept[key] = path
        return spark.read.schema(rows.schema).parquet(self._kept[key])

    def kept_by(self, spark: SparkSession, name: str, by: str, tasks: int, build: Callable[[], DataFrame]) -> DataFrame:
        """What ``build`` gives, stored on first use as a table of ``tasks`` buckets by a column, so that groupings by it shuffle nothing.

        Each bucket is one task's; rows that ``build`` has partitioned by this column into as many are one file a bucket.
        The table is in the application's catalogue and its files are in the shared folder. For sources with a label, which share it.
        """
        key = (spark.sparkContext.applicationId, self._label, name, by)
        if key not in self._kept:
            path = scratch_table(spark, name)
            table = path.rsplit("/", 1)[1].replace("-", "_")
            build().write.option("path", path).bucketBy(tasks, by).saveAsTable(table)
            self._kept[key] = table
        return spark.table(self._kept[key])

    def drop_kept(self, spark: SparkSession) -> None:
        """Remove what these sources have stored for themselves alone (without a label); plans that read it end here."""
        if self._label is None:
            while self._kept:
                drop_table(spark, self._kept.popitem()[1])

    @classmethod
    def from_paths(cls, spark: SparkSession, paths: Mapping[str, str], fmt: str = "parquet") -> "Sources":
        return cls({name: (lambda path=path: spark.read.format(fmt).load(path)) for name, path in paths.items()})
