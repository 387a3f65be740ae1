"""Marts of one data directory, built scope by scope into the shared folder.

WEEK reads the DAY rows a run has written and FYtD its WEEK rows, so whoever asks for a later
scope first gets the earlier ones stored. Within an application a stored scope is built once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.params import DAY, FYTD, WEEK, MartConfig, RunParams
from tidemark.plans.refresh import MARTS, METRIC_MARTS
from tidemark.plans.reports import breakout_report, overview_status
from tidemark.session import scratch_table
from tidemark.sources.catalog import Sources

_paths: dict[tuple, str] = {}
_BEFORE = {DAY: [], WEEK: [DAY], FYTD: [DAY, WEEK]}


class MartStore:
    """``label`` names the sources; a stored scope belongs to one label, run and configuration."""

    def __init__(self, spark: SparkSession, label: str, src: Sources, p: RunParams, cfg: MartConfig, folder: str | None = None):
        self.spark, self.label, self.src, self.p, self.cfg, self.folder = spark, label, src, p, cfg, folder

    def build(self, mart: str, scope: str) -> DataFrame:
        """The plan of one scope; what it reads from the mart itself is stored first."""
        m = MARTS[mart]
        if scope == DAY:
            return m.day(self.src, self.p, self.cfg)
        stored = self.stored(mart, _BEFORE[scope])
        return (m.week if scope == WEEK else m.fytd)(stored, self.src, self.p, self.cfg)

    def stored(self, mart: str, scopes: list[str]) -> DataFrame:
        return self.spark.read.parquet(*[self._path(mart, scope) for scope in scopes])

    def whole(self, mart: str) -> DataFrame:
        return self.stored(mart, [DAY, WEEK, FYTD])

    @property
    def marts(self) -> dict[str, DataFrame]:
        return {name: self.whole(name) for name in METRIC_MARTS}

    def report(self, name: str) -> DataFrame:
        """A stored report: breakout_report or overview_status."""
        build = {"breakout_report": breakout_report, "overview_status": overview_status}[name]
        return self.spark.read.parquet(self._keep(name, "report", lambda: build(self.marts, self.p)))

    def _path(self, mart: str, scope: str) -> str:
        return self._keep(mart, scope, lambda: self.build(mart, scope))

    def _keep(self, name: str, scope: str, build: Callable[[], DataFrame]) -> str:
        key = (self.spark.sparkContext.applicationId, self.label, self.p, self.cfg, self.folder, name, scope)
        if key not in _paths:
            path = scratch_table(self.spark, f"{name}-{scope}", self.folder)
            build().write.parquet(path)
            _paths[key] = path
        return _paths[key]
