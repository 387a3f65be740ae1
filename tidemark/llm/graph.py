"""Connected components as a few rounds of joins over an edge table."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import drop_table, scratch_table

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_PATHS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()
_SCOPE: ContextVar["Temporary | None"] = ContextVar("scope", default=None)


class Temporary:
    """Tables stored while it is the innermost scope."""

    def __init__(self, outer: "Temporary | None"):
        self.outer, self.tables = outer, []

    def keep(self, df: DataFrame) -> DataFrame:
        """Leave a stored table to the scope around this one."""
        path = _PATHS[df]
        self.tables = [t for t in self.tables if t[1] != path]
        if self.outer is not None:
            self.outer.tables.append((df.sparkSession, path))
        return df


@contextmanager
def temporary() -> Iterator[Temporary]:
    """What is stored in this scope, and not kept, goes at its end: plans that read it must have been stored by then."""
    scope = Temporary(_SCOPE.get())
    token = _SCOPE.set(scope)
    try:
        yield scope
    finally:
        _SCOPE.reset(token)
        for spark, path in scope.tables:
            drop_table(spark, path)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: cuts the lineage and survives a lost executor.

    What was shuffled is not needed again once a result is written and leaves the disk then: the session is told so on first use.
    """
    spark: SparkSession = df.sparkSession
    if spark.conf.get(CLEANUP, "false") != "true":
        spark.conf.set(CLEANUP, "true")
    path = scratch_table(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _PATHS[out] = path
    if (scope := _SCOPE.get()) is not None:
        scope.tables.append((spark, path))
    return out


def forget(df: DataFrame) -> None:
    """Remove a stored table that no plan reads any more."""
    path = _PATHS.pop(df)
    scope = _SCOPE.get()
    if scope is not None:
        scope.tables = [t for t in scope.tables if t[1] != path]
    drop_table(df.sparkSession, path)


def _mark(edges: DataFrame) -> tuple:
    """Count and an order-free sum that tell whether a round changed anything."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (``u, v`` of one type, no nulls); the root is the smallest node reachable.

    Alternates large stars (larger neighbours move to the smallest neighbour) and small stars (smaller neighbours do) until
    all edges are stars; the rounds grow with the logarithm of the longest path. The smallest neighbour is an aggregate that
    is joined back, so a node with many neighbours is spread over tasks. Empty in, empty out; loops and repeats don't matter.
    """
    edges = stored(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    mark = _mark(edges)
    while mark[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(smallest, "u")
        small = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(smallest.select("u", F.col("m").alias("v")))
        last, before = edges, mark
        edges = stored(small.distinct(), "edges")
        forget(last)
        mark = _mark(edges)
        if mark == before:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
