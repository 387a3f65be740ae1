"""Idempotent upsert into a Parquet table partitioned by reporting week."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.schema import MART_KEY, MART_UPDATE, PARTITION
from tidemark.session import drop_table, scratch_table
from tidemark.sinks.columns import columns_of, describe, joined
from tidemark.sinks.files import Folder

WRITING = "_writing"
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The stored table with all its columns, or None before its first write; opens no footer to plan."""
    found = columns_of(spark, path)
    return None if found is None else spark.read.schema(found[1]).parquet(path)


def part_name(partition: str, value) -> str:
    return f"{partition}={NO_VALUE if value is None else value}"


def read_parts(spark: SparkSession, path: str, columns: StructType, partition: str, values: list) -> DataFrame:
    """The ``columns`` of some partitions, listing only those."""
    folder = Folder(spark, path)
    there = [f"{path}/{name}" for name in (part_name(partition, v) for v in values) if folder.exists(name)]
    if not there:
        return spark.createDataFrame([], columns)
    return spark.read.schema(columns).option("basePath", path).parquet(*there)


@contextmanager
def alone(spark: SparkSession, path: str, names: list[str]) -> Iterator[None]:
    """Hold the partitions of these names for one writer; refused while another holds any of them.

    A writer that was killed leaves its marks: the message names the file to remove.
    """
    marks, held = Folder(spark, f"{path}/{WRITING}"), []
    try:
        for name in sorted(names):
            if not marks.create(name, spark.sparkContext.applicationId):
                raise RuntimeError(f"{name} of {path} is being written by {marks.read(name)}: wait, or remove {marks.path}/{name} if that run has died")
            held.append(name)
        yield
    finally:
        for name in held:
            marks.drop(name)


def _whole(key: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in key])


def merge_rows(stored: DataFrame, new: DataFrame, key: list[str], update: list[str] | None = None) -> DataFrame:
    """Stored and new rows with one row per key.

    A matched row takes its ``update`` columns (all others by default) from the new row and
    keeps the rest, also what the new rows have no column for. A key with a NULL matches
    nothing, so such rows are only ever added. Columns new to the table are appended, NULL
    for older rows.
    """
    both = stored.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    values = [c for c in both.columns if c not in key and c != "_new"]
    taken = [c for c in values if c in new.columns and (update is None or c in update or c not in stored.columns)]
    kept = [c for c in values if c not in taken]
    whole = _whole(key)
    picks = [F.max_by(F.struct(*taken), "_new").alias("_taken")] if taken else []
    picks += [F.min_by(F.struct(*kept), "_new").alias("_kept")] if kept else []
    merged = both.where(whole).groupBy(*key).agg(*picks).select(
        *key, *[F.col(f"_taken.{c}").alias(c) for c in taken], *[F.col(f"_kept.{c}").alias(c) for c in kept]
    )
    return merged.unionByName(both.where(~whole).drop("_new")).select(*key, *values)


def refuse_repeats(rows: DataFrame, key: list[str]) -> None:
    """Raise if new rows share a key: which of them should win is not for the table to say."""
    twice = rows.where(_whole(key)).groupBy(*key).count().where("count > 1").limit(3).collect()
    if twice:
        raise ValueError(f"new rows repeat keys, such as {[r.asDict() for r in twice]}")


def upsert(
    path: str, new: DataFrame, key: list[str] = MART_KEY, update: list[str] | None = MART_UPDATE,
    partition: str = PARTITION, staging: str | None = None,
) -> list:
    """Merge ``new`` into the table at ``path``, rewriting only the weeks it touches, which are returned.

    First and later writes go one way. The new rows are staged, which fixes them and cuts
    their lineage; repeated keys among them are refused, and so are columns of another type than
    the table's. The merged weeks are staged too and then replace theirs by dynamic partition
    overwrite, so the job never reads what it is writing, a lost executor only repeats tasks, and
    repeating the whole upsert of rows with whole keys gives the same table. Of the table, the
    touched weeks alone are listed and read; its columns come from the description beside it,
    to which a column that drifts in is added before any row has it. Staging tables have names
    of their own in ``staging`` (default: the shared folder) and go when the upsert is done, so
    upserts of other weeks may run beside this one; a second one of the same week is refused.
    """
    spark = new.sparkSession
    staged, merged = (scratch_table(spark, f"upsert-{step}", staging) for step in ("new", "merged"))
    try:
        new.write.parquet(staged)
        rows = spark.read.schema(new.schema).parquet(staged)
        refuse_repeats(rows, key)
        # one date per reporting week, 53 a year: listed here so the table scan is pruned to them
        weeks = [row[0] for row in rows.select(partition).distinct().collect()]
        with alone(spark, path, [part_name(partition, w) for w in weeks]):
            version, columns = columns_of(spark, path) or (-1, rows.schema)
            wanted = joined(columns, rows.schema)
            if version < 0 or wanted != columns:
                describe(spark, path, version, wanted)
            stored = read_parts(spark, path, columns, partition, weeks)  # without what drifts in just now
            merge_rows(stored, rows, key, update).write.parquet(merged)
            # rows of a week meet in one task, which writes the week's file; AQE splits a week too big for that
            spark.read.parquet(merged).hint("rebalance", partition).write.mode("overwrite").option(
                "partitionOverwriteMode", "dynamic"
            ).partitionBy(partition).parquet(path)
        return weeks
    finally:
        for table in (staged, merged):
            drop_table(spark, table)
