"""Distinct counts that roll up: sets of whole numbers as bits, merged by OR.

A set is one row per bucket of 64 numbers, the bits of one long. Sets of days, raw pairs or classes merge
into weeks, regions and levels without the rows they were made of, and the count is exact. A number by
itself costs a row of two longs beside its key, so sparse sets are no larger than the rows they stand for;
where numbers lie close together, as running ids do, 64 share a row. State is of fixed width: Spark hashes it.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

BUCKET, MEMBERS = "bucket", "members"
#: numbers of range per member at most; ids further apart are counted as rows
SPREAD = 512
#: rows of a task that hashes sets or sorts lines
TASK_ROWS = 200_000


def dense(df: DataFrame, item: str) -> bool:
    """Whether ``item`` is a whole number whose values lie close enough together for bits; one row is read."""
    if not isinstance(df.schema[item].dataType, IntegralType):
        return False
    first, last, members = df.agg(F.min(item), F.max(item), F.approx_count_distinct(item)).first()
    return first is None or int(last) - int(first) <= SPREAD * max(1, members)


def tasks_for(rows: DataFrame) -> int:
    """How many tasks the number of ``rows`` asks for; they are counted, which reads the columns they are filtered by."""
    return max(1, ceil(rows.count() / TASK_ROWS))


def dealt(rows: DataFrame, *keys: str) -> DataFrame:
    """Stored ``rows`` dealt by ``keys`` to as many tasks as their number asks for.

    Groupings by these keys and more then need no shuffle, and what a task holds does not grow with the input.
    """
    return rows.repartition(tasks_for(rows), *keys)


def dealt_if_many(rows: DataFrame, *keys: str) -> DataFrame:
    """As ``dealt``, but rows that one task can hold stay where they are.

    A grouping of dealt rows is one step after the shuffle. Without, each task of a scan would first hash
    all rows of its part of a file, and a part is as large as the file's row groups.
    """
    tasks = tasks_for(rows)
    return rows.repartition(tasks, *keys) if tasks > 1 else rows


def numbered(df: DataFrame, item: str) -> DataFrame:
    """``df`` with ``bucket`` and ``members``, the set of the row's one ``item``. NULL is no member."""
    value = F.col(item).cast("long")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), value.bitwiseAND(F.lit(63)).cast("int"))
    return df.withColumns({BUCKET: F.shiftright(value, 6), MEMBERS: bit})


def member_sets(df: DataFrame, keys: list[str], item: str) -> DataFrame:
    """``keys``, ``bucket`` and ``members``: the distinct values of ``item`` per key. NULL is no member, but keeps its key."""
    return merged_sets(numbered(df, item), keys)


def merged_sets(sets: DataFrame, keys: list[str], **parts: Column) -> DataFrame:
    """Sets of ``keys`` as the union of finer ones. ``parts`` names unions of the rows that meet a condition."""
    unions = {name: F.bit_or(F.when(when, F.col(MEMBERS))) for name, when in parts.items()}
    return sets.groupBy(*keys, BUCKET).agg(F.bit_or(MEMBERS).alias(MEMBERS), *[u.alias(n) for n, u in unions.items()])


def set_sizes(sets: DataFrame, keys: list[str], **names: str) -> DataFrame:
    """Members per key: ``names`` maps an output column to the column of sets it counts."""
    return sets.groupBy(*keys).agg(*[F.sum(F.bit_count(F.coalesce(F.col(c), F.lit(0))).cast("long")).alias(n) for n, c in names.items()])
