"""Latest record per key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.bitmaps import tasks_for

#: places that the versions of one key are spread over
SLOTS = 1024
#: types of fixed width: Spark hashes an aggregate of them
_FIXED = (T.TimestampType, T.TimestampNTZType, T.DateType, T.IntegralType, T.DecimalType)


def _latest_row(df: DataFrame, keys: list[str], newest: list[str]) -> DataFrame:
    """Greatest row by ``newest``, then by the other columns: its buffer is a row, so Spark sorts."""
    rest = [c for c in df.columns if c not in keys and c not in newest]
    row = F.max(F.struct(*newest, *rest)).alias("_row")
    return df.groupBy(*keys).agg(row).select(*keys, *[F.col(f"_row.{c}").alias(c) for c in newest + rest])


def latest_per_key(df: DataFrame, keys: list[str], newest: list[str]) -> DataFrame:
    """Keep, for each key, the row that is greatest on ``newest``, then on the other columns.

    Two phases. Aggregates of fixed width, which Spark hashes, find each key's latest time and how
    many rows have it. Then each row meets its key's time: where one row has it, that row is the
    answer, and only keys that still tie compare whole rows.

    Rows that are more than one task's are dealt first, to as many tasks as their number asks for, by
    a hash of the key and one of ``SLOTS`` slots of the time. So no task hashes what a scan's part of
    a file holds, a key with millions of versions does not meet in one task, and rows of one key and
    time lie together for the join and the comparison, which shuffle them no more. The join hashes
    the keys' times and streams the rows, so copies of a row are not sorted to be joined.

    NULLs in keys are equal, a NULL time is before all others. Times are timestamps, dates, whole
    numbers or decimals; by any other type whole rows are compared at once.
    """
    rest = [c for c in df.columns if c not in keys and c not in newest]
    if not isinstance(df.schema[newest[0]].dataType, _FIXED):
        return _latest_row(df, keys, newest)
    at, tasks = newest[0], tasks_for(df)
    key = F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keys)])
    slot = F.pmod(F.xxhash64(at), F.lit(SLOTS)).alias("_slot")
    place = ["_hash", "_slot"] if tasks > 1 else ["_hash"]
    own = df.select(F.xxhash64(*keys).alias("_hash"), key.alias("_key"), *[slot][: len(place) - 1], *newest, *rest)

    def tops_of(versions: DataFrame, *by: str) -> DataFrame:
        # a key without any time has one version
        rows = F.coalesce(F.max_by("_rows", at), F.max("_rows"))
        return versions.groupBy(*by).agg(F.max(at).alias(at), rows.alias("_rows"))

    if tasks > 1:
        own = own.repartition(tasks, *place)
    tops = own.groupBy(*place, "_key", at).agg(F.count("*").alias("_rows"))
    if tasks > 1:
        tops = tops_of(tops, *place, "_key").repartition(tasks, "_hash")
    tops = tops_of(tops, "_hash", "_key")
    if tasks > 1:
        tops = tops.withColumn("_slot", slot).repartition(tasks, *place).hint("shuffle_hash")
    same = reduce(Column.__and__, [F.col(f"o.{c}") == F.col(f"t.{c}") for c in place])
    if tasks > 1:
        # as a range: Spark would deal both sides anew, to the session's number of tasks, by all that must be equal
        whole, top = (F.struct(f"{side}._key", f"{side}.{at}") for side in "ot")
        same = same & whole.between(top, top)
    else:
        same = same & (F.col("o._key") == F.col("t._key")) & F.col(f"o.{at}").eqNullSafe(F.col(f"t.{at}"))
    latest = own.alias("o").join(tops.alias("t"), same).select("o.*", "t._rows")
    tied = latest.where("_rows > 1").drop("_rows")
    out: list[Column] = [*[F.col(f"_key.k{i}").alias(c) for i, c in enumerate(keys)], *newest, *rest]
    return latest.where("_rows = 1").select(*out).unionByName(_latest_row(tied, [*place, "_key"], newest).select(*out))
