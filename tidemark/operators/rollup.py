"""Roll-ups over optional dimensions."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.bitmaps import tasks_for
from tidemark.params import ALL


def grouping_levels(
    df: DataFrame, fixed: list[str], rolled: list[str], aggs: list[Column], null_as: str = "Unknown"
) -> DataFrame:
    """Aggregate by ``fixed`` at every subset of ``rolled``; a rolled-up dimension reads 'All'.

    Only the levels that survive the not-null gate are built: a full cube over date, line,
    region and two labels has 32 levels of which 28 would be thrown away. A missing label is
    named first, so it can never be taken for the rolled-up level.
    """
    dims = fixed + rolled
    filled = named_labels(df, rolled, null_as)
    sets = [fixed + list(kept) for n in range(len(rolled), -1, -1) for kept in combinations(rolled, n)]
    marks = [F.grouping(c).alias(f"_rolled_{c}") for c in rolled]
    out = filled.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in dims]).agg(*aggs, *marks)
    labels = [F.when(F.col(f"_rolled_{c}") == 1, F.lit(ALL)).otherwise(F.col(c)).alias(c) for c in rolled]
    measures = [c for c in out.columns if c not in dims and not c.startswith("_rolled_")]
    return out.select(*fixed, *labels, *measures)


def named_labels(df: DataFrame, rolled: list[str], null_as: str = "Unknown") -> DataFrame:
    """Missing labels under their own name."""
    return df.fillna(null_as, subset=rolled)


def over_all_tasks(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` dealt by ``keys`` to as many tasks as the session's shuffles have, more where its rows ask for more.

    AQE would merge partitions by their compressed bytes, and rows of few values take many times that
    in a sort; here its tasks stay as small as the session asks for, and do not grow with the input.
    """
    return df.repartition(max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), tasks_for(df)), *keys)


def label_chains(labels: list[str]) -> list[list[str]]:
    """Orders of ``labels`` whose beginnings are, together, every subset of them that is not empty."""
    chains, met = [], set()
    for size in range(len(labels), 0, -1):
        for subset in combinations(labels, size):
            if frozenset(subset) in met:
                continue
            # the longest beginning first: of each set, drop a label that leaves one not met yet
            left, chain = list(subset), []
            while left:
                met.add(frozenset(left))
                last = next((c for c in reversed(left) if frozenset(left) - {c} not in met), left[-1])
                left.remove(last)
                chain.insert(0, last)
            chains.append(chain)
    return chains


def count_levels(
    df: DataFrame, fixed: list[str], rolled: list[str], item: str, name: str, sums: dict[str, Column], null_as: str = "Unknown"
) -> DataFrame:
    """As ``grouping_levels`` with ``sums`` and the distinct count of ``item`` under ``name``, without multiplying rows by levels.

    Sorted by item and labels, a row that begins an item's labels, or the first few of them, is the
    one that counts at that level. So every level's count is a plain sum, and the levels multiply sums.
    Rows are shuffled once, unless they are dealt by ``item`` and some of ``fixed`` already, and sorted once for each
    chain of levels; a task holds rows and no hashed groups of them.
    """
    rows, levels = named_labels(df, rolled, null_as), {}
    for chain in label_chains(rolled):
        by_labels = Window.partitionBy(*fixed, item).orderBy(*chain)
        rows = rows.withColumn("_before", F.lag(F.struct(*chain)).over(by_labels))
        begins, marks = F.col("_before").isNull(), {}
        for n in range(len(chain) + 1):
            if n:
                begins = begins | (F.col(chain[n - 1]) != F.col(f"_before.{chain[n - 1]}"))
            if frozenset(chain[:n]) not in levels:
                mark = levels[frozenset(chain[:n])] = f"_first_{len(levels)}"
                marks[mark] = (begins & F.col(item).isNotNull()).cast("long")
        rows = rows.withColumns(marks).drop("_before")
    leaves = rows.groupBy(*fixed, *rolled).agg(*[F.sum(m).alias(m) for m in levels.values()], *[v.alias(n) for n, v in sums.items()])

    def at(kept: frozenset) -> Column:
        return reduce(Column.__and__, [F.grouping(c) == (0 if c in kept else 1) for c in rolled])

    # each level's row takes the sum of its own marks
    counted = F.coalesce(*[F.when(at(kept), F.sum(mark)) for kept, mark in levels.items()])
    return grouping_levels(leaves, fixed, rolled, [*[F.sum(n).alias(n) for n in sums], counted.alias(name)], null_as)


def label_levels(df: DataFrame, **labels: list[str]) -> DataFrame:
    """Repeat finished rows under fixed labels.

    A label that is the same on every row has equal totals at each of its levels, so the
    levels are copied from the aggregate instead of aggregated again.
    """
    for name, values in labels.items():
        df = df.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
    return df


def distinct_then_count(df: DataFrame, keys: list[str], item: str, name: str) -> DataFrame:
    """Distinct count per group; Spark spreads the de-duplication over (group, item)."""
    return df.groupBy(*keys).agg(F.countDistinct(item).alias(name))


def count_each(df: DataFrame, keys: list[str], items: dict[str, str], sums: list[Column]) -> DataFrame:
    """Distinct counts of several items beside sums, by ``keys`` without nulls.

    Each count has a frame of its own, reduced to the group's items first, and the small
    results are joined: counted in one aggregate, Spark would multiply every row by the number
    of items.
    """
    out = df.groupBy(*keys).agg(*sums) if sums else df.select(*keys).distinct()
    for name, item in items.items():
        out = out.join(df.select(*keys, F.col(item).alias(name)).distinct().groupBy(*keys).agg(F.count(name).alias(name)), keys)
    return out
