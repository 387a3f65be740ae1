"""What the two searches for repeated strings share: hashes of ranges, keys by as many units as a hot one asks for, merged spans.

A string is a run of windows with one key: the least hash among the windows' grams. Windows of a key that too many strings share
go by more of their units (words or bytes): half of what surrounds the gram on the side that has as much, then half of what is
still open, as long as the key is hot, up to whole windows. Equal windows have equal units at equal places, so they still
meet, wherever they are; windows that share but a common phrase do not.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.llm.batches import slices
from tidemark.llm.graph import forget, stored

HOT_KEYS = 100_000
PLACE_BITS = np.uint64(22)
PLACE = np.uint64((1 << 22) - 1)
RUN = 4096  # windows of a string at most: longer ones repeat themselves, and so do their parts
ODD = 0x9E3779B97F4A7C15
INVERSE = pow(ODD, -1, 1 << 64)
BYTES = np.random.default_rng(50).integers(0, 1 << 64, 256, dtype=np.uint64)  # hashes of single bytes


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Ranges:
    """Hashes of any ranges of a row of numbers: equal for equal ranges, wherever they stand."""

    powers = np.ones(1, dtype=np.uint64)
    inverses = np.ones(1, dtype=np.uint64)

    def __init__(self, values: np.ndarray):
        n = len(values) + 1
        if len(Ranges.powers) < n:
            size = max(n, 1 << 18)
            Ranges.powers, Ranges.inverses = (np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, f, dtype=np.uint64)]), dtype=np.uint64) for f in (ODD, INVERSE))
        self.sums = np.zeros(n, dtype=np.uint64)
        np.cumsum(values * Ranges.powers[: n - 1], out=self.sums[1:])

    def of(self, first: np.ndarray, size: np.ndarray | int) -> np.ndarray:
        return mixed((self.sums[first + size] - self.sums[first]) * Ranges.inverses[first])


def levels(length: int, gram: int) -> int:
    """How often keys can be made of more words, until they are of the whole window."""
    rest, n = length - gram, 0
    while rest:
        rest, n = rest - (rest + 1) // 2, n + 1
    return n


def refined(ranges: Ranges, least: np.ndarray, windows: np.ndarray, length: int, gram: int, hot: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Key of every window, and whether it is by as many units as all of ``hot`` ask for.

    ``least`` has the least gram hash of each window and, in the low bits, the place of the gram, the first of equals.
    """
    key, place = least >> PLACE_BITS, (least & PLACE).astype(np.int64)
    left, right = np.zeros(len(windows), np.int64), np.full(len(windows), gram, np.int64)  # known units from the gram's first
    rest = length - gram
    for level in hot:
        at = np.searchsorted(level, key[windows])
        many = level[np.minimum(at, len(level) - 1)] == key[windows]
        windows, left, right = windows[many], left[many], right[many]
        take = (rest + 1) // 2
        before = place[windows] - windows - left >= take
        begin = place[windows] + np.where(before, -left - take, right)
        key[windows] = mixed(key[windows] * np.uint64(3) + before + ranges.of(begin, take))
        left, right = left + take * before, right + take * ~before
        rest -= take
    deep = np.zeros(len(key), dtype=bool)
    deep[windows] = True
    return key, deep


def runs(key: np.ndarray, inside: np.ndarray, starts: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """First window and number of windows of each string: runs of one key ``inside``, cut at ``starts`` and after ``most`` windows."""
    change = np.ones(len(key), dtype=bool)
    change[1:] = (key[1:] != key[:-1]) | ~inside[:-1]
    change[starts] = True
    first = np.flatnonzero(change & inside)
    stops = np.append(np.flatnonzero(change | ~inside), len(key))
    count = stops[np.searchsorted(stops, first, side="right")] - first
    times = -(-count // most)
    done = most * (np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times))
    return np.repeat(first, times) + done, np.minimum(np.repeat(count, times) - done, most)


def merged(start: np.ndarray, end: np.ndarray, *row: np.ndarray) -> tuple[np.ndarray, ...]:
    """Spans of rows, told apart by the numbers ``row``; those of a row that touch or overlap as one, start and end first."""
    if not len(start):
        return start, end, *row
    by = np.lexsort((start, *row))
    start, end, row = start[by], end[by], [x[by] for x in row]
    other = np.zeros(len(by), dtype=bool)
    for x in row:
        other[1:] |= x[1:] != x[:-1]
    rank = np.cumsum(other) << 40
    reach = np.maximum.accumulate(rank + end)
    new = np.ones(len(by), dtype=bool)
    new[1:] = (rank + start)[1:] > reach[:-1]
    last = np.append(np.flatnonzero(new)[1:], len(by)) - 1
    return start[new], reach[last] - rank[last], *[x[new] for x in row]


class Counter:
    """Units that travel by key, equal strings of a task counted once.

    ``strings`` turns texts into keys, hashes of the strings' content and sizes. Keys that fewer than ``least`` different strings
    of a task have are not told one by one: their units are, together, under no key.
    """

    def __init__(self, strings: Callable[[list[bytes]], Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]], least: int = 1):
        self.strings, self.least, self.held, self.rows = strings, least, [], 0

    def add(self, texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        for found in self.strings(texts):
            if len(found[0]):
                self.held.append(found)
                self.rows += len(found[0])
            if self.rows > 1_000_000:
                yield self.flush()

    def flush(self) -> tuple[np.ndarray, np.ndarray, int]:
        """Keys, their units, and the units of all other keys."""
        if not self.held:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), 0
        key, content, size = (np.concatenate([h[k] for h in self.held]) for k in range(3))
        self.held, self.rows = [], 0
        _, one = np.unique(mixed(key) ^ content, return_index=True)
        key, back, times = np.unique(key[one], return_inverse=True, return_counts=True)
        units = np.bincount(back, weights=size[one]).astype(np.int64)
        told = times >= self.least
        return key[told].view(np.int64), units[told], int(units[~told].sum())


def hot_keys(own: DataFrame, counter: Callable[[list[np.ndarray]], Counter], n_levels: int, shard: int, least: int) -> tuple[list[np.ndarray], int]:
    """By level the keys of too many units, ascending, and the number of buckets of ``shard`` units; both for the routing alone.

    ``own`` has ``text``. Keys of fewer than ``least`` units are never hot.
    """
    shards, hot = int(own.sparkSession.conf.get("spark.sql.shuffle.partitions")), []
    limit = least
    for level in range(n_levels):
        below = list(hot)

        def count(batches: Iterator[pa.RecordBatch], below=below) -> Iterator[pa.RecordBatch]:
            counting = counter(below)
            for batch in slices(batches, "text"):
                for found in counting.add([t.encode() for t in batch.column("text").to_pylist() if t]):
                    yield told(found)
            yield told(counting.flush())

        def told(found: tuple[np.ndarray, np.ndarray, int]) -> pa.RecordBatch:
            keys = pa.concat_arrays([pa.array(found[0], pa.int64()), pa.nulls(1, pa.int64())])
            return pa.RecordBatch.from_arrays([keys, pa.array(np.append(found[1], found[2]))], ["key", "units"])

        seen = Observation()
        counted = own.mapInArrow(count, "key long, units long").groupBy("key").agg(F.sum("units").alias("units"))
        many = stored(counted.observe(seen, F.sum("units").alias("units")).where((F.col("units") >= limit) & F.col("key").isNotNull()), f"hot-keys-{level}")
        if level == 0:
            total = seen.get["units"] or 0
            shards = max(shards, -(-total // shard))
            limit = max(least, min(shard // 4, total // (2 * shards)))
        # a key beyond the list stays as it is: its windows meet in one bucket all the same
        found = many.where(F.col("units") >= limit).orderBy(F.desc("units"), "key").limit(HOT_KEYS).collect()
        forget(many)
        if not found:
            break
        hot.append(np.sort(np.array([r.key for r in found], dtype=np.int64).view(np.uint64)))
    return hot, shards
