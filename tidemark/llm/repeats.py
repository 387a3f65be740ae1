"""Suffix-array dedup: removes bytes that a string of ``LENGTH`` bytes covers which also starts in an earlier document.

Where such a string starts is found shard by shard. Every string of ``LENGTH`` bytes has an anchor, the part of ``GRAM`` bytes with
the least hash; strings in a row whose anchors are equal are cut out together, as a segment, and go to the shard of the anchor's
hash. So equal strings always meet, whatever documents they are in, and a segment repeats only ``LENGTH - 1`` bytes of its neighbours.
As anchors count by what they are and not by where, a run of one byte or of a short period is a segment for each ``RUN`` strings,
and those are equal but for the first ones.

Anchors that different segments of a task share are counted beforehand, over all documents; strings of a hot one go by more of
their bytes, half of what surrounds the anchor and so on (``tidemark.llm.ranges``), so a phrase that a third of all documents have is
dealt out by what stands around it. The number of shards follows the bytes that travel.
A shard keeps of equal segments those of the smallest ``doc_id`` (the others are repeats as a whole) and leaves out what cannot
hold a shared string: an equal string agrees with the anchor and, on one side of it, half of the remaining bytes. Then it sorts all suffixes of the rest by external induction (``tidemark.llm.suffix``): strings that are equal stand
side by side, told by the common-prefix values, and each string of a larger ``doc_id`` than its group's smallest is a repeat.

Equal segments are dropped where they are cut already, before the shuffle, so a passage that a third of all documents share
reaches its shards once for every ``HELD`` bytes or ``ROWS`` rows that a task has cut. Segments travel packed and compressed, and what was shuffled
leaves the disk once the spans are written. A shard's text, order and queues are files once they are long, spans that touch are one.

``doc_id``, a whole number (others are refused), decides alone: rows of one ``doc_id`` (repeated rows too) never remove each other's bytes; a null ``doc_id`` is larger than
all others. Null and empty texts have no bytes, texts shorter than ``LENGTH`` lose none. Empty tables give empty results, extra
columns are not read. Texts are bytes in UTF-8: what is left of one need not be valid UTF-8.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import suffix
from tidemark.llm.batches import slices
from tidemark.llm.graph import stored
from tidemark.llm.ranges import BYTES, RUN, Counter, Ranges, hot_keys, levels, merged, mixed, refined, runs
from tidemark.llm.shingles import text_key, whole_id

LENGTH = 50
GRAM = 16
PIECE = 1 << 20  # bytes cut at once; two of them must have places below 2 ** PLACE_BITS
HELD = 32 << 20
ROWS = 200_000
LEVEL = 3
SHARD_BYTES = 64 << 20  # of segments
LEAST_HOT = 200_000  # bytes of an anchor's segments that are never too many
NO_ID = np.iinfo(np.int64).max
PLACE_BITS = np.uint64(22)
PLACE = np.uint64((1 << 22) - 1)


def anchors(text: np.ndarray, length: int, gram: int) -> np.ndarray:
    """For every string of ``length`` bytes its least gram hash and, in the low bits, the place of the gram, the first of equals.

    Hash and choice depend on the string's bytes alone, so equal strings have their anchor at the same distance.
    """
    if len(text) > PLACE:
        raise ValueError("too many bytes at once")
    width = length - gram + 1
    n = len(text) - gram + 1
    words = [np.ndarray((n,), "<u8", buffer=text, offset=o, strides=(1,)) for o in (0, gram - 8)]
    h = words[0] * np.uint64(0x9E3779B97F4A7C15)
    h ^= (words[1] + np.uint64(0x632BE59BD9B4E019)) * np.uint64(0xC2B2AE3D27D4EB4F)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    h &= ~PLACE
    h |= np.arange(n, dtype=np.uint64)
    size = 1
    while 2 * size <= width:
        h = np.minimum(h[:-size], h[size:])
        size *= 2
    if size < width:
        h = np.minimum(h[: len(h) - (width - size)], h[width - size :])
    return h


def segments(
    text: np.ndarray, starts: np.ndarray, sizes: np.ndarray, length: int, gram: int, hot: list[np.ndarray] | None = None, deepest: bool = False
) -> tuple[np.ndarray, ...]:
    """``first, count, offset, key``: places of segments in ``text``, how many strings start in each, where its anchor is in it
    (``length`` if it has several), and what it is dealt by. With ``deepest``, only those that go by as many bytes as ``hot`` asks for."""
    if len(text) < length:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    least = anchors(text, length, gram)
    inside = np.zeros(len(least) + 1, dtype=np.int8)
    long = sizes >= length
    np.add.at(inside, starts[long], 1)
    np.add.at(inside, starts[long] + sizes[long] - length + 1, -1)
    inside = np.cumsum(inside[:-1], dtype=np.int8) > 0
    key = least >> PLACE_BITS
    if hot:
        key, deep = refined(Ranges(BYTES[text]), least, np.flatnonzero(inside), length, gram, hot)
        if deepest:
            inside &= deep
    first, count = runs(key, inside, starts[long], RUN)
    place, last = ((least[x] & PLACE).astype(np.int64) for x in (first, first + count - 1))
    return first, count, np.where(place == last, place - first, length), key[first]


def gather(text: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The parts of ``text`` put one after the other, and where each begins there."""
    begins = np.cumsum(sizes) - sizes
    out = np.empty(int(sizes.sum()), dtype=np.uint8)
    cuts = np.searchsorted(begins, np.arange(0, len(out) + PIECE, PIECE)).tolist()
    for a, b in zip(cuts, cuts[1:]):  # the places are eight times as long as the bytes
        if a < b:
            at = np.repeat(first[a:b] - begins[a:b], sizes[a:b])
            start = int(begins[a])
            at += np.arange(start, start + len(at))
            out[start : start + len(at)] = text[at]
    return out, begins


def numbered(data: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """A number for each part, equal for equal bytes; numbers in the order of first appearance."""
    ends = np.append(begins, len(data)).astype(np.int64)
    parts = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begins), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data))])
    return parts.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


def pieces(rows: list[tuple[int, int, bytes]], length: int) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """Rows put together to about ``PIECE`` bytes, longer texts cut so that no string is lost: row, place, bytes."""
    held: tuple[list, list, list] = ([], [], [])
    size = 0
    for i, (_, _, text) in enumerate(rows):
        for start in range(0, max(1, len(text) - length + 1), PIECE):
            part = text[start : start + PIECE + length - 1]
            for column, x in zip(held, (i, start, part)):
                column.append(x)
            size += len(part)
            if size >= PIECE:
                yield held
                held, size = ([], [], []), 0
    if held[0]:
        yield held


def thin(values: np.ndarray) -> tuple[str, int, bytes]:
    """Whole numbers in the narrowest type, low bytes first: what a compressor likes."""
    kind = np.min_scalar_type(int(values.max())) if len(values) and values.min() >= 0 else np.dtype(np.int64)
    narrow = np.ascontiguousarray(values.astype(kind))
    return kind.str, len(values), narrow.view(np.uint8).reshape(-1, kind.itemsize).T.tobytes()


def widen(packed: tuple[str, int, bytes]) -> np.ndarray:
    kind, n, raw = np.dtype(packed[0]), packed[1], packed[2]
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(kind.itemsize, n).T).view(kind).reshape(-1).astype(np.int64)


class Cutter:
    """Cuts rows (id, text key, bytes) into segments and holds them by shard until they are packed."""

    def __init__(self, shards: int, length: int, gram: int, hot: list[np.ndarray] | None = None):
        self.shards, self.length, self.gram, self.hot = shards, length, gram, hot
        self.clear()

    def clear(self) -> None:
        self.ids: list[int] = []
        self.keys: list[int] = []
        self.parts: list[list[tuple]] = [[] for _ in range(self.shards)]
        self.held = 0

    def add(self, rows: list[tuple[int, int, bytes]]) -> Iterator[tuple[int, bytes]]:
        """(shard, packed segments) whenever enough is held."""
        rows = [r for r in rows if len(r[2]) >= self.length]
        base = len(self.ids)
        self.ids += [r[0] for r in rows]
        self.keys += [r[1] for r in rows]
        for row, place, texts in pieces(rows, self.length):
            text = np.frombuffer(b"".join(texts) + bytes(8), dtype=np.uint8)
            sizes = np.array([len(t) for t in texts], dtype=np.int64)
            starts = np.cumsum(sizes) - sizes
            first, count, offset, key = segments(text[: len(text) - 8], starts, sizes, self.length, self.gram, self.hot)
            piece = np.searchsorted(starts, first, side="right") - 1
            row_of, place_of = np.array(row, dtype=np.int64)[piece] + base, np.array(place, dtype=np.int64)[piece] + first - starts[piece]
            shard = (mixed(key) % np.uint64(self.shards)).astype(np.int64)
            by = np.argsort(shard, kind="stable")
            shard, row_of, place_of, first, count, offset = (x[by] for x in (shard, row_of, place_of, first, count, offset))
            data, begins = gather(text, first, count + self.length - 1)
            edges = np.flatnonzero(np.diff(shard, prepend=-1))
            for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(shard)]):
                bytes_to = int(begins[b]) if b < len(begins) else len(data)
                part = (row_of[a:b], place_of[a:b], count[a:b], offset[a:b], data[int(begins[a]) : bytes_to])
                self.parts[int(shard[a])].append(part)
            self.held += len(data)
            if self.held >= HELD:
                yield from self.flush(keep=len(self.ids))
        if self.held == 0:
            self.clear()
        elif len(self.ids) >= ROWS:
            yield from self.flush()

    def flush(self, keep: int = 0) -> Iterator[tuple[int, bytes]]:
        """All that is held; ``keep`` rows may still have pieces to come."""
        ids, keys = np.array(self.ids, dtype=np.int64), np.array(self.keys, dtype=np.int64)
        codec = pa.Codec("zstd", compression_level=LEVEL)
        for s, parts in enumerate(self.parts):
            if not parts:
                continue
            row, place, count, offset, data = (np.concatenate([p[k] for p in parts]) for k in range(5))
            parts.clear()
            sizes = count + self.length - 1
            begins = np.cumsum(sizes) - sizes
            number = numbered(data, begins)
            least = np.full(int(number.max()) + 1, NO_ID, dtype=np.int64)
            np.minimum.at(least, number, ids[row])
            again = ids[row] > least[number]  # known repeats travel without their bytes
            order = np.concatenate([np.flatnonzero(~again), np.flatnonzero(again)])
            used, dense = np.unique(row[order], return_inverse=True)
            kept = int(np.count_nonzero(~again))
            data, _ = gather(data, begins[~again], sizes[~again])
            step = np.diff(dense, prepend=0)
            packed = pickle.dumps((
                kept, thin(ids[used]), keys[used].tobytes(), thin(step[:kept]), dense[kept:].astype(np.int32).tobytes(),
                thin(place[order]), thin(count[order]), thin(offset[order[:kept]]), data.tobytes(),
            ), protocol=5)
            yield s, len(packed).to_bytes(8, "little") + codec.compress(packed, asbytes=True)
        self.held = 0
        if not keep:
            self.clear()


class Shard:
    """Segments of one shard as they come in."""

    def __init__(self):
        self.parts: list[tuple] = []
        self.rows = 0

    def add(self, blob: bytes) -> None:
        raw = pa.Codec("zstd").decompress(blob[8:], decompressed_size=int.from_bytes(blob[:8], "little"), asbytes=True)
        kept, ids, keys, step, known, place, count, offset, data = pickle.loads(raw)
        row = np.concatenate([np.cumsum(widen(step)), np.frombuffer(known, np.int32).astype(np.int64)]) + self.rows
        ids = widen(ids)
        self.parts.append((ids, np.frombuffer(keys, np.int64), row, widen(place), widen(count), widen(offset), np.frombuffer(data, np.uint8)))
        self.rows += len(ids)

    def spans(self, length: int, gram: int) -> tuple[np.ndarray, ...]:
        """``doc_id, text key, start, end`` of what is repeated."""
        ids, keys = (np.concatenate([p[k] for p in self.parts]) for k in (0, 1))
        kept = [len(p[5]) for p in self.parts]
        row, place, count = (np.concatenate([p[k][:n] for p, n in zip(self.parts, kept)]) for k in (2, 3, 4))
        found = [tuple(np.concatenate([p[k][n:] for p, n in zip(self.parts, kept)]) for k in (2, 3, 4))]  # repeats known before
        offset, data = (np.concatenate([p[k] for p in self.parts]) for k in (5, 6))
        self.parts.clear()
        sizes = count + length - 1
        begins = np.cumsum(sizes) - sizes
        if len(row):
            number = numbered(data, begins)
            doc = ids[row]
            least = np.full(number.max() + 1, NO_ID, dtype=np.int64)
            np.minimum.at(least, number, doc)
            again = doc > least[number]
            found.append((row[again], place[again], count[again]))
            _, lead = np.unique(number, return_index=True)
            chosen = self.shared(data, begins[lead], sizes[lead], offset[lead], least, length, gram)
            one = self.sorted_repeats(data, begins[lead[chosen]], sizes[lead[chosen]], least[chosen], length)
            # what is a repeat in a segment is one wherever its document has the segment
            mine = np.flatnonzero(~again)
            mine = mine[np.argsort(number[mine], kind="stable")]
            lo, hi = (np.searchsorted(number[mine], chosen[one[0]], side=side) for side in ("left", "right"))
            times = hi - lo
            which = mine[np.repeat(lo - (np.cumsum(times) - times), times) + np.arange(times.sum())]
            found.append((row[which], place[which] + np.repeat(one[1], times), np.repeat(one[2], times)))
        row, place, count = (np.concatenate([f[k] for f in found]) for k in range(3))
        return ids[row], keys[row], place, place + count + length - 1

    @staticmethod
    def shared(data: np.ndarray, begins: np.ndarray, sizes: np.ndarray, offset: np.ndarray, least: np.ndarray, length: int, gram: int) -> np.ndarray:
        """Segments that agree with one of another document in the anchor and half of the other bytes before or behind it."""
        half = -(-(length - gram) // 2)
        keep = np.zeros(len(begins), dtype=bool)
        # a segment of several anchors has a context for each of them
        several = np.flatnonzero(offset == length)
        places = [np.unique(anchors(data[begins[i] : begins[i] + sizes[i]], length, gram) & PLACE).astype(np.int64) for i in several.tolist()]
        single = np.flatnonzero(offset != length)
        owner = np.concatenate([single, np.repeat(several, [len(x) for x in places])]).astype(np.int64)
        offset = np.concatenate([offset[single], *places])
        for before in (0, half):
            own = np.flatnonzero((offset >= before) & (offset - before + gram + half <= sizes[owner]))
            if len(own) == 0:
                continue
            context, starts = gather(data, begins[owner[own]] + offset[own] - before, np.full(len(own), gram + half))
            group = numbered(context, starts)
            low, high = np.full(group.max() + 1, NO_ID), np.full(group.max() + 1, np.iinfo(np.int64).min)
            np.minimum.at(low, group, least[owner[own]])
            np.maximum.at(high, group, least[owner[own]])
            keep[owner[own[low[group] < high[group]]]] = True
        return np.flatnonzero(keep)

    @staticmethod
    def sorted_repeats(data: np.ndarray, begins: np.ndarray, sizes: np.ndarray, doc: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
        """Runs of repeated strings: index of the segment, first string and number of strings."""
        if len(begins) == 0:
            return (np.zeros(0, np.int64),) * 3
        whole, starts = gather(data, begins, sizes)
        starts = starts + np.arange(len(starts))
        n = int(sizes.sum()) + len(sizes)
        text = suffix.room(n + 1, np.uint8)
        text[:] = 255  # stands in no UTF-8 text, so no common prefix of two strings crosses a segment's end
        where = np.ones(n, dtype=bool)
        where[starts + sizes] = False
        text[:n][where] = whole + np.uint8(1)
        text[n] = 0
        order, common = suffix.suffix_order(text, length)
        segment = np.repeat(np.arange(len(sizes), dtype=np.int64), sizes + 1)
        string = suffix.room(n + 1, bool)
        string[:] = False
        edges = np.zeros(n + 1, dtype=np.int8)
        edges[starts] = 1
        edges[starts + sizes - length + 1] -= 1
        string[:] = np.cumsum(edges, dtype=np.int8) > 0
        repeated = suffix.room(n + 1, bool)
        repeated[:] = False
        heads = np.flatnonzero(common < length)  # every suffix not equal in its first bytes to the one before it
        ends = np.append(heads[1:], n + 1)
        many = ends - heads > 1
        at = np.repeat(heads[many], (ends - heads)[many])
        within = np.arange(len(at)) - np.repeat(np.cumsum((ends - heads)[many]) - (ends - heads)[many], (ends - heads)[many])
        places = order[at + within]
        group = np.repeat(np.arange(int(many.sum())), (ends - heads)[many])
        real = string[places]
        places, group = places[real], group[real]
        if len(places):
            own = doc[segment[places]]
            least = np.full(int(group.max()) + 1, NO_ID, dtype=np.int64)
            np.minimum.at(least, group, own)
            repeated[places[own > least[group]]] = True
        step = np.diff(np.concatenate([[0], repeated.view(np.int8), [0]]))
        first, last = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        return segment[first], first - starts[segment[first]], last - first


def counter(length: int, gram: int, hot: list[np.ndarray]) -> Counter:
    """Counts bytes of segments by key, for keys that different segments of a task share."""

    def strings(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        for _, _, parts in pieces([(0, 0, t) for t in texts if len(t) >= length], length):
            raw = np.frombuffer(b"".join(parts) + bytes(8), dtype=np.uint8)  # anchors read whole words of memory
            sizes = np.array([len(t) for t in parts], dtype=np.int64)
            text = raw[: len(raw) - 8]
            first, count, _, key = segments(text, np.cumsum(sizes) - sizes, sizes, length, gram, hot, deepest=bool(hot))
            size = count + length - 1
            yield key, Ranges(BYTES[text]).of(first, size) if len(size) else key, size

    return Counter(strings, least=2)


def find_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``doc_id, text_hash, start, end``: bytes that go; spans of a row may touch and overlap."""
    own = docs.select(whole_id(docs), text_key().alias("text_hash"), "text")
    hot, shards = hot_keys(own, lambda below: counter(length, gram, below), levels(length, gram), SHARD_BYTES, LEAST_HOT)

    def cut_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = Cutter(shards, length, gram, hot)
        for batch in slices(batches, "text"):
            ids = batch.column("doc_id").fill_null(int(NO_ID)).to_pylist()
            rows = [(i, k, t.encode()) for i, k, t in zip(ids, batch.column("text_hash").to_pylist(), batch.column("text").to_pylist()) if t]
            yield from boxed(cutter.add(rows))
        yield from boxed(cutter.flush())

    def boxed(found: Iterator[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
        for s, blob in found:
            yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([blob], pa.binary())], ["shard", "packed"])

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = Shard()  # a partition is a shard
        for batch in batches:
            for blob in batch.column("packed"):
                shard.add(blob.as_py())
        if shard.parts:
            ids, keys, start, end = shard.spans(length, gram)
            start, end, keys, ids = merged(start, end, keys, ids)
            for a in range(0, len(ids), 100_000):
                b = slice(a, a + 100_000)
                doc_id = pa.array(ids[b], mask=ids[b] == NO_ID)
                yield pa.RecordBatch.from_arrays([doc_id, *(pa.array(x[b]) for x in (keys, start, end))], ["doc_id", "text_hash", "start", "end"])

    dealt = own.mapInArrow(cut_all, "shard int, packed binary").repartitionById(shards, F.col("shard"))
    return dealt.mapInArrow(solve, "doc_id long, text_hash long, start long, end long")


def kept_bytes(text: bytes, spans: list) -> tuple[int, int, bytes]:
    """Bytes removed, maximal removed runs, and the bytes that are left."""
    if not spans:
        return 0, 0, text
    edges = np.zeros(len(text) + 1, dtype=np.int64)
    np.add.at(edges, [s for s, _ in spans], 1)
    np.add.at(edges, [e for _, e in spans], -1)
    gone = np.cumsum(edges[:-1]) > 0
    runs = int(np.count_nonzero(gone[1:] & ~gone[:-1])) + int(gone[0])
    return int(gone.sum()), runs, np.frombuffer(text, dtype=np.uint8)[~gone].tobytes()


def deduplicate(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Per row ``doc_id, kept`` (the bytes that are left), ``n_bytes, n_removed, n_spans``."""
    spans = stored(find_spans(docs, length, gram), "repeat-spans").groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    own = docs.select(F.col("doc_id").cast("long"), text_key().alias("text_hash"), "text")
    same = F.col("d.doc_id").eqNullSafe(F.col("s.doc_id")) & (F.col("d.text_hash") == F.col("s.text_hash"))
    both = own.alias("d").join(spans.alias("s"), same, "left").select("d.doc_id", "d.text", "s.spans")

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = [(t or "").encode() for t in batch.column("text").to_pylist()]
            lists = [[(x["start"], x["end"]) for x in s or ()] for s in batch.column("spans").to_pylist()]
            found = [kept_bytes(t, s) for t, s in zip(texts, lists)]
            columns = [pa.array([f[2] for f in found], pa.binary()), *(pa.array(x, pa.int64()) for x in (list(map(len, texts)), [f[0] for f in found], [f[1] for f in found]))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "kept", "n_bytes", "n_removed", "n_spans"])

    return both.mapInArrow(drop, "doc_id long, kept binary, n_bytes long, n_removed long, n_spans long")
