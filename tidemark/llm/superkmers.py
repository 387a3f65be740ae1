"""Substring dedup: removes words that a window of ``LENGTH`` words covers which also starts in an earlier document.

The minimiser of a window is the least hash among its grams of ``GRAM`` words. Consecutive windows of a document with one minimiser
travel together, as one packed string of words (a super-k-mer), to the bucket of the minimiser, so equal windows always meet,
whatever documents they are in, and a string repeats only ``LENGTH - 1`` words of its neighbours. As the minimiser counts by its value, a
run of one word or of a short period is a few strings too. In a bucket equal strings are one; the windows of the rest are sorted by a
hash and those beside each other with one hash are compared word by word: windows that are equal belong to the smallest
``doc_id`` among them, and are repeats in all others.

Minimisers that many strings share are counted first, over all documents. The windows of a hot one go by more of their words:
half of what surrounds the minimiser on the side that has as much, then half of what is still open, as long as the key is hot, up to whole windows.
Equal windows have equal words at equal places, so they still meet; strings that share but a common line do not.
The number of buckets follows the words that travel.

Equal strings are one already in the task that cuts them, and what it then knows to be repeated leaves as finished spans, so a text
that a third of all documents share reaches its buckets once for every ``HELD`` words that a task has cut. Strings travel compressed.

``doc_id`` (a whole number, others are refused) decides alone: rows of one ``doc_id`` (repeated rows too) never remove each other's words; a null ``doc_id`` is
larger than all others. Words are what stands between the six white spaces of ASCII, compared byte by byte. Null and empty texts have no
words, texts of fewer than ``LENGTH`` words lose none; long texts are cut in pieces that overlap by ``LENGTH - 1`` words. Empty tables give empty
results, extra columns are not read.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.batches import slices
from tidemark.llm.graph import stored
from tidemark.llm.ranges import BYTES, ODD, PLACE, RUN, Counter, Ranges, hot_keys, levels, merged, mixed, refined, runs
from tidemark.llm.repeats import NO_ID, gather, numbered, thin, widen
from tidemark.llm.shingles import text_key, whole_id

LENGTH = 50
GRAM = 8
PIECE = 1 << 20  # bytes cut at once
HELD = 5_000_000  # words of strings held by a task before they are packed
SHARD_WORDS = 2_000_000
LEAST_HOT = 10_000
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
BLANK = re.compile(rb"[\x20\x09-\x0d]")


def normal(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of the words, a blank behind each; where each word ends there, its blank included; and where each begins in ``raw``."""
    data = np.frombuffer(raw + b" ", dtype=np.uint8)
    blank = SPACE[data]
    after = np.empty(len(data), dtype=bool)  # behind a blank, or first
    after[0] = True
    after[1:] = blank[:-1]
    out = data[~(blank & after)].copy()
    ends = np.flatnonzero(SPACE[out])
    out[ends] = 32
    return out, ends + 1, np.flatnonzero(after & ~blank)


def chunks(text: bytes, length: int, piece: int = PIECE) -> Iterator[tuple[int, bytes]]:
    """Parts of a text that hold each of its windows once: number of the first word, bytes."""
    start = word = 0
    size = piece
    while len(text) - start > size:
        found = BLANK.search(text, start + size)
        end = found.start() if found else len(text)
        if end == len(text):
            break
        begins = normal(text[start:end])[2]
        if len(begins) < length:  # long words or much white space
            size *= 2
            continue
        yield word, text[start:end]
        word += len(begins) - length + 1
        start += int(begins[len(begins) - length + 1])
        size = piece
    yield word, text[start:]


def pieces(rows: list[bytes], length: int, piece: int = PIECE) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """Texts put together to about ``piece`` bytes, longer ones in parts: row, number of the first word, bytes."""
    held: tuple[list, list, list] = ([], [], [])
    size = 0
    for i, text in enumerate(rows):
        for word, part in chunks(text, length, piece):
            for column, x in zip(held, (i, word, part)):
                column.append(x)
            size += len(part)
            if size >= piece:
                yield held
                held, size = ([], [], []), 0
    if held[0]:
        yield held


def minimisers(hashes: np.ndarray, length: int, gram: int) -> np.ndarray:
    """For every window its least gram hash and, in the low bits, the place of the gram, the first of equals."""
    n = len(hashes) - gram + 1
    h = np.zeros(n, dtype=np.uint64)
    for j in range(gram):
        h = h * np.uint64(ODD) + hashes[j : n + j]
    h = mixed(h) & ~PLACE | np.arange(n, dtype=np.uint64)
    width, size = length - gram + 1, 1
    while 2 * size <= width:
        h = np.minimum(h[:-size], h[size:])
        size *= 2
    return np.minimum(h[: len(h) - (width - size)], h[width - size :]) if size < width else h


class Cut:
    """Strings of one group of texts: ``first`` word, ``count`` of windows and ``key`` of each; the ``data`` of all words and where they begin."""

    def __init__(self, texts: list[bytes], length: int, gram: int, hot: list[np.ndarray], deepest: bool = False):
        self.data, ends, places = normal(b" ".join(texts))
        if len(ends) > PLACE:
            raise ValueError("too many words at once")
        sizes = np.array([len(t) + 1 for t in texts], dtype=np.int64)
        self.starts = np.searchsorted(places, np.cumsum(sizes) - sizes)  # number of the first word of each text
        words = np.diff(self.starts, append=len(ends))
        self.first = self.count = np.zeros(0, np.int64)
        self.key = np.zeros(0, np.uint64)
        self.edges = np.concatenate([[0], ends])
        if len(ends) < length:
            return
        hashes = Ranges(BYTES[self.data]).of(self.edges[:-1], np.diff(self.edges))
        self.ranges = Ranges(hashes)
        least = minimisers(hashes, length, gram)
        inside = np.zeros(len(least) + 1, dtype=np.int32)
        long = words >= length
        np.add.at(inside, self.starts[long], 1)
        np.add.at(inside, self.starts[long] + words[long] - length + 1, -1)
        inside = np.cumsum(inside[:-1]) > 0
        key, deep = refined(self.ranges, least, np.flatnonzero(inside), length, gram, hot)
        if deepest:
            inside &= deep
        self.first, self.count = runs(key, inside, self.starts[long], RUN)
        self.key = key[self.first]

def counter(length: int, gram: int, hot: list[np.ndarray]) -> Counter:
    """Counts words by key; with ``hot``, those of the windows that the last of its levels has made of more words."""

    def strings(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        for _, _, group in pieces(texts, length):
            cut = Cut(group, length, gram, hot, deepest=bool(hot))
            size = cut.count + length - 1
            yield cut.key, cut.ranges.of(cut.first, size) if len(size) else cut.key, size

    return Counter(strings)


class Cutter:
    """Cuts rows (id, text key, bytes) into strings and holds them until they are packed."""

    def __init__(self, shards: int, length: int = LENGTH, gram: int = GRAM, hot: list[np.ndarray] | None = None):
        self.shards, self.length, self.gram, self.hot = shards, length, gram, hot or []
        self.clear()

    def clear(self) -> None:
        self.ids: list[int] = []
        self.keys: list[int] = []
        self.held: list[tuple] = []
        self.words = 0

    def add(self, rows: list[tuple[int, int, bytes]]) -> Iterator[tuple]:
        """``(shard, packed strings, None)`` or ``(shards, None, spans)`` whenever enough is held."""
        base = len(self.ids)
        self.ids += [r[0] for r in rows]
        self.keys += [r[1] for r in rows]
        for row, word, texts in pieces([r[2] for r in rows], self.length):
            cut = Cut(texts, self.length, self.gram, self.hot)
            if not len(cut.first):
                continue
            text = np.searchsorted(cut.starts, cut.first, side="right") - 1
            sizes = cut.count + self.length - 1
            begins, stops = cut.edges[cut.first], cut.edges[cut.first + sizes]
            data = cut.data.tobytes()
            data = b"".join([data[a:b] for a, b in zip(begins.tolist(), stops.tolist())])
            shard = (mixed(cut.key) % np.uint64(self.shards)).astype(np.int64)
            place = np.array(word, np.int64)[text] + cut.first - cut.starts[text]
            self.held.append((shard, np.array(row, np.int64)[text] + base, place, sizes, stops - begins, np.frombuffer(data, np.uint8)))
            self.words += int(sizes.sum())
            if self.words >= HELD:
                yield from self.flush(keep=True)
        if not self.held or len(self.ids) > 200_000:
            yield from self.flush()

    def flush(self, keep: bool = False) -> Iterator[tuple]:
        """All that is held; with ``keep``, rows may still have pieces to come."""
        if self.held:
            ids, keys = np.array(self.ids, np.int64), np.array(self.keys, np.int64)
            shard, row, place, sizes, room, data = (np.concatenate([h[k] for h in self.held]) for k in range(6))
            self.held, self.words = [], 0
            begins = np.cumsum(room) - room
            number = numbered(data, begins)
            least = np.full(int(number.max()) + 1, NO_ID, dtype=np.int64)
            np.minimum.at(least, number, ids[row])
            again = ids[row] > least[number]
            start, end, known = merged(place[again], place[again] + sizes[again], row[again])
            yield from self.known(ids, keys, known, start, end)
            text = data.tobytes()
            own = np.flatnonzero(~again)
            own = own[np.lexsort((number[own], shard[own]))]
            edges = np.flatnonzero(np.diff(shard[own], prepend=-1)).tolist()
            codec = pa.Codec("zstd", compression_level=3)
            for a, b in zip(edges, [*edges[1:], len(own)]):
                mine = own[a:b]
                lead = np.flatnonzero(np.diff(number[mine], prepend=-1))  # a string that a document has again travels once
                string = np.cumsum(np.diff(number[mine], prepend=number[mine[0]]) != 0)
                one = mine[lead]
                strings = b"".join([text[x:y] for x, y in zip(begins[one].tolist(), (begins + room)[one].tolist())])
                rest = thin(sizes[one]), thin(room[one]), least[number[one]].tobytes(), thin(string), keys[row[mine]].tobytes(), thin(place[mine])
                packed = pickle.dumps((strings, *rest), protocol=5)
                yield int(shard[mine[0]]), len(packed).to_bytes(8, "little") + codec.compress(packed, asbytes=True), None
        if not keep:
            self.clear()

    def known(self, ids: np.ndarray, keys: np.ndarray, row: np.ndarray, start: np.ndarray, end: np.ndarray) -> Iterator[tuple]:
        """Finished spans, dealt to the buckets one by one."""
        for a in range(0, len(row), 10_000):
            b = slice(a, a + 10_000)
            yield mixed(mixed(ids[row[b]].view(np.uint64)) + start[b].view(np.uint64)) % np.uint64(self.shards), None, (ids[row[b]], keys[row[b]], start[b], end[b])


class Shard:
    """Strings of one bucket as they come in: ``strings`` (bytes, words, sizes, document) and ``rows`` (string, text key, place) that have them."""

    def __init__(self, length: int = LENGTH):
        self.length = length
        self.strings: list[tuple] = []
        self.rows: list[tuple] = []
        self.words = self.count = 0
        self.room = 2 * SHARD_WORDS

    def add(self, blob: bytes) -> Iterator[tuple[np.ndarray, ...]]:
        """Takes strings in; spans known by then, if many equal strings have come."""
        raw = pa.Codec("zstd").decompress(blob[8:], decompressed_size=int.from_bytes(blob[:8], "little"), asbytes=True)
        strings, sizes, room, ids, string, keys, place = pickle.loads(raw)
        sizes = widen(sizes)
        self.strings.append((np.frombuffer(strings, np.uint8), sizes, widen(room), np.frombuffer(ids, np.int64)))
        self.rows.append((widen(string) + self.count, np.frombuffer(keys, np.int64), widen(place)))
        self.words += int(sizes.sum())
        self.count += len(sizes)
        if self.words > self.room:
            yield self.distinct()
            self.room = 2 * max(self.words, SHARD_WORDS)

    def distinct(self) -> tuple[np.ndarray, ...]:
        """Leaves one of equal strings, that of the smallest document; the spans of all others: document, text key, start, end."""
        data, sizes, room, doc = (np.concatenate([s[k] for s in self.strings]) for k in range(4))
        string, keys, place = (np.concatenate([r[k] for r in self.rows]) for k in range(3))
        begins = np.cumsum(room) - room
        number = numbered(data, begins)
        least = np.full(int(number.max()) + 1, NO_ID, dtype=np.int64)
        np.minimum.at(least, number, doc)
        again = doc[string] > least[number[string]]
        out = doc[string][again], keys[again], place[again], (place + sizes[string])[again]
        _, lead = np.unique(number, return_index=True)
        data, _ = gather(data, begins[lead], room[lead])
        self.strings, self.rows = [(data, sizes[lead], room[lead], least)], [(number[string][~again], keys[~again], place[~again])]
        self.words, self.count = int(sizes[lead].sum()), len(lead)
        return out

    def spans(self) -> Iterator[tuple[np.ndarray, ...]]:
        """Document, text key, start and end of what is repeated."""
        if not self.strings:
            return
        yield self.distinct()
        (data, sizes, _, doc), (string, keys, place) = self.strings[0], self.rows[0]
        self.strings, self.rows = [], []
        text = numbered(data, np.concatenate([[0], np.flatnonzero(data == 32)[:-1] + 1]))  # a number for each distinct word
        begins = np.cumsum(sizes) - sizes
        count = sizes - self.length + 1
        first = np.cumsum(count) - count
        owner = np.repeat(np.arange(len(sizes)), count)
        at = np.arange(len(owner)) + np.repeat(begins - first, count)
        repeated = self.repeated(text, at, doc[owner])
        opens = np.ones(len(owner) + 1, dtype=bool)  # a run ends with its string
        opens[1:-1] = (owner[1:] != owner[:-1]) | (repeated[1:] != repeated[:-1])
        begin, stops = np.flatnonzero(opens[:-1] & repeated), np.flatnonzero(opens[1:] & repeated)
        by = np.argsort(string, kind="stable")
        lo, hi = (np.searchsorted(string[by], owner[begin], side=side) for side in ("left", "right"))
        times = hi - lo
        which = by[np.repeat(lo - (np.cumsum(times) - times), times) + np.arange(times.sum())]
        start = place[which] + np.repeat(begin - first[owner[begin]], times)
        yield doc[string[which]], keys[which], start, start + np.repeat(stops - begin + self.length, times)

    def repeated(self, text: np.ndarray, at: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Which windows (their first words at ``at``) stand in a smaller document too: sorted by hash, then compared word by word."""
        out = np.zeros(len(at), dtype=bool)
        if len(at) == 0:
            return out
        digest = Ranges(mixed(text.astype(np.uint64) + np.uint64(1))).of(at, self.length)
        order = np.argsort(digest, kind="stable")
        digest = digest[order]
        heads = np.flatnonzero(np.concatenate([[True], digest[1:] != digest[:-1]]))
        many = np.diff(np.append(heads, len(order)))
        low, high = (f.reduceat(doc[order], heads) for f in (np.minimum, np.maximum))
        shared = low < high
        members = order[np.repeat(shared, many)]
        group = np.repeat(np.arange(int(shared.sum())), many[shared])
        lead = order[heads[shared]]
        same = np.ones(len(members), dtype=bool)
        for j in range(self.length):
            same &= text[at[members] + j] == text[at[lead[group]] + j]
        wrong = np.zeros(len(lead), dtype=bool)
        wrong[group[~same]] = True  # different windows of one hash
        fine = ~wrong[group]
        out[members[fine]] = doc[members[fine]] > low[shared][group[fine]]
        for g in np.flatnonzero(wrong).tolist():
            own = members[group == g]
            _, kind = np.unique(text[at[own][:, None] + np.arange(self.length)], axis=0, return_inverse=True)
            least = np.full(int(kind.max()) + 1, NO_ID, dtype=np.int64)
            np.minimum.at(least, kind.ravel(), doc[own])
            out[own] = doc[own] > least[kind.ravel()]
        return out


def rows_of(batch: pa.RecordBatch) -> list[tuple[int, int, bytes]]:
    ids = batch.column("doc_id").fill_null(int(NO_ID)).to_pylist()
    return [(i, k, t.encode()) for i, k, t in zip(ids, batch.column("text_hash").to_pylist(), batch.column("text").to_pylist()) if t]


SPANS = "doc_id long, text_hash long, start long, end long"


def find_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``doc_id, text_hash, start, end``: words that go; spans of a row may touch and overlap."""
    own = docs.select(whole_id(docs), text_key().alias("text_hash"), "text")
    hot, shards = hot_keys(own, lambda below: counter(length, gram, below), levels(length, gram), SHARD_WORDS, LEAST_HOT)

    def spans(found: tuple[np.ndarray, ...]) -> list[pa.Array]:
        return [pa.array(found[0], mask=found[0] == NO_ID), *(pa.array(x) for x in found[1:])]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = Cutter(shards, length, gram, hot)

        def boxed(found: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
            for shard, blob, known in found:
                if blob is None:
                    columns = [pa.array(shard.astype(np.int32)), pa.nulls(len(shard), pa.binary()), *spans(known)]
                else:
                    columns = [pa.array([shard], pa.int32()), pa.array([blob], pa.binary()), *[pa.nulls(1, pa.int64())] * 4]
                yield pa.RecordBatch.from_arrays(columns, names)

        for batch in slices(batches, "text"):
            yield from boxed(cutter.add(rows_of(batch)))
        yield from boxed(cutter.flush())

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = Shard(length)  # a partition is a bucket

        def told(found: tuple[np.ndarray, ...]) -> Iterator[pa.RecordBatch]:
            ids, keys, start, end = found
            start, end, keys, ids = merged(start, end, keys, ids)
            for a in range(0, len(ids), 50_000):
                b = slice(a, a + 50_000)
                yield pa.RecordBatch.from_arrays(spans((ids[b], keys[b], start[b], end[b])), names[2:])

        for batch in batches:
            ready = batch.filter(pa.compute.is_null(batch.column("packed")))
            if ready.num_rows:
                yield ready.select(names[2:])
            for blob in batch.column("packed"):
                if blob.is_valid:
                    for found in shard.add(blob.as_py()):
                        yield from told(found)
        for found in shard.spans():
            yield from told(found)

    names = ["shard", "packed", "doc_id", "text_hash", "start", "end"]
    dealt = own.mapInArrow(cut, f"shard int, packed binary, {SPANS}").repartitionById(shards, F.col("shard"))
    return dealt.mapInArrow(solve, SPANS)


def kept_words(text: bytes, spans: list[tuple[int, int]]) -> tuple[int, int, bytes]:
    """Number of words, words removed, and the words that are left, a blank between them."""
    data, ends, _ = normal(text)
    if not spans:
        return len(ends), 0, data[:-1].tobytes()
    edges = np.zeros(len(ends) + 1, dtype=np.int64)
    np.add.at(edges, [s for s, _ in spans], 1)
    np.add.at(edges, [e for _, e in spans], -1)
    gone = np.cumsum(edges[:-1]) > 0
    left = data[np.repeat(~gone, np.diff(ends, prepend=0))]
    return len(ends), int(gone.sum()), left[:-1].tobytes()


def deduplicate(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Per row ``doc_id, kept`` (the words that are left, a blank between them), ``n_words, n_removed``."""
    spans = stored(find_spans(docs, length, gram), "window-spans").groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    own = docs.select(F.col("doc_id").cast("long"), text_key().alias("text_hash"), "text")
    same = F.col("d.doc_id").eqNullSafe(F.col("s.doc_id")) & (F.col("d.text_hash") == F.col("s.text_hash"))
    both = own.alias("d").join(spans.alias("s"), same, "left").select("d.doc_id", "d.text", "s.spans")

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = [(t or "").encode() for t in batch.column("text").to_pylist()]
            lists = [[(x["start"], x["end"]) for x in s or ()] for s in batch.column("spans").to_pylist()]
            found = [kept_words(t, s) for t, s in zip(texts, lists)]
            columns = [pa.array([f[2].decode() for f in found], pa.string()), *(pa.array([f[k] for f in found], pa.int64()) for k in (0, 1))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "kept", "n_words", "n_removed"])

    return both.mapInArrow(drop, "doc_id long, kept string, n_words long, n_removed long")
