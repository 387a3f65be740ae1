"""External suffix sorting by induction, with common-prefix values carried along.

The order of a text's suffixes is induced from the order of its leftmost-small suffixes (those smaller than their successor
and preceded by a larger suffix), and theirs from a shorter text of names, recursively. Induction reads suffixes in order out of a
priority queue and puts the suffix that starts one place before back into it, as a tuple of symbol, place and common-prefix
value with the tuple before it in its symbol. The queue is monotone: it is kept as one list for each range of symbols, in the
order of arrival, and what exceeds ``MEMORY`` bytes goes to a file. The long results are files mapped into memory. The order of
names, ranges of several symbols and the leftmost-small suffixes are held in memory, so a text must be far smaller than it.

Ranges of one symbol (all of them at the top, where symbols are bytes) take what arrives while they are read; in ranges of
several symbols (names) the suffixes that the range induces in itself are found first and ranked together.
"""

from __future__ import annotations

import tempfile

import numpy as np

MEMORY = 64 << 20
BLOCK = 1 << 17
NO = 255


def room(n: int, dtype) -> np.ndarray:
    """An array of ``n`` values, in a nameless temporary file if it is long."""
    if n * np.dtype(dtype).itemsize <= MEMORY:
        return np.empty(n, dtype=dtype)
    file = tempfile.TemporaryFile()
    file.truncate(n * np.dtype(dtype).itemsize)
    return np.memmap(file, dtype=dtype, mode="r+", shape=(n,))


class Queue:
    """For each range of symbols the places (and common-prefix values) that arrived, first in, first out; beyond ``MEMORY`` in a file."""

    def __init__(self, ranges: int, dtype, carries: bool):
        self.dtype, self.carries = np.dtype(dtype), carries
        self.lists: list[list] = [[] for _ in range(ranges)]
        self.on_disk: list[list[tuple[int, int]]] = [[] for _ in range(ranges)]
        self.held, self.file = 0, None

    def push(self, r: int, places: np.ndarray, common: np.ndarray | None) -> None:
        self.lists[r].append((places, common))
        self.held += places.nbytes + (common.nbytes if self.carries else 0)
        if self.held > MEMORY:
            self.spill()

    def spill(self) -> None:
        self.file = self.file or tempfile.TemporaryFile()
        self.file.seek(0, 2)
        for r, parts in enumerate(self.lists):
            if parts:
                self.on_disk[r].append((self.file.tell(), sum(len(p) for p, _ in parts)))
                for p, _ in parts:
                    self.file.write(p.tobytes())
                if self.carries:
                    for _, c in parts:
                        self.file.write(c.tobytes())
                self.lists[r] = []
        self.held = 0

    def pop(self, r: int):
        """Blocks of what has arrived for range ``r`` and is not yet read."""
        stored, parts = self.on_disk[r], self.lists[r]
        self.on_disk[r], self.lists[r] = [], []
        for at, n in stored:
            for start in range(0, n, BLOCK):
                k = min(BLOCK, n - start)
                self.file.seek(at + start * self.dtype.itemsize)
                places = np.frombuffer(self.file.read(k * self.dtype.itemsize), dtype=self.dtype)
                common = None
                if self.carries:
                    self.file.seek(at + n * self.dtype.itemsize + start)
                    common = np.frombuffer(self.file.read(k), dtype=np.uint8)
                yield places, common
        for places, _ in parts:
            self.held -= places.nbytes + (places.size if self.carries else 0)
        group, size = [], 0
        for part in parts:
            group.append(part)
            size += len(part[0])
            if size >= BLOCK:
                yield _joined(group, self.carries)
                group, size = [], 0
        if group:
            yield _joined(group, self.carries)


def _joined(parts: list, carries: bool):
    if len(parts) == 1:
        return parts[0]
    return np.concatenate([p for p, _ in parts]), np.concatenate([c for _, c in parts]) if carries else None


def range_minima(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Minimum of ``values[first : last + 1]`` for each pair, by a table of minima over powers of two."""
    width = last - first + 1
    level = np.zeros(len(width), dtype=np.int64)
    k, n = 0, int(width.max(initial=1))
    table, out = values, values[first].copy()
    while (2 << k) <= n:
        table = np.minimum(table[: -(1 << k)], table[1 << k :])
        k += 1
        here = (width >= (1 << k)) & ((width < (2 << k)) | ((2 << k) > n))
        level[here] = k
        out[here] = np.minimum(table[first[here]], table[last[here] - (1 << k) + 1])
    return out


def kinds(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next; the last, the sentinel, counts as that."""
    small = room(len(text), bool)
    ends = np.flatnonzero(text[1:] != text[:-1])
    small[:-1] = np.repeat(text[ends] < text[ends + 1], np.diff(ends, prepend=-1))
    small[-1] = True
    return small


def packed(text: np.ndarray, at: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, int]:
    """The next symbols from ``at`` as one number, all ones past ``left`` symbols; and how many symbols that were."""
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    if text.dtype == np.uint8:
        n = 8
        view = np.ndarray((len(text) - 7,), dtype=">u8", buffer=text, strides=(1,))
        key = view[np.minimum(at, len(text) - 8)].astype(np.uint64)
        short = np.maximum(at - (len(text) - 8), 0)  # the text has eight symbols or more; the last words are read by shifting
        key = np.where(short < 8, key << (np.minimum(short, 7) * 8).astype(np.uint64), np.uint64(0))
    else:
        n = 2
        second = np.minimum(at + 1, len(text) - 1)
        key = text[np.minimum(at, len(text) - 1)].astype(np.uint64) << np.uint64(32) | text[second].astype(np.uint64)
    bits = 64 // n
    over = np.clip(n - left, 0, n) * bits
    mask = np.where(over >= 64, full, (np.uint64(1) << np.minimum(over, 63).astype(np.uint64)) - np.uint64(1))
    return key | mask, n


def names(text: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, int]:
    """Dense ranks of the substrings; one that begins another comes after it, as leftmost-small substrings want it."""
    m = len(starts)
    rank, order, group = room(m, np.int64), np.arange(m), np.zeros(m, dtype=np.int64)
    done = 0
    while len(order):
        key, n = packed(text, starts[order] + done, lengths[order] - done)
        by = np.lexsort((key, group))
        order, group, key = order[by], group[by], key[by]
        new = np.ones(len(order), dtype=bool)
        new[1:] = (group[1:] != group[:-1]) | (key[1:] != key[:-1])
        head = np.ones(len(order), dtype=bool)
        head[1:] = group[1:] != group[:-1]
        heads = np.flatnonzero(head)
        within = np.arange(len(order)) - np.repeat(heads, np.diff(heads, append=len(order)))
        firsts = np.flatnonzero(new)
        sizes = np.diff(firsts, append=len(order))
        group = np.repeat(group[firsts] + within[firsts], sizes)
        rank[order] = group
        done += n
        more = np.repeat(sizes > 1, sizes) & (lengths[order] > done)
        keep = np.repeat(np.logical_or.reduceat(more, firsts), sizes) if len(order) else more
        order, group = order[keep], group[keep]
    present = np.zeros(m, dtype=np.int64)
    present[rank] = 1
    dense = np.cumsum(present) - 1
    return dense[rank], int(dense[-1]) + 1


def direct_common(text: np.ndarray, a: np.ndarray, b: np.ndarray, cap: int) -> np.ndarray:
    """Common-prefix length of suffixes ``a`` and ``b``, up to ``cap``, by comparing words of eight bytes."""
    out = np.zeros(len(a), dtype=np.int64)
    live = np.arange(len(a))
    while len(live):
        left = np.full(len(live), 8)
        x = packed(text, a[live] + out[live], left)[0] ^ packed(text, b[live] + out[live], left)[0]
        same = x == 0
        zeros = np.zeros(len(live), dtype=np.int64)
        if (~same).any():
            zeros[~same] = (63 - np.frexp(x[~same].astype(np.float64))[1].astype(np.int64) + 1).clip(0) // 8
            # rounding to a float can carry into the next power of two; the byte itself decides
            shift = (56 - 8 * zeros[~same]).clip(0).astype(np.uint64)
            zeros[~same] += ((x[~same] >> shift) & np.uint64(0xFF)) == 0
        out[live] += np.where(same, 8, zeros)
        live = live[same & (out[live] < cap)]
    return np.minimum(out, cap).astype(np.uint8)


class Induction:
    """One pass: from ``seeds`` in order to all ``wanted`` suffixes, by ascending ``values``."""

    def __init__(self, values: np.ndarray, wanted: np.ndarray, bounds: np.ndarray, text: np.ndarray, cap: int | None):
        self.values, self.wanted, self.bounds, self.text, self.cap = values, wanted, bounds, text, cap
        self.place = np.int32 if len(values) < 2**31 else np.int64
        self.queue = Queue(len(bounds) - 1, self.place, cap is not None)
        n = int(np.count_nonzero(wanted))
        self.out, self.common, self.n = room(n, self.place), room(n, np.uint8) if cap is not None else None, 0
        self.pending = np.full(len(bounds) - 1, NO, dtype=np.uint8)  # least common prefix since the last arrival
        self.arrived = np.zeros(len(bounds) - 1, dtype=bool)

    def put(self, places: np.ndarray, common: np.ndarray | None) -> None:
        k = len(places)
        self.out[self.n : self.n + k] = places
        if self.cap is not None:
            self.common[self.n : self.n + k] = common
        self.n += k

    def before(self, places: np.ndarray, from_symbol: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Indices into ``places`` and the wanted suffixes one place before them."""
        at = np.flatnonzero(places > 0)
        previous = places[at] - 1
        keep = self.wanted[previous]
        if from_symbol:
            keep &= self.values[previous] >= from_symbol
        return at[keep], previous[keep]

    def feed(self, places: np.ndarray, common: np.ndarray | None, from_symbol: int = 0) -> None:
        """Puts what ``places``, the next suffixes in order, induce into the queue."""
        at, previous = self.before(places, from_symbol)
        r = self.values[previous]
        if r.dtype != np.uint8:  # a byte is its range
            r = np.searchsorted(self.bounds, r, side="right") - 1
        by = np.argsort(r, kind="stable")
        at, previous, r = at[by], previous[by].astype(self.place), r[by].astype(np.int64)
        change = np.ones(len(r), dtype=bool)
        np.not_equal(r[1:], r[:-1], out=change[1:])
        heads = np.flatnonzero(change)
        carried = None
        if self.cap is not None:
            first = np.empty(len(at), dtype=np.int64)
            first[1:] = at[:-1] + 1
            first[heads] = 0
            if len(at):
                least = range_minima(common, first, at)
                least[heads] = np.minimum(least[heads], self.pending[r[heads]])
                carried = np.minimum(least.astype(np.int64) + 1, self.cap).astype(np.uint8)
                carried[heads] = np.where(self.arrived[r[heads]], carried[heads], 0)
            backwards = np.append(np.minimum.accumulate(common[::-1])[::-1], NO).astype(np.uint8)
            self.pending = np.minimum(self.pending, backwards[0])
            tails = np.append(heads[1:], len(at)) - 1 if len(at) else heads
            self.pending[r[tails]] = backwards[at[tails] + 1]
            self.arrived[r[tails]] = True
        for a, b in zip(heads.tolist(), [*heads[1:].tolist(), len(at)]):
            self.queue.push(int(r[a]), previous[a:b], carried[a:b] if carried is not None else None)

    def single(self, r: int, seeds: np.ndarray, common: np.ndarray | None) -> None:
        """A range of one symbol: what arrives while it is read belongs to its end."""
        last = None
        while self.queue.lists[r] or self.queue.on_disk[r]:
            for places, own in self.queue.pop(r):
                self.put(places, own)
                self.feed(places, own)
                last = places[-1]
        if len(seeds) and self.cap is not None:
            common = common.copy()
            common[0] = 0 if last is None else direct_common(self.text, np.array([last], np.int64), seeds[:1].astype(np.int64), self.cap)[0]
        for start in range(0, len(seeds), BLOCK):
            self.feed(seeds[start : start + BLOCK], None if common is None else common[start : start + BLOCK])

    def several(self, r: int, seeds: np.ndarray) -> None:
        """A range of several symbols: first all that it induces in itself, then their common order."""
        arrived = [p for p, _ in self.queue.pop(r)]
        arrived = np.concatenate(arrived) if arrived else seeds[:0].astype(self.place)
        top = int(self.bounds[r + 1])
        places = np.concatenate([arrived, seeds.astype(self.place)])
        layer = np.concatenate([np.zeros(len(arrived), np.int8), np.full(len(seeds), 2, np.int8)])
        key, parent, depth = np.arange(len(places)), np.full(len(places), -1), np.zeros(len(places), np.int64)
        front, d = np.arange(len(places)), 0
        while len(front):
            at, previous = self.before(places[front])
            inside = self.values[previous] < top
            at, previous, d = front[at[inside]], previous[inside], d + 1
            front = np.arange(len(places), len(places) + len(at))
            places, parent = np.concatenate([places, previous.astype(self.place)]), np.concatenate([parent, at])
            layer, depth = np.concatenate([layer, np.ones(len(at), np.int8)]), np.concatenate([depth, np.full(len(at), d)])
            key = np.concatenate([key, np.zeros(len(at), key.dtype)])
        symbol, rank, order = self.values[places], np.zeros(len(places), np.int64), np.arange(0)
        for k in range(d):
            live = np.flatnonzero(depth <= k)
            inner = layer[live] == 1
            key[live[inner]] = rank[parent[live[inner]]]
            order = live[np.lexsort((key[live], layer[live], symbol[live]))]
            rank[order] = np.arange(len(order))
        places, layer = places[order], layer[order]
        self.put(places[layer < 2], None)
        for start in range(0, len(places), BLOCK):
            self.feed(places[start : start + BLOCK], None, top)

    def run(self, seeds: np.ndarray, common: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray | None]:
        edges = np.searchsorted(self.values[seeds], self.bounds)
        for r in range(len(self.bounds) - 1):
            own = slice(edges[r], edges[r + 1])
            if self.bounds[r + 1] - self.bounds[r] == 1:
                self.single(r, seeds[own], None if common is None else common[own])
            else:
                self.several(r, seeds[own])
        return self.out[: self.n], None if self.cap is None else self.common[: self.n]


def bounds(values: np.ndarray, symbols: int) -> np.ndarray:
    """Ranges of symbols: single where a symbol stands beside itself (its suffixes induce each other one by one), else of about ``BLOCK`` suffixes."""
    if values.dtype == np.uint8:
        return np.arange(257)
    counts = np.bincount(values, minlength=symbols)
    alone = np.zeros(symbols, dtype=bool)
    alone[values[1:][values[1:] == values[:-1]]] = True
    out, held = [0], 0
    cuts = np.flatnonzero(alone)
    total = np.cumsum(counts)
    marks = np.unique(np.concatenate([cuts, cuts + 1, np.searchsorted(total, np.arange(BLOCK, total[-1] + BLOCK, BLOCK)) + 1, [0, symbols]]))
    return marks[marks <= symbols]


def suffix_order(text: np.ndarray, cap: int | None = None) -> tuple[np.ndarray, np.ndarray | None]:
    """Places of all suffixes in order and, with ``cap``, each one's common prefix with the one before, up to ``cap`` symbols.

    ``text`` is uint8 or uint32, its last symbol 0 and nowhere else; with ``cap`` it is uint8 and has eight symbols or more.
    """
    n = len(text)
    if n == 1:
        return np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.uint8)
    small = kinds(text)
    leftmost = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    lengths = np.append(np.diff(leftmost) + 1, 1)
    name, distinct = names(text, leftmost, lengths)
    if distinct == len(name):
        order = np.empty(len(name), dtype=np.int64)
        order[name] = np.arange(len(name))
    else:
        order, _ = suffix_order(name.astype(np.uint32))
    seeds = leftmost[order]
    common = None
    if cap is not None:
        common = np.zeros(len(seeds), dtype=np.uint8)
        common[1:] = direct_common(text, seeds[:-1], seeds[1:], cap)
    symbols = int(text.max()) + 1
    large, large_common = Induction(text, ~small, bounds(text, symbols), text, cap).run(seeds, common)
    # the other way round: symbols and order reversed, from all larger suffixes to the smaller ones
    flipped = (text.dtype.type(symbols - 1) - text) if text.dtype == np.uint32 else np.uint8(255) - text
    back_common = None
    if cap is not None and len(large):
        back_common = np.zeros(len(large), dtype=np.uint8)
        back_common[1:] = large_common[:0:-1]
    wanted = small.copy()
    wanted[-1] = False  # nothing stands behind the sentinel
    rest, rest_common = Induction(flipped, wanted, bounds(flipped, symbols), text, cap).run(large[::-1].astype(np.int64), back_common)
    rest = np.concatenate([[n - 1], rest[::-1]]).astype(np.int64)
    both = room(n, np.int64)
    both[: len(large)], both[len(large) :] = large, rest
    by = np.argsort(text[both].astype(np.int64) * 2 + small[both], kind="stable")
    order = both[by]
    if cap is None:
        return order, None
    values = np.zeros(n, dtype=np.uint8)
    values[: len(large)] = large_common
    if len(rest) > 2:
        values[len(large) + 2 :] = rest_common[:0:-1]
    values = values[by]
    seam = np.flatnonzero(small[order[1:]] != small[order[:-1]]) + 1
    starts = np.flatnonzero(text[order[1:]] != text[order[:-1]]) + 1
    values[seam] = direct_common(text, order[seam - 1], order[seam], cap)
    values[starts] = 0
    values[0] = 0
    return order, values
