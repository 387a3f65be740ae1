"""Embedding whitening: vectors projected on the leading eigenvectors of their covariance, each to unit variance.

Entries become whole numbers, ``floor(SCALE * c) + SHIFT``, so counts and sums are exact whatever order tasks end in. One pass gives them
and the covariance: every block of rows is centred on its own mean before it is multiplied, and blocks are merged pairwise by
their counts and means. What leaves a task is a row for each dimension; the rows of a dimension meet in one task, which holds as
many of them as there were tasks, one at a time. Only the covariance, its size the square of the dimension, comes to the driver.

The spectrum is sliced: the signs of the pivots of an LDL' factorization of ``V - s I`` tell how many eigenvalues lie below ``s``
(Sylvester's law of inertia). Bisection by such counts isolates each leading eigenvalue; Rayleigh quotient iteration, whose
error is cubed at each step, then finds value and vector to double precision; counts a little below and above the value certify its number.
Eigenvalues too near for doubles to part are found as one group, orthogonal to each other.

Rows whose vector is null, empty or holds a null, NaN or infinite entry are dropped. Vectors of different lengths, or entries whose whole number
does not fit a long, are refused with a ValueError. Directions without variance (an eigenvalue of zero to double precision) have no unit
variance and are left out: a table of one distinct vector has no component. Repeated rows count as often as they stand there;
ties between eigenvalues give any orthonormal pair. An empty table gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 32
BLOCK = 1 << 20  # entries centred and multiplied at once
EPS = np.finfo(float).eps


# ---- spectrum of a symmetric matrix ----


class Factors:
    """``P A P' = L D L'`` with pivots of one or two rows (Bunch and Kaufman); the signs of D are those of A's eigenvalues."""

    def __init__(self, a: np.ndarray):
        a = np.array(a, dtype=float)
        n, alpha = len(a), (1 + 17**0.5) / 8
        self.lower, self.order, self.blocks = np.eye(n), np.arange(n), []
        k = 0
        while k < n:
            size, swap = 1, k
            if k < n - 1:
                r = k + 1 + int(np.argmax(np.abs(a[k + 1 :, k])))
                most, own = abs(a[r, k]), abs(a[k, k])
                if most and own < alpha * most:
                    row = np.abs(a[r, k:])
                    row[r - k] = 0
                    if own * row.max() >= alpha * most * most:
                        pass
                    elif abs(a[r, r]) >= alpha * row.max():
                        swap = r
                    else:
                        size, swap = 2, r
            at = k + size - 1
            if swap != at:
                a[[at, swap]] = a[[swap, at]]
                a[:, [at, swap]] = a[:, [swap, at]]
                self.lower[[at, swap], :k] = self.lower[[swap, at], :k]
                self.order[[at, swap]] = self.order[[swap, at]]
            pivot, below = a[k : k + size, k : k + size].copy(), a[k + size :, k : k + size].copy()
            if size == 2 or pivot[0, 0]:
                factor = below @ np.linalg.inv(pivot)
                self.lower[k + size :, k : k + size] = factor
                a[k + size :, k + size :] -= factor @ below.T
            self.blocks.append((k, pivot))
            k += size

    def negative(self) -> int:
        """How many eigenvalues are below zero; a pivot of two rows has one on each side."""
        return sum(1 if len(p) == 2 else int(p[0, 0] < 0) for _, p in self.blocks)

    def solve(self, b: np.ndarray, least: float) -> np.ndarray:
        """``A x = b``, pivots not smaller than ``least``: near an eigenvalue only the direction matters."""
        x = b[self.order]
        for j in range(len(x)):
            x[j + 1 :] -= self.lower[j + 1 :, j] * x[j]
        for k, p in self.blocks:
            if len(p) == 2:
                x[k : k + 2] = np.linalg.solve(p, x[k : k + 2])
            else:
                x[k] /= p[0, 0] if abs(p[0, 0]) > least else least
        for j in range(len(x) - 1, -1, -1):
            x[j] -= self.lower[j + 1 :, j] @ x[j + 1 :]
        out = np.empty_like(x)
        out[self.order] = x
        return out


class Slices:
    """Counts of eigenvalues at or above shifts, kept so that each count serves all eigenvalues."""

    def __init__(self, a: np.ndarray):
        self.a = a
        radius = np.abs(a).sum(axis=1)
        self.scale = float(radius.max())
        edge = self.scale * (1 + 8 * EPS) + np.finfo(float).tiny
        self.known = [(-edge, len(a)), (edge, 0)]

    def above(self, shift: float) -> int:
        count = len(self.a) - Factors(self.a - shift * np.eye(len(self.a))).negative()
        self.known.append((shift, count))
        return count

    def bracket(self, number: int) -> tuple[float, float]:
        """The closest known shifts around the eigenvalue of a number, counted from 1 by falling value."""
        return max(s for s, c in self.known if c >= number), min(s for s, c in self.known if c < number)

    def narrow(self, number: int) -> bool:
        """One bisection; false where doubles cannot part the ends any further."""
        low, high = self.bracket(number)
        middle = low + (high - low) / 2
        if not low < middle < high or high - low <= 4 * EPS * self.scale:
            return False
        self.above(middle)
        return True

    def isolated(self, number: int) -> bool:
        """Whether counts have left one eigenvalue in the bracket."""
        low, high = self.bracket(number)
        count = dict(self.known)
        return count[low] == number and count[high] == number - 1


def _orthogonal(x: np.ndarray, found: np.ndarray) -> np.ndarray:
    for _ in range(2):
        x = x - found.T @ (found @ x)
        x /= np.linalg.norm(x)
    return x


def _iterate(slices: Slices, number: int, found: np.ndarray) -> tuple[float, np.ndarray, float]:
    """Rayleigh quotient iteration from the middle of the bracket: value, vector and residual."""
    a, least = slices.a, EPS * slices.scale
    low, high = slices.bracket(number)
    shift = low + (high - low) / 2
    x = _orthogonal(np.random.default_rng(number).standard_normal(len(a)), found)
    best = (shift, x, np.inf)
    for turn in range(40):
        x = _orthogonal(Factors(a - shift * np.eye(len(a))).solve(x, least), found)
        value = float(x @ (a @ x))
        rest = float(np.linalg.norm(a @ x - value * x))
        if rest < best[2]:
            best = (value, x, rest)
        elif turn > 3 and rest <= 64 * len(a) * least:
            break
        if turn >= 2 and low <= value <= high:  # the first steps hold the shift, to turn towards the eigenvalue in the bracket
            shift = value
    return best


def leading(a: np.ndarray, k: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of a symmetric matrix above zero (to double precision) and their unit vectors, by rows."""
    slices, values, found = Slices(a), [], np.zeros((0, len(a)))
    if not slices.scale:
        return np.zeros(0), found
    for number in range(1, min(k, len(a)) + 1):
        while not slices.isolated(number) and slices.narrow(number):
            pass
        for _ in range(60):
            value, x, rest = _iterate(slices, number, found)
            room = max(4 * rest, 32 * len(a) * EPS * slices.scale)
            if rest <= 1e-9 * slices.scale and slices.above(value - room) >= number > slices.above(value + room):
                break
            if not slices.narrow(number):
                raise ArithmeticError(f"eigenvalue {number} was not certified")
        else:
            raise ArithmeticError(f"eigenvalue {number} did not converge")
        if value <= 64 * len(a) * EPS * (values or [value])[0]:
            break
        values.append(value)
        found = np.vstack([found, x])
    return np.array(values), found


# ---- moments of a table ----


class Moments:
    """Count, mean and centred products of rows, and exact sums of whole numbers beside them."""

    def __init__(self):
        self.n, self.totals = 0, None

    def add(self, rows: np.ndarray, whole: np.ndarray | None = None) -> None:
        step = max(1, BLOCK // max(1, rows.shape[1]))
        for i in range(0, len(rows), step):
            part = rows[i : i + step]
            mean = part.mean(axis=0)
            part = part - mean
            self.merge(len(part), mean, part.T @ part)
        if whole is not None and len(whole):
            fits = int(max(abs(int(whole.max())), abs(int(whole.min())))) * len(whole) < 2**63
            sums = [int(s) for s in (whole if fits else whole.astype(object)).sum(axis=0)]
            self.totals = sums if self.totals is None else [a + b for a, b in zip(self.totals, sums)]

    def merge(self, n: int, mean: np.ndarray, products: np.ndarray, row: int | None = None) -> None:
        """Take in another block; with ``row``, ``products`` is that row of the matrix alone."""
        if not self.n:
            self.n, self.mean, self.products = n, mean, products
            return
        total, apart = self.n + n, mean - self.mean
        cross = np.outer(apart, apart) if row is None else apart[row] * apart
        self.products = self.products + products + cross * (self.n * n / total)
        self.mean = self.mean + apart * (n / total)
        self.n = total


PARTIAL = "dimension int, width int, n long, total decimal(38,0), mean array<double>, products array<double>"


def _partial_rows(found: dict[int, tuple[int, int, np.ndarray, np.ndarray]], width: int) -> pa.RecordBatch:
    keys = sorted(found)
    columns = [
        pa.array(keys, pa.int32()), pa.array([width] * len(keys), pa.int32()), pa.array([found[i][0] for i in keys], pa.int64()),
        pa.array([Decimal(found[i][1]) for i in keys], pa.decimal128(38, 0)), *(pa.array([found[i][j] for i in keys], pa.list_(pa.float64())) for j in (2, 3)),
    ]
    return pa.RecordBatch.from_arrays(columns, ["dimension", "width", "n", "total", "mean", "products"])


def moments(vectors: DataFrame, read: Callable[[pa.RecordBatch], tuple[np.ndarray, np.ndarray | None]]) -> tuple[Moments, list[int]] | None:
    """Moments of all rows of ``vectors``, and the exact sums of what ``read`` gives beside them; None for an empty table.

    ``read`` turns a batch into a matrix of doubles and one of whole numbers (or None).
    """
    spark = vectors.sparkSession

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, width = Moments(), None
        for batch in batches:
            if batch.num_rows:
                rows, whole = read(batch)
                if width not in (None, rows.shape[1]):
                    raise ValueError("vectors differ in length")
                width = rows.shape[1]
                own.add(rows, whole)
        if own.n:
            totals = own.totals or [0] * width
            for i in range(0, width, 256):
                yield _partial_rows({j: (own.n, totals[j], own.mean, own.products[j]) for j in range(i, min(i + 256, width))}, width)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, Moments] = {}
        widths = set()
        for batch in batches:
            column = {name: batch.column(name) for name in batch.schema.names}
            for k, i in enumerate(column["dimension"].to_pylist()):
                one = held.setdefault(i, Moments())
                widths.add(column["width"][k].as_py())
                if len(widths) > 1:
                    raise ValueError("vectors differ in length")
                mean, products = (np.array(column[c][k].values) for c in ("mean", "products"))
                one.merge(column["n"][k].as_py(), mean, products, row=i)
                one.totals = (one.totals or 0) + int(column["total"][k].as_py())
        if held:
            yield _partial_rows({i: (m.n, m.totals, m.mean, m.products) for i, m in held.items()}, widths.pop())

    # as many partial matrices as cores, not as blocks of the input
    parts = vectors.coalesce(max(2, 2 * spark.sparkContext.defaultParallelism)).mapInArrow(add_up, PARTIAL)
    rows = sorted(parts.repartition("dimension").mapInArrow(merge, PARTIAL).collect(), key=lambda r: r.dimension)
    if not rows:
        return None
    if len({(r.width, r.n) for r in rows}) > 1 or len(rows) != rows[0].width:
        raise ValueError("vectors differ in length")
    out = Moments()
    products = np.array([r.products for r in rows])
    out.merge(rows[0].n, np.array(rows[0].mean), (products + products.T) / 2)
    return out, [int(r.total) for r in rows]


def covariance(m: Moments) -> np.ndarray:
    return m.products / m.n


# ---- whitening ----


@dataclass(frozen=True)
class Whitening:
    """``n`` vectors with exact ``sums`` of whole entries less ``SHIFT``; eigenvalues, their unit vectors by rows, and the trace."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def explained(self) -> list[float]:
        return [float(v / self.trace) for v in self.values]


def usable(rows: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector has entries, all of them finite."""
    bad = F.exists(vector, lambda c: c.isNull() | ~(F.abs(c.cast("double")) < F.lit(float("inf"))))
    return rows.where(F.col(vector).isNotNull() & (F.size(vector) > 0) & ~bad)


def whole_entries(column: pa.ListArray) -> np.ndarray:
    """Entries as whole numbers less ``SHIFT``, a row for each vector."""
    sizes = np.diff(column.offsets.to_numpy())
    if len(set(sizes.tolist())) > 1:
        raise ValueError("vectors differ in length")
    scaled = np.floor(SCALE * column.flatten().to_numpy(zero_copy_only=False).astype(float))
    if len(scaled) and not np.abs(scaled).max() < 2**62:
        raise ValueError("an entry is too large for a whole number")
    return scaled.astype(np.int64).reshape(len(sizes), -1)


def fit(rows: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """The whitening of all usable rows; None if there are none."""

    def read(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        whole = whole_entries(batch.column(0))
        return whole.astype(float), whole

    found = moments(usable(rows.select(vector), vector), read)
    if found is None:
        return None
    m, sums = found
    v = covariance(m)
    values, vectors = leading(v, components)
    return Whitening(m.n, tuple(sums), values, vectors, float(np.trace(v)))


def project(whole: np.ndarray, model: Whitening) -> np.ndarray:
    """Centred entries on the components, to unit variance."""
    mean = np.array([s / model.n for s in model.sums])
    return (whole - mean) @ (model.vectors / np.sqrt(model.values)[:, None]).T


def deviations(whole: np.ndarray, model: Whitening) -> list[int]:
    """Per row the exact sum of squares of ``n x - S``; the shift falls out."""
    most = model.n * max(abs(int(whole.max())), abs(int(whole.min()))) + max(map(abs, model.sums)) if whole.size else 0
    kind = np.int64 if most * most * whole.shape[1] < 2**63 else object
    apart = whole.astype(kind) * model.n - np.array(model.sums, dtype=kind)
    return [int(x) for x in (apart * apart).sum(axis=1)]


def whiten(rows: DataFrame, model: Whitening | None, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Per usable row ``key``, ``n`` long, ``deviation`` decimal and ``whitened``, an array of doubles, one for each component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and model is not None:
                whole = whole_entries(batch.column(1))
                apart = pa.array([Decimal(d) for d in deviations(whole, model)], pa.decimal128(38, 0))
                n = pa.array(np.full(len(whole), model.n))
                yield pa.RecordBatch.from_arrays([batch.column(0), n, apart, pa.array(list(project(whole, model)), pa.list_(pa.float64()))], names)

    names = [key, "n", "deviation", "whitened"]
    kind = rows.schema[key].dataType.simpleString()
    return usable(rows.select(key, vector), vector).mapInArrow(run, f"`{key}` {kind}, n long, deviation decimal(38,0), whitened array<double>")


def identity_error(rows: DataFrame, model: Whitening | None, vector: str = "embedding") -> float:
    """Largest absolute entry of the covariance of the whitened rows less the identity, measured on all rows."""
    if model is None or not len(model.values):
        return 0.0
    found = moments(usable(rows.select(vector), vector), lambda batch: (project(whole_entries(batch.column(0)), model), None))
    return float(np.abs(covariance(found[0]) - np.eye(len(model.values))).max())
