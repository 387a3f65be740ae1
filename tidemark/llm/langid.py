"""Language identification: averaged hashed subword embeddings, a linear softmax, calibrated rejection.

A text is lower-cased; runs of characters that are no letters become one blank; its features are the hashed character
sequences of ``GRAMS`` lengths, blanks included. The document vector is the mean of the features' embeddings, a linear
softmax gives the classes. Embeddings and weights are trained together by stochastic gradient descent in numpy on a bounded
sample: about ``per_language`` labelled rows of each language, chosen by hash. Training and predictions read whole texts; of a
sampled text the driver gets its bag, the buckets and how often each is met, at most ``2 ** BUCKET_BITS`` numbers.

A tenth of the sample is left out of training; on it the softmax's temperature and the rejection threshold are fitted. The
threshold is the highest score at which at most one in a thousand right answers is rejected, and never over one half.

Null texts, empty texts and texts without a letter are ``und`` with score 0. Ties go to the language first in the alphabet.
Rows that repeat get the same answer; the answer depends on the text alone. Rows of null language, text or id are never
learned. An empty training set teaches no language: all is ``und``. Extra columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.batches import mapped, replaced, replaced_schema, slices
from tidemark.llm.shingles import bounded

UNKNOWN = "und"
PER_LANGUAGE = 1500
TOTAL_ROWS = 4 * PER_LANGUAGE  # of all languages together; a row's bag is at most 6 bytes for each of the buckets
GRAMS = (2, 3, 4)
BUCKET_BITS = 16
WIDTH = 16
EPOCHS = 6
PIECE = 1 << 20
_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)
_letters: list[np.ndarray] = []


def letters() -> np.ndarray:
    """For every code point, whether it is a letter; built once per process."""
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000))
    return _letters[0]


def code_points(text: str) -> np.ndarray:
    """Lower-cased letters, 32 for each run of others; a blank at either end."""
    points = np.frombuffer(text.lower().encode("utf-32-le"), dtype=np.uint32)
    points = np.where(letters()[points], points, np.uint32(32))
    points = np.concatenate([[32], points, [32]]).astype(np.uint32)
    blank = points == 32
    return points[~(blank & np.concatenate([[False], blank[:-1]]))]


def buckets(points: np.ndarray) -> np.ndarray:
    """Bucket of every feature of the text."""
    wide, found = points.astype(np.uint64), []
    for n in GRAMS:
        count = len(wide) - n + 1
        if count <= 0:
            break
        h = np.full(count, n, dtype=np.uint64)
        for k in range(n):
            h = (h ^ wide[k : k + count]) * _MULTIPLY
            h ^= h >> np.uint64(29)
        found.append((h >> np.uint64(64 - BUCKET_BITS)).astype(np.int32))
    return np.concatenate(found) if found else np.zeros(0, np.int32)


def text_pieces(text: str) -> Iterator[np.ndarray]:
    """Buckets of the features of each piece that has letters."""
    for start in range(0, len(text), PIECE):
        points = code_points(text[max(0, start - max(GRAMS)) : start + PIECE])
        if len(points) >= 2 and (points != 32).any():
            yield buckets(points)


def bag(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The text's buckets, each once, and how often each is met; empty without a letter."""
    times = np.zeros(1 << BUCKET_BITS, dtype=np.int64)
    for own in text_pieces(text):
        times += np.bincount(own, minlength=len(times))
    found = np.flatnonzero(times)
    return found.astype(np.uint16), times[found]


@dataclass
class Model:
    """``table`` holds each bucket's embedding times the weights, so a prediction is a mean of its rows."""

    languages: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0

    def logits(self, text: str | None) -> np.ndarray | None:
        """Null if nothing speaks for any language; a long text is read in pieces."""
        if not text or not self.languages:
            return None
        total, count, some = np.zeros(len(self.languages)), 0, False
        for own in text_pieces(text):
            total += self.table.take(own, axis=0).sum(axis=0, dtype=np.float64)
            count, some = count + len(own), True
        return total / count + self.bias if some else None

    def predict(self, text: str | None) -> tuple[str, float]:
        z = self.logits(text)
        if z is None:
            return UNKNOWN, 0.0
        p = softmax(z[None] / self.temperature)[0]
        return self.languages[int(p.argmax())], float(p.max())


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


#: a text's buckets, the share of each, and its language
Bag = tuple[np.ndarray, np.ndarray, str]


def train(rows: list[tuple[str, str]], seed: int = 7, epochs: int = EPOCHS, rate: float = 0.5) -> Model:
    """``rows``: (text, language), in any order; the same rows give the same model."""
    bags = ((*bag(t), x) for t, x in sorted(rows))
    return fit([(own, (times / times.sum()).astype(np.float32), x) for own, times, x in bags if len(own)], seed, epochs, rate)


def fit(rows: list[Bag], seed: int = 7, epochs: int = EPOCHS, rate: float = 0.5) -> Model:
    """The model of bags in this order."""
    languages = sorted({x for *_, x in rows})
    size = 1 << BUCKET_BITS
    if not languages:
        return Model([], np.zeros((size, 0), np.float32), np.zeros(0))
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(rows))
    y = np.array([languages.index(x) for *_, x in rows])
    left_out, learned = order[: len(rows) // 10], order[len(rows) // 10 :]
    share = np.bincount(y[learned], minlength=len(languages)) / len(learned)
    weight = 1 / np.maximum(share[y] * len(languages), 0.1)  # rare languages count more
    embed = (rng.random((size, WIDTH), dtype=np.float32) - 0.5) / WIDTH
    out = np.zeros((WIDTH, len(languages)), dtype=np.float32)
    bias = np.zeros(len(languages), dtype=np.float32)
    steps, done = epochs * len(learned), 0
    for _ in range(epochs):
        for i in rng.permutation(learned):
            own, part, _ = rows[i]
            step, done = rate * (1 - done / steps), done + 1
            vector = part @ embed[own]
            gap = softmax((vector @ out + bias)[None])[0].astype(np.float32)
            gap[y[i]] -= 1
            gap *= np.float32(step * weight[i])
            back = out @ gap
            out -= np.outer(vector, gap)
            bias -= np.float32(0.02) * gap
            embed[own] -= np.outer(part, back) * np.float32(len(own) ** 0.5)
    model = Model(languages, embed @ out, bias.astype(np.float64))
    return calibrate(model, [rows[i] for i in (left_out if len(left_out) else learned)])


def calibrate(model: Model, rows: list[Bag], lost: float = 0.001) -> Model:
    """Temperature by likelihood, threshold by the share of right answers that it may cost, on rows not trained on."""
    z = np.array([part.astype(np.float64) @ model.table[own] + model.bias for own, part, _ in rows])
    y = np.array([model.languages.index(x) for *_, x in rows])
    grid = 2.0 ** np.arange(-6, 4, 0.25)
    at = np.arange(len(y))
    model.temperature = float(min(grid, key=lambda t: -np.log(np.maximum(softmax(z / t)[at, y], 1e-12)).mean()))
    p = softmax(z / model.temperature)
    right = p.max(axis=1)[p.argmax(axis=1) == y]
    model.threshold = float(min(0.5, np.quantile(right, lost, method="lower"))) if len(right) else 0.0
    return model


def _sampled(labelled: DataFrame, per_language: int, total: int = TOTAL_ROWS) -> DataFrame:
    """``text, lang`` of about ``per_language`` rows of each language, and of ``total`` in all, the same ones at every run: those
    whose hash is under their language's share."""
    rows = labelled.where("text is not null and lang is not null and doc_id is not null").select("doc_id", "text", "lang")
    counts = rows.groupBy("lang").agg(F.count("*").alias("rows_"))
    languages = counts.count()
    per_language = min(per_language, -(-total // max(1, languages)))
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / (1 << 30)
    shares = bounded(counts.select("lang", (F.lit(per_language) / F.col("rows_")).alias("share_")), languages)
    return rows.join(shares, "lang").where(draw < F.col("share_")).select("text", "lang")


def training_sample(labelled: DataFrame, per_language: int = PER_LANGUAGE) -> list[tuple[str, str]]:
    """The sampled texts, whole."""
    return [tuple(r) for r in _sampled(labelled, per_language).collect()]


def training_bags(labelled: DataFrame, per_language: int = PER_LANGUAGE) -> list[Bag]:
    """Bags of the sampled texts, made where the texts are, in the order of the texts' digests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = [bag(t) for t in batch.column("text").to_pylist()]
            own = pa.array([x.tobytes() for x, _ in found], pa.binary())
            part = pa.array([(n / max(1, n.sum())).astype(np.float32).tobytes() for _, n in found], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("lang"), own, part], ["key", "lang", "own", "part"])

    keyed = _sampled(labelled, per_language).select(F.sha2("text", 256).alias("key"), "lang", "text")
    bags = mapped(keyed, run, "key string, lang string, own binary, part binary").where("length(own) > 0").collect()
    bags.sort(key=lambda r: (r.key, r.lang))
    return [(np.frombuffer(r.own, np.uint16), np.frombuffer(r.part, np.float32), r.lang) for r in bags]


def learn(labelled: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    return fit(training_bags(labelled, per_language))


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred, score, accepted``: the most likely language, its calibrated probability, and whether that
    reaches the threshold; columns of these names are replaced. The model is broadcast: ``2 ** BUCKET_BITS`` rows of one number a language."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in slices(batches, text):
            found = [own.predict(t) for t in batch.column(text).to_pylist()]
            names, scores = pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())
            taken = pa.array([x != UNKNOWN and s >= own.threshold for x, s in found], pa.bool_())
            yield replaced(batch, [names, scores, taken], extra)

    extra = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("accepted", T.BooleanType())]
    return mapped(docs, run, replaced_schema(docs, extra))
