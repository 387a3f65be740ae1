"""BPE encoding and decoding with a vocabulary file of the tokenizers format (word pieces with an end-of-word mark).

A text is normalised (NFC, lower case), cut into words, which leaves white space out, and each word is cut again wherever two
neighbouring symbols never stand side by side inside any token: no merge can cross such a place, so the fragments are
encoded alone and their ids put one after the other. Words recur, so each worker keeps a bounded memory of those it has
encoded: four bytes an id, as a worker keeps it while it waits for its next task, whatever that is.

Null text: no ids. Empty text: no ids; no ids decode to an empty text. Repeated rows give repeated rows. Other columns
pass through under their own names, so ``ids`` (and ``decoded``) must be free. A text is held whole in its task,
nothing else is. Letters and numerals are those of the ``regex`` module's Unicode version; the tokenizers library is one
version behind, which shows only in characters that entered Unicode with version 17.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.llm.batches import SLICE_BYTES, mapped, slices

END = "</w>"
REMEMBERED = 200_000
SHORT = 48
NONE = 1 << 62
SPACES = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: contractions, runs of letters, single numerals, runs of the rest
WORD = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{SPACES}\p{{L}}\p{{N}}]+")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself where printable in Latin-1, else the next from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = (chr(256 + i) for i in range(256))
    return [chr(b) if b in shown else next(others) for b in range(256)]


class Encoder:
    """A vocabulary, the symbol pairs its tokens hold, and a bounded memory of encoded words."""

    def __init__(self, file: str):
        spec = json.loads(file)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        symbols = byte_symbols()
        self.inner = [vocab[s] for s in symbols]
        self.last = [vocab[s + END] for s in symbols]
        self.merges = {}
        for rank, (a, b) in enumerate(model["merges"]):
            self.merges[vocab[a] << 20 | vocab[b]] = rank << 20 | vocab[a + b]
        # byte a followed by b inside some token: a << 9 | b; by b at the end of a word: a << 9 | b + 256
        self.pairs: set[int] = set()
        byte_of = {s: b for b, s in enumerate(symbols)}
        for token in vocab:
            ends = token.endswith(END) and token != END
            try:
                own = [byte_of[c] for c in (token[: -len(END)] if ends else token)]
            except KeyError:  # no sequence of bytes, so no merge makes it
                continue
            for k, (a, b) in enumerate(zip(own, own[1:]), 2):
                self.pairs.add(a << 9 | b + 256 * (ends and k == len(own)))
        self.split = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def cuts(self, word: bytes) -> list[int]:
        """Places in the word that no token spans."""
        pairs, last = self.pairs, len(word) - 1
        return [i for i, (a, b) in enumerate(zip(word, word[1:]), 1) if (a << 9 | b + 256 * (i == last)) not in pairs]

    def fragment(self, part: bytes, ends: bool) -> list[int]:
        """Merges by rank, the leftmost first."""
        ids = [self.inner[b] for b in part]
        if ends:
            ids[-1] = self.last[part[-1]]
        if len(ids) > SHORT:
            return self.long_fragment(ids)
        merges = self.merges
        ranks = [merges.get(a << 20 | b, NONE) for a, b in zip(ids, ids[1:])]
        while ranks and (best := min(ranks)) < NONE:
            i = ranks.index(best)
            ids[i : i + 2] = (new := best & 0xFFFFF,)
            del ranks[i]
            if i:
                ranks[i - 1] = merges.get(ids[i - 1] << 20 | new, NONE)
            if i < len(ranks):
                ranks[i] = merges.get(new << 20 | ids[i + 1], NONE)
        return ids

    def long_fragment(self, ids: list[int]) -> list[int]:
        """The same with a heap over a linked list: n log n for any length."""
        n, merges = len(ids), self.merges
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = [(m, i, ids[i], ids[i + 1]) for i in range(n - 1) if (m := merges.get(ids[i] << 20 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            m, i, left, right = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j < 0 or ids[j] != right:
                continue
            new = m & 0xFFFFF
            ids[i], ids[j] = new, -1
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
                if (m := merges.get(new << 20 | ids[k])) is not None:
                    heapq.heappush(heap, (m, i, new, ids[k]))
            h = before[i]
            if h >= 0 and (m := merges.get(ids[h] << 20 | new)) is not None:
                heapq.heappush(heap, (m, h, ids[h], new))
        return [i for i in ids if i >= 0]

    def word(self, word: str) -> bytes:
        """Its ids as ``packed`` has them, remembered in two generations: the older one goes when the newer is full."""
        ids = self.older.get(word)
        if ids is None:
            own = word.encode()
            places = [0, *self.cuts(own), len(own)]
            ids = array("i", chain.from_iterable([self.fragment(own[a:b], b == len(own)) for a, b in zip(places, places[1:])])).tobytes()
        if len(word) <= 64:
            if len(self.words) >= REMEMBERED:
                self.older = dict(self.words)
                self.words.clear()
            self.words[word] = ids
        return ids

    def encode(self, text: str) -> list[int]:
        return self.packed(text).tolist()

    def packed(self, text: str) -> np.ndarray:
        """The ids of ``text``, each in four bytes."""
        if self.split and "<" in text:
            parts = self.split.split(text)
        else:
            parts = [text]
        out: list[bytes] = []
        known = self.words
        for k, part in enumerate(parts):
            if k % 2:
                out.append(array("i", [self.special[part]]).tobytes())
                continue
            part = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
            out += [known.get(w) or self.word(w) for w in WORD.findall(part)]
        return np.frombuffer(b"".join(out), dtype=np.int32)


@lru_cache(maxsize=1)
def encoder(file: str) -> Encoder:
    """One per worker process."""
    return Encoder(file)


@lru_cache(maxsize=1)
def tokens(file: str) -> list[str | None]:
    """The string of each id, null for ids that stand for nothing; all that decoding needs."""
    spec = json.loads(file)
    named = {**{i: t for t, i in spec["model"]["vocab"].items()}, **{x["id"]: x["content"] for x in spec["added_tokens"]}}
    return [named.get(i) for i in range(max(named) + 1)]


def spell(ids: list[int], known: list[str | None]) -> str:
    """The text of ``ids``: without a decoder in the vocabulary file, tokens with a blank between."""
    return " ".join([known[i] for i in ids])


def read_vocabulary(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def id_lists(found: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, found)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*found, np.zeros(0, np.int32)])))


def with_field(df: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([*df.schema.fields, T.StructField(name, kind)])


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the ids of ``text``. The vocabulary (``path``, read by the driver) is broadcast: 1.7 MB, whatever the corpus."""
    shared = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(shared.value)
        for batch in slices(batches, text):
            column = id_lists([own.packed(x or "") for x in batch.column(text).to_pylist()])
            yield pa.RecordBatch.from_arrays([*batch.columns, column], [*batch.schema.names, ids])

    return mapped(docs, run, with_field(docs, ids, T.ArrayType(T.IntegerType())))


def decode(df: DataFrame, path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``df`` with the text that ``ids`` stand for; special tokens show, unknown ids raise."""
    shared = df.sparkSession.sparkContext.broadcast(read_vocabulary(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = tokens(shared.value)
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                texts = [spell(x.values.to_numpy(zero_copy_only=False).tolist(), known) if x.is_valid else None for x in part.column(part.schema.get_field_index(ids))]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], [*part.schema.names, decoded])

    return mapped(df, run, with_field(df, decoded, T.StringType()))


def encode_decode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``docs`` with ``ids`` and the text they decode to in the place of ``text``: both steps in one worker, which holds one vocabulary."""
    shared = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, known = encoder(shared.value), tokens(shared.value)
        for batch in slices(batches, text, SLICE_BYTES // 4):
            found = [own.packed(x or "") for x in batch.column(text).to_pylist()]
            texts = pa.array([spell(x.tolist(), known) for x in found], pa.string())
            rest = [i for i, name in enumerate(batch.schema.names) if name != text]
            columns = [*(batch.column(i) for i in rest), id_lists(found), texts]
            yield pa.RecordBatch.from_arrays(columns, [*(batch.schema.names[i] for i in rest), ids, decoded])

    fields = [f for f in docs.schema.fields if f.name != text]
    return mapped(docs, run, T.StructType([*fields, T.StructField(ids, T.ArrayType(T.IntegerType())), T.StructField(decoded, T.StringType())]))
