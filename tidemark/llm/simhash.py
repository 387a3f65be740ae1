"""SimHash near-duplicates by multi-index hashing.

A fingerprint has 64 bits: a bit is 1 if it is set in over half of the XXH64 hashes (seed 42) of the text's word shingles,
repeats included. Two fingerprints link if they differ in ``MAX_BITS`` bits or fewer. Of two halves of 32 bits one then
differs in one bit at most, so each distinct fingerprint looks up the 33 values of the Hamming ball of radius 1 around each
of its halves among the halves of all others, and the complete distance is checked on every match. Rows of the look-up grow
with the number of fingerprints, and a half of 32 bits keeps the lists short. A half that more than ``CROWD`` fingerprints share
has its list indexed in the same way again: of the two quarters of their other half one differs in one bit at most, so the 17
values around each quarter are looked up inside the list.

Null and empty texts have no word and so fingerprint zero, linked like any other. Texts of fewer words than a shingle are one
shingle. Equal fingerprints (copies) are one node, so the size of a group of copies costs nothing; rows that repeat get the
same answer. A null ``doc_id`` never is a component's name unless nothing else is in it; ids are whole numbers, others are refused.
Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.batches import free, mapped, slices
from tidemark.llm.graph import components, forget, stored, temporary
from tidemark.llm.shingles import bounded, whole_id

SHINGLE_WORDS = 3
MAX_BITS = 3
HALF, QUARTER = 32, 16
SEED = 42
CROWD = 256  # fingerprints with one half in common, beyond which the other half is looked up as well


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """The unsigned fingerprint of one text."""
    tokens = (text or "").encode().lower().split()  # bytes: A-Z alone change, and the six ASCII white spaces part words
    if not tokens:
        return 0
    n = max(1, len(tokens) - words + 1)
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, n, 1 << 15):
        part = tokens[start : start + (1 << 15) + words - 1] if len(tokens) > words else tokens
        shingles = [b" ".join(tokens)] if n == 1 else map(b" ".join, zip(*(part[k:] for k in range(words))))
        hashes = np.array([xxhash.xxh64_intdigest(s, SEED) for s in shingles], dtype=">u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id, text_hash, fingerprint`` (signed long) of every row; ``text_hash`` tells rows of one id apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = np.array([fingerprint(t, words) for t in batch.column("text").to_pylist()], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), pa.array(found)], ["doc_id", "text_hash", "fingerprint"])

    rows = docs.select(whole_id(docs), F.xxhash64("text").alias("text_hash"), "text")
    return mapped(rows, run, "doc_id long, text_hash long, fingerprint long")


def _half(name: str, segment: int) -> Column:
    return F.shiftrightunsigned(F.col(name), HALF) if segment == 0 else F.col(name).bitwiseAND(F.lit((1 << HALF) - 1))


def _halves(prints: DataFrame, ball: bool) -> DataFrame:
    """A row for each half of each fingerprint, or for each value within one bit of it."""
    flips = F.array(F.lit(0).cast("long"), *[F.lit(1 << b).cast("long") for b in range(HALF)])
    pairs = F.array(*[F.struct(F.lit(s).alias("segment"), _half("fingerprint", s).alias("value")) for s in (0, 1)])
    rows = prints.select("fingerprint", F.explode(pairs).alias("half")).select("fingerprint", "half.segment", "half.value")
    if not ball:
        return rows
    near = rows.select("fingerprint", "segment", "value", F.explode(flips).alias("flip"))
    return near.select("fingerprint", "segment", F.col("value").bitwiseXOR(F.col("flip")).alias("value"))


def links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``u, v``: pairs of distinct fingerprints (``prints.fingerprint``) that differ in ``max_bits`` bits or fewer, each once.

    Exact up to three bits: one half is then within the ball of radius 1.
    """
    if not 0 <= max_bits <= 3:
        raise ValueError("two halves with balls of one bit find up to three differing bits")
    found = candidates(prints).where(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= max_bits)
    first = F.bit_count(_half("u", 0).bitwiseXOR(_half("v", 0)))
    second = F.bit_count(_quarter("u", 0).bitwiseXOR(_quarter("v", 0)))
    once = ((F.col("segment") == 0) | (first > 1)) & (F.col("quarter").isNull() | (F.col("quarter") == 0) | (second > 1))
    return found.where(once).select("u", "v")


def _quarter(name: str, quarter: int) -> Column:
    """A quarter of the half that is not ``segment``."""
    other = F.when(F.col("segment") == 0, _half(name, 1)).otherwise(_half(name, 0))
    return F.shiftrightunsigned(other, QUARTER) if quarter == 0 else other.bitwiseAND(F.lit((1 << QUARTER) - 1))


def _quarters(rows: DataFrame, name: str, ball: bool) -> DataFrame:
    """``rows`` once for each quarter of the other half of ``name``, or for each value within one bit of it."""
    flips = F.array(F.lit(0).cast("long"), *[F.lit(1 << b).cast("long") for b in range(QUARTER)])
    both = F.array(*[F.struct(F.lit(q).alias("quarter"), _quarter(name, q).alias("inner")) for q in (0, 1)])
    out = rows.withColumn("both", F.explode(both)).select(name, "segment", "value", "both.quarter", "both.inner")
    if not ball:
        return out
    near = out.withColumn("flip", F.explode(flips))
    return near.select(name, "segment", "value", "quarter", F.col("inner").bitwiseXOR(F.col("flip")).alias("inner"))


def candidates(prints: DataFrame) -> DataFrame:
    """``u, v, segment, quarter`` with ``u > v``: pairs within one bit in a half and, in crowded lists, in a quarter of the other one."""
    asked = _halves(prints, ball=True).withColumnRenamed("fingerprint", "u")
    index = _halves(prints, ball=False).withColumnRenamed("fingerprint", "v")
    listed = ["segment", "value"]
    crowds = stored(index.groupBy(*listed).agg(F.count("*").alias("n")).where(F.col("n") > CROWD).select(*listed), "crowded-halves")
    n = crowds.count()
    plain = (asked, index) if not n else [x.join(bounded(crowds, n), listed, "left_anti") for x in (asked, index)]
    smaller = F.col("u") > F.col("v")
    found = plain[0].join(plain[1], listed).where(smaller).select("u", "v", "segment", F.lit(None).cast("int").alias("quarter"))
    if not n:
        return found
    inside = [x.join(bounded(crowds, n), listed, "left_semi") for x in (asked, index)]
    deeper = _quarters(inside[0], "u", True).join(_quarters(inside[1], "v", False), [*listed, "quarter", "inner"])
    return found.unionByName(deeper.where(smaller).select("u", "v", "segment", "quarter"))


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``doc_id, text_hash, fingerprint, component_id`` of every row; ``component_id`` is the smallest id reachable by links."""
    prints = stored(fingerprints(docs, words), "fingerprints")
    nodes = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id"))
    with temporary() as scope:
        edges = scope.keep(stored(links(nodes.select("fingerprint"), max_bits), "links"))
    roots = components(edges)
    forget(edges)
    named = nodes.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    ids = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return prints.join(named.join(ids, "root").select("fingerprint", "component_id", "root"), "fingerprint").select(
        "doc_id", "text_hash", "fingerprint", "component_id", "root"
    )


def representatives(found: DataFrame) -> DataFrame:
    """``doc_id, text_hash`` of the one document that stays of each component: the smallest id, of equal ids the smallest hash."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash")).alias("first")
    return found.groupBy("root").agg(first).select("first.doc_id", "first.text_hash")


def keep_one(docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each component, its columns as they are; repeats of that row go in the same shuffle."""
    id_key, text_hash = free("id_key_", docs.columns), free("text_hash_", docs.columns)
    key = {id_key: F.coalesce(F.col("doc_id").cast("string"), F.lit("none")), text_hash: F.xxhash64("text")}
    kept = representatives(near_duplicates(docs, words, max_bits)).select(key[id_key].alias(id_key), F.col("text_hash").alias(text_hash))
    return docs.withColumns(key).join(kept, [*key], "left_semi").dropDuplicates([*key]).drop(*key)
