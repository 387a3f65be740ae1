"""Benchmark decontamination: containment search with size-partitioned MinHash sketches, verified by exact shingles.

Which documents contain ``THRESHOLD`` or more of the word shingles of a benchmark item? Items are short and documents long,
so the sketch is taken of the item and the document is streamed against it. Items are partitioned by size (classes of doubling
shingle counts); the sketch of an item in a class of up to ``u`` shingles is its ``floor((1 - THRESHOLD) * u) + 1`` smallest
shingle hashes (a bottom-k MinHash). A document that contains enough of an item misses fewer shingles than the sketch has, so it
holds at least one hash of the sketch: the search loses nothing. Each pair it finds is then verified by counting the
item's distinct shingles in the document, compared word by word, not by hash.

Shingles take ``WORDS`` words; an item of fewer is one shingle of its own length, which documents are asked for in that
length too. Words are lower-cased runs of letters, marks and numerals. Null and empty texts have no words: such items are in
no document, such documents contain nothing. Rows of one ``doc_id`` and one text are one document, rows of one ``doc_id`` with
different texts are judged apart; repeated ``item_id`` with different texts too. Null ids are ids. Empty tables give empty
results, extra columns are not read.

Texts never cross the network: both passes explode them where they are read, and only matches are shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.batches import free
from tidemark.llm.graph import stored
from tidemark.llm.shingles import bounded, text_key, words

WORDS = 5
THRESHOLD = 0.8


def _shingles(rows: DataFrame, lengths: list[int], *keys: str) -> DataFrame:
    """``keys, length, shingle`` (an array of words) for every place in ``rows.words``, repeats included."""
    per_length = F.explode(F.array(*[F.lit(k) for k in lengths])).alias("length")
    wide = rows.select(*keys, "words", per_length).where(F.size("words") >= F.col("length"))
    placed = wide.select(*keys, "words", "length", F.explode(F.sequence(F.lit(1), F.size("words") - F.col("length") + 1)).alias("at"))
    return placed.select(*keys, "length", F.slice("words", F.col("at"), F.col("length")).alias("shingle"))


def item_shingles(items: DataFrame, size: int = WORDS) -> DataFrame:
    """``item_id, item_key, length, shingle, hash, n_shingles, rank`` for each distinct shingle; ``rank`` by hash from 1."""
    own = items.select(F.col("item_id"), text_key().alias("item_key"), words().alias("words")).where(F.size("words") > 0)
    own = own.withColumn("length", F.least(F.size("words"), F.lit(size)))
    places = own.select("item_id", "item_key", "length", "words", F.explode(F.sequence(F.lit(1), F.size("words") - F.col("length") + 1)).alias("at"))
    found = places.select("item_id", "item_key", "length", F.slice("words", F.col("at"), F.col("length")).alias("shingle")).distinct()
    item = Window.partitionBy("item_id", "item_key")
    return found.withColumn("hash", F.xxhash64("shingle")).withColumns({
        "n_shingles": F.count("*").over(item),
        "rank": F.row_number().over(item.orderBy("hash", "shingle")),
    })


def sketches(shingled: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of each item's sketch: as many as its size class asks for."""
    largest = F.pow(F.lit(2.0), F.floor(F.log2("n_shingles")) + 1) - 1
    return shingled.where(F.col("rank") <= F.floor((1 - F.lit(threshold)) * largest + 1e-9) + 1)


def find(docs: DataFrame, items: DataFrame, size: int = WORDS, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, text_hash, item_id, n_shingles, n_found, containment`` of each pair at or above ``threshold``."""
    shingled = stored(item_shingles(items, size), "item-shingles")
    n_all, lengths = shingled.agg(F.count("*"), F.sort_array(F.collect_set("length"))).first()
    sketch = sketches(shingled, threshold).select("item_id", "item_key", "length", "hash", "n_shingles")
    own = docs.select("doc_id", text_key().alias("text_hash"), words().alias("words"))
    streamed = _shingles(own, lengths or [size], "doc_id", "text_hash").withColumn("hash", F.xxhash64("shingle"))

    pair = ["doc_id", "text_hash", "item_id", "item_key"]
    probed = streamed.drop("shingle").join(bounded(sketch, n_all), ["length", "hash"]).select(*pair).distinct()
    candidates = stored(probed, "containment-candidates")
    asked, named = candidates.select("doc_id", "text_hash").distinct(), candidates.count()
    same = lambda a, b: F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & (F.col(f"{a}.text_hash") == F.col(f"{b}.text_hash"))
    suspects = own.alias("d").join(bounded(asked, named).alias("a"), same("d", "a"), "left_semi")
    whole = shingled.select("item_id", "item_key", "length", "hash", "n_shingles", F.col("shingle").alias("wanted"))
    suspected = _shingles(suspects, lengths or [size], "doc_id", "text_hash").withColumn("hash", F.xxhash64("shingle"))
    matched = suspected.join(bounded(whole, n_all), ["length", "hash"]).where(F.col("shingle") == F.col("wanted"))
    counted = matched.groupBy(*pair, "n_shingles", "hash", "shingle").agg(F.lit(1).alias("one")).groupBy(*pair, "n_shingles").agg(F.count("*").alias("n_found"))
    item = F.col("m.item_id").eqNullSafe(F.col("c.item_id")) & (F.col("m.item_key") == F.col("c.item_key"))
    verified = counted.alias("m").join(candidates.alias("c"), same("m", "c") & item, "left_semi")
    return verified.where(F.col("n_found") >= F.lit(threshold) * F.col("n_shingles") - 1e-9).select(
        "doc_id", "text_hash", "item_id", "n_shingles", "n_found", (F.col("n_found") / F.col("n_shingles")).alias("containment")
    )


def remove(docs: DataFrame, items: DataFrame, size: int = WORDS, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without those that contain an item, with all its columns, whatever they are named."""
    id_key, text_hash = free("id_key_", docs.columns), free("text_hash_", docs.columns)
    key = {id_key: F.coalesce(F.col("doc_id").cast("string"), F.lit("none")), text_hash: text_key()}
    leaks = find(docs, items, size, threshold).select(key[id_key].alias(id_key), F.col("text_hash").alias(text_hash)).distinct()
    leaks = stored(leaks, "leaks")
    return docs.withColumns(key).join(bounded(leaks, leaks.count()), [*key], "left_anti").drop(*key)
