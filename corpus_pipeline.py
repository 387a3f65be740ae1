"""From raw documents to token ids: five stages, each over all that the one before it kept.

A stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as Parquet and read again as the next one's
``docs``. All but the last return the columns of ``documents``, extra ones too, whatever they are named. A stage's own intermediate tables,
and the one before it, go once it is written.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, decontaminate, langid, secrets, simhash
from tidemark.llm.graph import forget, stored, temporary
from tidemark.llm.queries import vocabulary_path

#: language ID and BPE are no SQL; tests hold each stage against a brute-force version
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the documents' own labels; texts without a letter or under the calibrated score go, missing labels are filled in."""
    rows = docs.select("text", F.struct("*").alias("row"))  # apart from the columns that a prediction adds
    told = langid.predict(rows, langid.learn(docs)).where("accepted")
    of = lambda c: F.col(f"row.`{c}`")
    return told.select(*[F.coalesce(of(c), "lang_pred").alias(c) if c == "lang" else of(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays, that of the smallest id."""
    return simhash.keep_one(docs)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontaminate.remove(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets_masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; secrets in it are masked, and ``n_chars`` follows."""
    masked = secrets.redact(docs)
    return masked.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else masked


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the digest of what they decode to."""
    path = vocabulary_path()
    coded = bpe.encode_decode(docs.select("doc_id", "lang", "source", "text"), path)
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language),
    ("simhash_dedup", near_duplicates),
    ("decontaminate", benchmark_free),
    ("secret_scan", secrets_masked),
    ("bpe", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        with temporary() as scope:
            out = scope.keep(stored(stage(spark, docs, sf_dir), f"stage-{name}"))
        if i:
            forget(docs)
        docs = out
    return docs
