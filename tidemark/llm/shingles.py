"""Word shingles as DataFrame expressions, and joins that broadcast only what has been counted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

#: rows of two or three longs or short strings that may be broadcast, about 30 MB at most
BROADCAST_ROWS = 200_000


def words(text: str = "text") -> Column:
    """Lower-cased runs of letters, marks and numerals; null has none."""
    return F.regexp_extract_all(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit(r"[\p{L}\p{M}\p{N}]+"), F.lit(0))


def bounded(df: DataFrame, rows: int) -> DataFrame:
    """``df`` to be broadcast if it was counted at ``BROADCAST_ROWS`` rows or fewer; else it is left to a shuffled join."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def text_key(text: str = "text") -> Column:
    """Tells the rows of one ``doc_id`` apart; zero for a null text."""
    return F.coalesce(F.xxhash64(F.col(text)), F.lit(0).cast("long"))


def whole_id(docs: DataFrame) -> Column:
    """``doc_id`` as a long; ids of another kind are refused, as their order and names would change in a cast."""
    kind = docs.schema["doc_id"].dataType
    if not isinstance(kind, IntegralType):
        raise ValueError(f"doc_id must be a whole number, not {kind.simpleString()}")
    return F.col("doc_id").cast("long").alias("doc_id")
