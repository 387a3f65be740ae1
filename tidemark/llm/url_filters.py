"""URL filters: dated list entries become validity intervals, an as-of join asks which were active at a capture's fetch time.

Events: ``list_id, kind, pattern, verdict, action, at``. ``kind`` is ``domain`` (the pattern and all its subdomains) or ``prefix`` (host
and path begin with the pattern, wherever that ends); ``verdict`` is ``block`` or ``allow``; ``action`` is ``add`` or ``remove``. An entry is
active from an ``add`` (inclusive) to the next ``remove`` (exclusive); repeated adds or removes change nothing, of events at one
instant an ``add`` counts. Events with a null in any of pattern, verdict, action or time are left out.

Captures: ``capture_id, url, fetched_at``. Of the entries active at ``fetched_at`` the most specific decides: prefixes before domains,
longer patterns before shorter; then ``allow`` before ``block``, then the first list, then the latest listing. No entry: verdict ``none``.
Null or malformed urls and null times meet no entry; a host may be of any length. Rows that repeat are answered once. Empty tables
give empty results, an empty list gives ``none`` for all; extra columns are not read.

Intervals and captures meet on pattern and time bucket, so a pattern that a third of all captures share, or one with a long
history, is spread over as many keys as there are buckets; a list counted as small is broadcast instead of shuffled. A capture
asks only for suffixes of as many labels, and prefixes of as many characters, as some entry has; that there may be no entry is
no key of the join but a row beside it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.graph import stored
from tidemark.llm.shingles import bounded

BUCKET_DAYS = 30


def host(url: Column) -> Column:
    """Lower-cased host without user, port or final dot; empty if there is none."""
    found = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]*)", 1))
    return F.regexp_replace(found, r"\.$", "")


def path(url: Column) -> Column:
    """Path without query and fragment, from its first slash."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*(/[^?#]*)?", 1)
    return F.when(found == "", F.lit("/")).otherwise(found)


def intervals(events: DataFrame) -> DataFrame:
    """``list_id, kind, pattern, verdict, valid_from, valid_to``: when each entry was active; an open end is null."""
    entry = ["list_id", "kind", "pattern", "verdict"]
    clean = events.select(
        "list_id", "kind", F.lower(F.regexp_extract("pattern", "^[^/]*", 0)).alias("head"), F.regexp_extract("pattern", "^[^/]*(.*)$", 1).alias("tail"),
        "verdict", "action", F.col("at").cast("timestamp").alias("at"),
    ).where("head <> '' and verdict is not null and action in ('add', 'remove') and at is not null and kind in ('domain', 'prefix')")
    # one state for each entry and instant, reduced before the shuffle: an entry's history is as long as its instants
    states = clean.withColumn("pattern", F.concat("head", "tail")).groupBy(*entry, "at").agg(F.max((F.col("action") == "add").cast("int")).alias("on"))
    history = Window.partitionBy(*entry).orderBy("at")
    changes = states.withColumn("was", F.coalesce(F.lag("on").over(history), F.lit(0))).where("on <> was")
    return changes.withColumn("valid_to", F.lead("at").over(history)).where("on = 1").select(*entry, F.col("at").alias("valid_from"), "valid_to")


def _bucket(at: Column, days: int) -> Column:
    return F.floor(F.unix_seconds(at) / (86400 * days))


def _keys(labels: list[int], lengths: list[int]) -> Column:
    """The patterns that may hold a capture: suffixes of its host and prefixes of its host and path, of the list's sizes."""
    parts, whole = F.split("host", r"\."), F.concat("host", "path")

    def fitting(sizes: list[int], most: Column) -> Column:
        return F.filter(F.array(*[F.lit(n) for n in sizes]).cast("array<int>"), lambda n: n <= most)

    def key(kind: str, pattern: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), pattern.alias("pattern"))

    suffixes = F.transform(fitting(labels, F.size(parts)), lambda n: key("domain", F.array_join(F.slice(parts, -n, n), ".")))
    prefixes = F.transform(fitting(lengths, F.char_length(whole)), lambda n: key("prefix", F.substring(whole, F.lit(1), n)))
    return F.concat(suffixes, prefixes)


def decide(captures: DataFrame, events: DataFrame, bucket_days: int = BUCKET_DAYS) -> DataFrame:
    """``capture_id, url, fetched_at, host, verdict, list_id, kind, pattern, valid_from`` of every distinct capture."""
    own = captures.select("capture_id", "url", "fetched_at", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"), F.col("fetched_at").cast("timestamp").alias("at"))
    first, last = own.agg(F.min("at"), F.max("at")).select(_bucket(F.col("min(at)"), bucket_days), _bucket(F.col("max(at)"), bucket_days)).first()
    active = intervals(events)
    covered = F.sequence(
        F.greatest(_bucket(F.col("valid_from"), bucket_days), F.lit(first or 0)),
        F.least(F.coalesce(_bucket(F.col("valid_to"), bucket_days), F.lit(last or 0)), F.lit(last or 0)),
    )
    begins = _bucket(F.col("valid_from"), bucket_days) <= F.lit(last or 0)
    lasts = F.coalesce(_bucket(F.col("valid_to"), bucket_days), F.lit(last or 0)) >= F.lit(first or 0)
    listed = stored(active.where(begins & lasts).withColumn("bucket", F.explode(covered)), "list-intervals")
    rows, labels, lengths = listed.agg(
        F.count("*"),
        F.array_sort(F.collect_set(F.when(F.col("kind") == "domain", F.size(F.split("pattern", r"\."))))),  # as many as the longest pattern has
        F.array_sort(F.collect_set(F.when(F.col("kind") == "prefix", F.char_length("pattern")))),
    ).first()
    capture = ["capture_id", "url", "fetched_at", "host"]
    keyed = own.where("host <> '' and at is not null").select(*capture, "at", _bucket(F.col("at"), bucket_days).alias("bucket"), F.explode(_keys(labels, lengths)).alias("key"))
    asked = keyed.select(*capture, "at", "bucket", "key.kind", "key.pattern")
    a, e = asked.alias("a"), bounded(listed, rows).alias("e")
    on = (F.col("a.kind") == F.col("e.kind")) & (F.col("a.pattern") == F.col("e.pattern")) & (F.col("a.bucket") == F.col("e.bucket"))
    on &= (F.col("a.at") >= F.col("e.valid_from")) & (F.col("e.valid_to").isNull() | (F.col("a.at") < F.col("e.valid_to")))
    # the least struct decides
    order = F.struct(
        F.lit(False).alias("missing"), (F.col("e.kind") == "domain").alias("domain"), (-F.char_length("e.pattern")).alias("length"), F.col("e.verdict").alias("verdict"),
        F.col("e.list_id").alias("list_id"), (-F.unix_micros("e.valid_from")).alias("age"), F.col("e.kind").alias("kind"), F.col("e.pattern").alias("pattern"), F.col("e.valid_from").alias("valid_from"),
    )
    met = a.join(e, on).select(*[F.col(f"a.{c}") for c in capture], order.alias("b"))
    none = [F.lit(True).alias("missing"), *[F.lit(None).cast(f.dataType).alias(f.name) for f in met.schema["b"].dataType.fields[1:]]]
    best = met.unionByName(own.select(*capture, F.struct(*none).alias("b"))).groupBy(*capture).agg(F.min("b").alias("b"))
    return best.select("capture_id", "url", "fetched_at", "host", F.coalesce("b.verdict", F.lit("none")).alias("verdict"), "b.list_id", "b.kind", "b.pattern", "b.valid_from")
