"""Secret scans with a trigram inverted index.

Each rule is a regular expression. From its parse tree follow strings of which any match must hold one; they give a Boolean
query of trigrams: all clauses, of each clause one alternative, of each alternative every trigram. The index has a posting
(trigram, document) for each trigram of the queries' vocabulary that a lower-cased text holds. Postings of an alternative are
intersected, alternatives united, clauses intersected; the documents that are left are the rule's candidates, and the rule's
expression runs on those alone. A rule without a mandatory trigram runs on all documents.

Matches of a kind are leftmost and do not overlap; those that fail the rule's least length are then dropped. Spans count code
points, ends are exclusive.

Null and empty texts have no spans. Rows of one ``doc_id`` and one text give the same spans; rows of one ``doc_id`` with
different texts are told apart; null ids are ids. Empty tables give empty results, extra columns are not read. A document with
any number of matches is a number of rows, never one long value, until its digest.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass
from re import _constants as sre
from re import _parser as sre_parser

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.batches import free
from tidemark.llm.graph import stored
from tidemark.llm.shingles import bounded, text_key

MOST_STRINGS = 64


@dataclass(frozen=True)
class Rule:
    """``measured`` is the group whose length must be ``least`` or more; ``strict`` the expression of matches that pass it,
    if that is not ``pattern`` itself."""

    kind: str
    pattern: str
    measured: int
    least: int
    strict: str = ""


#: The base rules
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{6,}"""),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20, r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),  # the maximal runs of 24 or more among all runs
)
#: Further rules, by the public formats of these credentials
MORE = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 15),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 30),
)
RULES = BASE + MORE

#: of one alternative: its trigrams; of a clause: its alternatives; of a query: its clauses
Query = tuple[frozenset[frozenset[str]], ...]


def _clause(strings: set[str]) -> Query:
    """What texts that hold one of ``strings`` must hold; nothing if one has no trigram."""
    if not strings or any(len(s) < 3 for s in strings):
        return ()
    found = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings}
    return (frozenset(a for a in found if not any(b < a for b in found)),)  # an alternative that asks for more adds nothing


def _strings(op, arg) -> set[str] | None:
    """All lower-cased strings a node matches, if few."""
    if op is sre.LITERAL:
        return {chr(arg).lower()}
    if op is sre.IN and all(o is sre.LITERAL for o, _ in arg) and len(arg) <= 8:
        return {chr(a).lower() for _, a in arg}
    if op is sre.SUBPATTERN:
        return _all_strings(arg[-1])
    if op is sre.BRANCH:
        found = [_all_strings(x) for x in arg[1]]
        return set().union(*found) if all(f is not None for f in found) else None
    if op is sre.MAX_REPEAT and arg[1] <= 3:
        inner = _all_strings(arg[2])
        if inner is not None:
            out = {"".join(x) for n in range(arg[0], arg[1] + 1) for x in itertools.product(inner, repeat=n)}
            return out if len(out) <= MOST_STRINGS else None
    return None


def _all_strings(nodes) -> set[str] | None:
    out = {""}
    for op, arg in nodes:
        own = _strings(op, arg)
        if own is None or len(out) * len(own) > MOST_STRINGS:
            return None
        out = {a + b for a in out for b in own}
    return out


def _query(nodes) -> Query:
    clauses: list = []
    run = {""}
    for op, arg in nodes:
        own = _strings(op, arg)
        if own is not None and len(run) * len(own) <= MOST_STRINGS:
            run = {a + b for a in run for b in own}
            continue
        clauses += _clause(run)
        run = own or {""}
        if own is None and op is sre.SUBPATTERN:
            clauses += _query(arg[-1])
        elif own is None and op is sre.MAX_REPEAT and arg[0] > 0:
            clauses += _query(arg[2])
    return (*clauses, *_clause(run))


def trigram_query(pattern: str) -> Query:
    """The Boolean query of a regular expression; empty if no trigram is mandatory."""
    return tuple(dict.fromkeys(_query(sre_parser.parse(pattern))))


def vocabulary(queries: dict[str, Query]) -> list[str]:
    return sorted({t for q in queries.values() for clause in q for alternative in clause for t in alternative})


def postings(docs: DataFrame, trigrams: list[str], text: str = "text") -> DataFrame:
    """The index: ``trigram, doc_id, text_hash`` for each of ``trigrams`` that a lower-cased text holds."""
    low = docs.select("doc_id", text_key(text).alias("text_hash"), F.lower(text).alias("low"))
    held = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in trigrams]))
    return low.select("doc_id", "text_hash", F.explode(held).alias("trigram"))


def candidates(index: DataFrame, queries: dict[str, Query]) -> DataFrame:
    """``doc_id, text_hash, kinds``: for which rules a document of the index is a candidate."""
    spark = index.sparkSession
    asked = [
        (t, kind, c, a, len(alternative))
        for kind, q in queries.items() for c, clause in enumerate(q) for a, alternative in enumerate(sorted(map(sorted, clause))) for t in alternative
    ]
    plan = spark.createDataFrame(asked, "trigram string, kind string, clause int, alternative int, wanted long")
    doc = ["doc_id", "text_hash"]
    hits = index.distinct().join(F.broadcast(plan), "trigram")  # a row for each trigram of a rule
    whole = hits.groupBy(*doc, "kind", "clause", "alternative", "wanted").agg(F.count("*").alias("held")).where("held = wanted")
    clauses = whole.select(*doc, "kind", "clause").distinct().groupBy(*doc, "kind").agg(F.count("*").alias("met"))
    needed = F.create_map(*[x for kind, q in queries.items() for x in (F.lit(kind), F.lit(len(q)))])
    return clauses.where(F.col("met") == needed[F.col("kind")]).groupBy(*doc).agg(F.collect_set("kind").alias("kinds"))


def _found(rule: Rule, order: int) -> Column:
    """An array of the lengths of what lies before each match, of the match, and of its measured group; null if none."""
    pattern = F.lit(rule.pattern)
    matches = F.regexp_extract_all("text", pattern, F.lit(0))
    before = F.transform(F.split("text", rule.pattern, -1), F.char_length)
    measured = F.regexp_extract_all("text", pattern, F.lit(rule.measured))
    rows = F.arrays_zip(
        F.slice(before, 1, F.size(matches)).alias("before"), F.transform(matches, F.char_length).alias("matched"), F.transform(measured, F.char_length).alias("measured")
    )
    return F.when(F.regexp_like("text", pattern), rows)


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``doc_id, text_hash, kind, start, end`` of every span in every document."""
    queries = {r.kind: q for r in rules if (q := trigram_query(r.pattern))}
    chosen = _candidates(docs, queries)
    own = docs.select("doc_id", text_key().alias("text_hash"), "text").alias("d")
    same = F.col("d.doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col("d.text_hash") == F.col("c.text_hash"))
    told = own.join(chosen.alias("c"), same, "left").select("d.doc_id", "d.text_hash", "d.text", F.coalesce("c.kinds", F.array().cast("array<string>")).alias("kinds"))
    each = F.array(*[
        F.struct(F.lit(r.kind).alias("kind"), F.lit(r.least).alias("least"), (F.when(F.array_contains("kinds", r.kind), _found(r, i)) if r.kind in queries else _found(r, i)).alias("rows"))
        for i, r in enumerate(rules)
    ])
    by_rule = told.select("doc_id", "text_hash", F.explode(each).alias("r")).where(F.size("r.rows") > 0)
    rows = by_rule.select("doc_id", "text_hash", "r.kind", "r.least", F.posexplode("r.rows").alias("at", "m"))
    matches = rows.select("doc_id", "text_hash", "kind", "least", "at", "m.before", "m.matched", "m.measured").distinct()
    upto = Window.partitionBy("doc_id", "text_hash", "kind").orderBy("at")
    ends = matches.withColumn("end", F.sum(F.col("before") + F.col("matched")).over(upto))
    return ends.where(F.col("measured") >= F.col("least")).select("doc_id", "text_hash", "kind", (F.col("end") - F.col("matched")).alias("start"), "end")


def _candidates(docs: DataFrame, queries: dict[str, Query]) -> DataFrame:
    if not queries:
        return docs.select("doc_id", text_key().alias("text_hash"), F.array().cast("array<string>").alias("kinds")).where("false")
    index = stored(postings(docs, vocabulary(queries)), "postings")
    chosen = stored(candidates(index, queries), "secret-candidates")
    return bounded(chosen, chosen.count())


def digests(docs: DataFrame, spans: DataFrame, rules: tuple[Rule, ...] = RULES, base: tuple[Rule, ...] = BASE) -> DataFrame:
    """Per row of ``docs``: ``n_<kind>`` of each base rule, ``base_sha256`` and ``spans``: ``kind:start:end`` by start, then kind
    as listed, joined by commas."""
    place = {r.kind: i for i, r in enumerate(rules)}
    rank = F.create_map(*[x for kind, i in place.items() for x in (F.lit(kind), F.lit(i))])
    one = F.struct("start", rank[F.col("kind")].alias("rank"), "end", "kind")
    text = lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))
    joined = lambda rows: F.array_join(F.transform(rows, text), ",")
    per_doc = spans.groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_list(one)).alias("rows"))
    names = [r.kind for r in base]
    of = lambda kinds: F.filter("rows", lambda x: x["kind"].isin(kinds))
    told = per_doc.select(
        "doc_id", "text_hash",
        *[F.size(of([k])).cast("long").alias(f"n_{k}") for k in names],
        joined(of(names)).alias("base"), joined(F.col("rows")).alias("spans"),
    )
    own = docs.select("doc_id", text_key().alias("text_hash"))
    same = F.col("d.doc_id").eqNullSafe(F.col("t.doc_id")) & (F.col("d.text_hash") == F.col("t.text_hash"))
    return own.alias("d").join(told.alias("t"), same, "left").select(
        "d.doc_id", *[F.coalesce(f"t.n_{k}", F.lit(0).cast("long")).alias(f"n_{k}") for k in names],
        F.sha2(F.coalesce("t.base", F.lit("")), 256).alias("base_sha256"), F.coalesce("t.spans", F.lit("")).alias("spans"),
    )


#: code points of the blocks in which a text is cut at its spans
BLOCK = 256


def masked_spans(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``doc_id, text_hash, start, end``: the spans of all rules and of their strict expressions, those that overlap as one."""
    strict = tuple(Rule(f"{r.kind}:strict", r.strict, 0, 1) for r in rules if r.strict)
    doc = ["doc_id", "text_hash"]
    before = Window.partitionBy(*doc).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(*doc).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    spans = scan(docs, (*rules, *strict)).select(*doc, "start", "end").withColumn("reached", F.max("end").over(before))
    apart = spans.withColumn("place", F.count(F.when(F.col("reached").isNull() | (F.col("start") >= F.col("reached")), 1)).over(upto))
    return apart.groupBy(*doc, "place").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("place")


def _between(text: Column, spans: Column, mask: str) -> Column:
    """``text`` with ``mask`` for each of the sorted ``spans``; cut in blocks once, so that a span does not read the whole text."""
    size = F.lit(BLOCK)
    block = lambda at: F.floor(at / size).cast("int")
    within = lambda at: F.pmod(at, size).cast("int")

    def piece(blocks: Column, a: Column, b: Column) -> Column:
        first, last = block(a), block(b)
        inner = F.array_join(F.slice(blocks, first + 2, F.greatest(last - first - 1, F.lit(0))), "")
        head, tail = F.coalesce(F.get(blocks, first), F.lit("")), F.coalesce(F.get(blocks, last), F.lit(""))
        apart = F.concat(F.substring(head, within(a) + 1, size), inner, F.substring(tail, F.lit(1), within(b)))
        return F.when(first == last, F.substring(head, within(a) + 1, (b - a).cast("int"))).otherwise(apart)

    begins = F.concat(F.array(F.lit(0).cast("long")), F.transform(spans, lambda x: x["end"]))
    ends = F.concat(F.transform(spans, lambda x: x["start"]), F.array(F.char_length(text).cast("long")))
    once = F.array(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0)))  # a variable of the function is evaluated once
    pieces = F.transform(once, lambda blocks: F.array_join(F.zip_with(begins, ends, lambda a, b: piece(blocks, a, b)), mask))
    return pieces[0]


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, mask: str = "[secret]") -> DataFrame:
    """``docs`` with every span masked, its other columns as they are, whatever they are named; only texts with a span are
    rewritten, from the pieces between."""
    id_key, text_hash, cuts = (free(n, docs.columns) for n in ("id_key_", "text_hash_", "spans_"))
    key = {id_key: F.coalesce(F.col("doc_id").cast("string"), F.lit("none")), text_hash: text_key()}
    spans = masked_spans(docs, rules).groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias(cuts))
    named = stored(spans.select(key[id_key].alias(id_key), F.col("text_hash").alias(text_hash), cuts).dropDuplicates([id_key, text_hash]), "secret-documents")
    n = named.agg(F.coalesce(F.sum(F.size(cuts)), F.lit(0))).first()[0]
    told = docs.withColumns(key).join(bounded(named, n), [*key], "left")
    return told.withColumn("text", F.when(F.col(cuts).isNotNull(), _between(F.col("text"), F.col(cuts), mask)).otherwise(F.col("text"))).select(*docs.columns)
