"""Merkle manifest of a table: a hash tree over all rows, and the proof of every row against its root.

Every row is a leaf, the hash of its fields. The leaves of one tree (one value of a column) ascend by id; while several nodes
remain, every two neighbours become the hash of their digests, the last one alone if it has no neighbour. The roots of the trees,
ordered by name, are the leaves of one tree more, whose root stands for the table.

Positions come from one range-partitioned sort and the sizes of its partitions. A tree is cut into aligned blocks of
``2 ** bits`` leaves, so that no task ever holds more than one block, whatever a tree's share of the rows: the tops of the blocks are the
nodes of the next storey, which is cut in the same way, until each tree is a single node. Going back down, each block gets the siblings above it as
one row that sorts before its own.

A block is persistent: replacing a leaf makes a version that copies the leaf's ancestors inside the block and shares all other
nodes with the version before. Every row's claimed leaf (an altered one, or its own) is such a version; its top goes on
through the siblings above, in the tasks that hold the blocks, up to the root of the version.

Nulls: a null field is ``-``, a null tree name is a tree of its own and the first, null ids come first. Rows of one id are ordered
by their leaves, so repeated rows are leaves of their own beside each other. A tree of one row is that row's leaf. Empty texts have zero
bytes; long ones are hashed by Spark and leave the scan as 32 bytes. An empty table gives no rows. Extra columns are
not read. Numbers are told in decimal.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.graph import forget, stored
from tidemark.llm.shingles import bounded

BITS = 10
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: of a node by its sibling's place: before it, behind it, or none
BEFORE, BEHIND, ALONE = b"B", b"A", b"-"


def leaf_hash(fields: list[Column]) -> Column:
    """Digest (binary) of fields, each ``-`` if null, else its bytes in UTF-8, a colon and its value."""
    text = [f.cast("string") for f in fields]
    told = [F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in text]
    return F.unhex(F.sha2(F.concat(*told), 256))


def parent(left: bytes, right: bytes = b"") -> bytes:
    """Digest of digests, which are hashed as hexadecimal text."""
    return sha256((left + right).hex().encode()).digest()


class Block:
    """Levels of one aligned block of a tree of ``size`` leaves: ``bits`` of them, or up to the only node if the block is the whole tree."""

    def __init__(self, leaves: list[bytes], size: int, bits: int = BITS):
        self.levels = [leaves]
        while len(self.levels[-1]) > 1 if size <= 1 << bits else len(self.levels) <= bits:
            below = self.levels[-1]
            self.levels.append([parent(*below[i : i + 2]) for i in range(0, len(below), 2)])
        self.top = self.levels[-1][0]

    def proof(self, place: int) -> tuple[bytes, bytes]:
        """A letter for each level, and the siblings one after the other."""
        steps, siblings = b"", b""
        for level in self.levels[:-1]:
            other = place ^ 1
            steps += ALONE if other >= len(level) else BEFORE if other < place else BEHIND
            siblings += level[other] if other < len(level) else b""
            place >>= 1
        return steps, siblings

    def version(self, place: int, leaf: bytes) -> list[bytes]:
        """The nodes that a version with another leaf does not share with this one, from the leaf up to its top."""
        copies = [leaf]
        for level in self.levels[:-1]:
            other = place ^ 1
            pair = (copies[-1],) if other >= len(level) else (level[other], copies[-1]) if other < place else (copies[-1], level[other])
            copies.append(parent(*pair))
            place >>= 1
        return copies


def fold(node: bytes, steps: bytes, siblings: bytes) -> bytes:
    """The root that a node and its siblings give."""
    at = 0
    for step in steps:
        if step == ALONE[0]:
            node = parent(node)
            continue
        other, at = siblings[at : at + 32], at + 32
        node = parent(other, node) if step == BEFORE[0] else parent(node, other)
    return node


def positions(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows`` with ``pos``, their place within ``tree`` by ``order``, and ``size``, the number of rows of the tree."""
    by = [F.col(c).asc_nulls_first() for c in ("tree", *order)]
    table = stored(rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("at", F.monotonically_increasing_id()), name)
    part = F.shiftright("at", 33)
    runs = table.groupBy("tree", part.alias("part")).agg(F.min("at").alias("first"), F.count("*").alias("n"))
    tree = Window.partitionBy("tree")
    before = F.coalesce(F.sum("n").over(tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = stored(runs.select("tree", "part", (before - F.col("first")).alias("shift"), F.sum("n").over(tree).alias("size")), f"{name}-runs")
    same = F.col("t.tree").eqNullSafe(F.col("r.tree")) & (F.shiftright("t.at", 33) == F.col("r.part"))
    both = table.alias("t").join(bounded(runs, runs.count()).alias("r"), same)  # a row for each partition of the sort and for each tree
    return both.select(*[F.col(f"t.{c}") for c in rows.columns], (F.col("t.at") + F.col("r.shift")).alias("pos"), F.col("r.size"))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """The rows of one block after the other."""
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and (row["block"], row["tree"]) != (held[0]["block"], held[0]["tree"]):
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _dealt(nodes: DataFrame) -> DataFrame:
    """Whole blocks beside each other, in order."""
    return nodes.repartition("tree", "block").sortWithinPartitions("tree", "block", "pos")


def _blocked(nodes: DataFrame, bits: int) -> DataFrame:
    return nodes.withColumn("block", F.shiftright("pos", bits))


def tops(nodes: DataFrame, bits: int = BITS) -> DataFrame:
    """``tree, pos, size, digest`` of the storey above ``nodes`` of the same columns: a node for each block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _blocks(batches):
            size = rows[0]["size"]
            top = Block([r["digest"] for r in rows], size, bits).top
            above = -(-size >> bits)
            yield pa.RecordBatch.from_pylist([{"tree": rows[0]["tree"], "pos": rows[0]["block"], "size": above, "digest": top}], schema)

    schema = pa.schema([("tree", pa.string()), ("pos", pa.int64()), ("size", pa.int64()), ("digest", pa.binary())])
    return _dealt(_blocked(nodes.select("tree", "pos", "size", "digest"), bits)).mapInArrow(run, "tree string, pos long, size long, digest binary")


HEAD = "subroot binary, steps binary, siblings binary, root binary"


def _climb(nodes: DataFrame, heads: DataFrame, bits: int) -> DataFrame:
    """``nodes`` with their proofs up to the root; ``heads`` has the proof of every block (``tree, block``) of them.

    ``claimed`` is the leaf that a version holds instead of ``digest``, ``version_root`` the root of that version.
    """
    kept = [c for c in nodes.columns if c not in ("size",)]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in nodes.schema.fields if f.name in kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for head, *rows in _blocks(batches):
            block = Block([r["digest"] for r in rows], rows[0]["size"], bits)
            out = []
            for place, row in enumerate(rows):
                steps, siblings = block.proof(place)
                top = block.version(place, row["claimed"] or row["digest"])[-1]
                root = fold(top, head["steps"], head["siblings"])
                proof = {"subroot": head["subroot"], "steps": steps + head["steps"], "siblings": siblings + head["siblings"], "root": head["root"], "version_root": root}
                out.append({c: row[c] for c in kept} | proof)
            yield pa.RecordBatch.from_pylist(out, pa.schema([(c, types[c]) for c in out[0]]))

    full = f"{schema}, {HEAD}, version_root binary"
    types = {f.name: f.type for f in _arrow(nodes.sparkSession, full)}
    both = _blocked(nodes, bits).unionByName(heads.withColumn("pos", F.lit(-1).cast("long")), allowMissingColumns=True)
    return _dealt(both).mapInArrow(run, full)


def _arrow(spark, ddl: str) -> pa.Schema:
    return spark.createDataFrame([], ddl).toArrow().schema


def _forest(nodes: DataFrame, name: str, bits: int) -> tuple[list[DataFrame], DataFrame]:
    """Storeys of ``tree, pos, size, digest`` from ``nodes`` up, the last with a node for each tree."""
    storeys = [nodes]
    while (storeys[-1].agg(F.max("size")).first()[0] or 0) > 1:
        storeys.append(stored(tops(storeys[-1], bits), f"{name}-{len(storeys)}"))
    return storeys, storeys[-1]


def _down(storeys: list[DataFrame], heads: DataFrame, bits: int) -> DataFrame:
    """Proofs of the lowest storey, given those of the highest (``tree`` and the columns of ``HEAD``)."""
    heads = heads.withColumn("block", F.lit(0).cast("long"))
    for storey in storeys[-2:0:-1]:
        found = _climb(storey.withColumn("claimed", F.lit(None).cast("binary")), heads, bits)
        heads = found.select("tree", F.col("pos").alias("block"), "subroot", "steps", "siblings", "root")
    return heads


def manifest(leaves: DataFrame, bits: int = BITS) -> DataFrame:
    """Proofs of leaves ``tree`` (string), ``id``, ``digest`` and ``claimed`` (binary; the leaf to be verified instead, or null).

    Returns ``tree, id, pos, digest, claimed, subroot, steps, siblings, root, version_root``: ``fold`` of a leaf, ``steps`` and
    ``siblings`` gives ``root``; ``version_root`` is the root of the version that holds ``claimed``.
    """
    # stored first: ranges are sampled before rows are dealt to them, and long texts are hashed but once
    hashed = stored(leaves.select("tree", "id", "digest", "claimed"), "merkle-leaves")
    nodes = positions(hashed, ["id", "digest"], "merkle-sorted")
    forget(hashed)
    storeys, roots = _forest(nodes, "merkle-nodes", bits)
    if len(storeys) == 1:  # no tree has two leaves: the leaves are the roots
        storeys = [nodes, nodes.select("tree", F.lit(0).cast("long").alias("pos"), "size", "digest")]
        roots = storeys[-1]
    named = roots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest")
    upper = positions(named, ["name"], "merkle-roots")
    above, last = _forest(upper, "merkle-upper", bits)
    only = last.where("size = 1").select("tree", F.col("digest").alias("root"))
    start = only.select("tree", F.lit(None).cast("binary").alias("subroot"), F.lit(b"").alias("steps"), F.lit(b"").alias("siblings"), "root")
    if len(above) == 1:
        proofs = last.select("name", F.col("digest").alias("subroot"), F.lit(b"").alias("steps"), F.lit(b"").alias("siblings"), F.col("digest").alias("root"))
    else:
        found = _climb(upper.withColumn("claimed", F.lit(None).cast("binary")), _down(above, start, bits), bits)
        proofs = found.select("name", F.col("digest").alias("subroot"), "steps", "siblings", "root")
    heads = stored(proofs.withColumnRenamed("name", "tree"), "merkle-tree-proofs")
    return _climb(nodes, _down(storeys, heads, bits), bits)


def document_leaves(docs: DataFrame, altered: Column | None = None) -> DataFrame:
    """Leaves of documents by language; where ``altered`` holds, the claimed leaf has one character more in ``n_chars``."""
    more = (F.col("n_chars").cast("decimal(38,0)") + 1).cast("decimal(38,0)")
    fields = [F.col(c) for c in FIELDS]
    changed = [more if c == "n_chars" else F.col(c) for c in FIELDS]
    claimed = F.lit(None).cast("binary") if altered is None else F.when(altered, leaf_hash(changed))
    return docs.select(F.col("lang").cast("string").alias("tree"), F.col("doc_id").alias("id"), leaf_hash(fields).alias("digest"), claimed.alias("claimed"))
