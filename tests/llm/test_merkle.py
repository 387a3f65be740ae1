import hashlib
import random
import zlib

import pandas as pd
import pytest

from tidemark.llm import merkle
from tidemark.llm.queries import op13_merkle, tampered


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def slow_leaf(row, more=0):
    doc_id, source, lang, n_chars, text = row
    n_chars = None if n_chars is None else n_chars + more
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def slow_tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([h("".join(levels[-1][i : i + 2])) for i in range(0, len(levels[-1]), 2)])
    return levels


def slow_proof(levels, place):
    out = []
    for level in levels[:-1]:
        out.append((level[place ^ 1] if place ^ 1 < len(level) else "", place & 1))
        place >>= 1
    return out


def slow(rows):
    """rows: (doc_id, source, lang, n_chars, text); the digest fields of the query, sorted."""
    first = lambda v: (v is not None, v if v is None or isinstance(v, int) else v.encode())
    key = lambda r: (first(r[0]), slow_leaf(r))
    langs = sorted({r[2] for r in rows}, key=lambda v: (v is not None, (v or "").encode()))
    trees = {lang: sorted((r for r in rows if r[2] == lang), key=lambda r: (key(r)[0][0], key(r)[0][1] or 0, key(r)[1])) for lang in langs}
    levels = {lang: slow_tree([slow_leaf(r) for r in trees[lang]]) for lang in langs}
    upper = slow_tree([levels[lang][-1][0] for lang in langs])
    out = []
    for k, lang in enumerate(langs):
        for i, r in enumerate(trees[lang]):
            proof = slow_proof(levels[lang], i) + slow_proof(upper, k)
            bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            node = slow_leaf(r, 1 if bad else 0)
            for other, right in proof:
                node = h(other + node if right else node + other)
            out.append((r[0], slow_leaf(r), levels[lang][-1][0], upper[-1][0], h("".join(s for s, _ in proof)), node, node == upper[-1][0]))
    return sorted(out, key=str)


def result(spark, rows, bits, extra=False):
    schema = "doc_id long, source string, lang string, n_chars long, text string" + (", tree string, id string, digest string, pos string, block int" if extra else "")
    docs = spark.createDataFrame([(*r, *(["x", "y", "z", "p", 1] if extra else [])) for r in rows], schema)
    found = merkle.manifest(merkle.document_leaves(docs, tampered()), bits).collect()
    told = lambda v: bytes(v).hex()
    for r in found:
        assert merkle.fold(bytes(r.digest), bytes(r.steps), bytes(r.siblings)) == bytes(r.root)
    return sorted(((r.id, told(r.digest), told(r.subroot), told(r.root), h(told(r.siblings)), told(r.version_root), r.version_root == r.root) for r in found), key=str)


@pytest.mark.parametrize("seed,n,bits", [(1, 70, 2), (2, 33, 1), (3, 9, 3), (4, 1, 2), (5, 2, 10), (6, 130, 2)])
def test_manifest_equals_brute_force(spark, seed, n, bits):
    rnd = random.Random(seed)
    langs = rnd.choice([["en"], ["en", "de", None, "é", "z"], [f"l{i}" for i in range(7)]])
    rows = [(rnd.choice([i, i, i, 5, None]), rnd.choice(["a", None, ""]), rnd.choice([langs[0], rnd.choice(langs)]), rnd.choice([None, 0, i]), rnd.choice([None, "", "é" * i])) for i in range(n)]
    rows += rows[:3]
    assert result(spark, rows, bits, extra=seed % 2 == 0) == slow(rows)


def test_every_size_up_to_four_storeys(spark):
    for n in (*range(1, 18), 31, 32, 33, 64, 65):
        levels = slow_tree([h(str(i)) for i in range(n)])
        whole = merkle.Block([bytes.fromhex(x) for x in levels[0]], n, 10)
        assert whole.top.hex() == levels[-1][0]
    rows = [(i, None, "en", i, "t") for i in range(65)]
    assert result(spark, rows, 1) == slow(rows)


def test_version_shares_all_but_its_ancestors():
    leaves = [bytes([i]) * 32 for i in range(13)]
    block = merkle.Block(leaves, 13, 4)
    before = [list(level) for level in block.levels]
    copies = block.version(12, b"x" * 32)
    other = merkle.Block([*leaves[:12], b"x" * 32], 13, 4)
    assert block.levels == before and len(copies) == 5 and copies[-1] == other.top != block.top
    assert sum(a != b for x, y in zip(block.levels, other.levels) for a, b in zip(x, y)) == len(copies)
    assert block.version(3, leaves[3])[-1] == block.top
    assert merkle.fold(leaves[12], *block.proof(12)) == block.top


def test_empty_table_and_long_text(spark):
    assert result(spark, [], 2) == []
    rows = [(1, "s", "en", 3_000_000, "long " * 600_000), (2, "s", "en", 0, "")]
    assert result(spark, rows, 10) == slow(rows)
    most = [(2**63 - 1, None, None, 2**63 - 1, None), (-(2**63), None, None, -1, None)]
    assert result(spark, most, 10) == slow(most)


def test_query_equals_brute_force(spark, sf_dir):
    docs = pd.read_parquet(f"{sf_dir}/documents.parquet")
    rows = [tuple(None if pd.isna(v) else int(v) if c in ("doc_id", "n_chars") else v for c, v in zip(merkle.FIELDS, r)) for r in docs[list(merkle.FIELDS)].itertuples(index=False)]
    got = [tuple(r) for r in op13_merkle(spark, sf_dir).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()]
    assert sorted(got, key=str) == slow(rows)
    assert 0 < sum(not r[-1] for r in got) < len(got) / 3
