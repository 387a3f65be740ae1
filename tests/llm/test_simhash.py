import os
import re

import numpy as np
import pandas as pd
import pytest
import xxhash

from tidemark.llm import decontaminate, graph, queries, repeats, secrets, simhash, superkmers
from tidemark.llm.queries import op4_simhash


def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def slow_components(prints, ids):
    n, parent = len(prints), list(range(len(prints)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(n):
        for j in np.flatnonzero(np.bitwise_count(prints[i + 1 :] ^ prints[i]) <= 3) + i + 1:
            parent[root(int(j))] = root(i)
    best = {}
    for i in range(n):
        best[root(i)] = min(best.get(root(i), ids[i]), ids[i])
    return [best[root(i)] for i in range(n)]


def test_query_equals_brute_force(spark, sf_dir):
    docs = pd.read_parquet(f"{sf_dir}/documents.parquet").reset_index(drop=True)
    prints = np.array([slow_fingerprint(t) for t in docs.text], dtype=np.uint64)
    want = dict(zip(docs.doc_id, zip((f"{int(p):016x}" for p in prints), slow_components(prints, docs.doc_id.tolist()))))
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in op4_simhash(spark, sf_dir).collect()} == want


def test_edge_texts_against_spark_hash(spark):
    from pyspark.sql import functions as F

    for text in ("", " \t\n", None):
        assert simhash.fingerprint(text) == 0
    assert simhash.fingerprint("Ä b") == slow_fingerprint("Ä b")
    assert simhash.fingerprint("ÀB") == xxhash.xxh64_intdigest("Àb".encode(), 42)
    assert spark.range(1).select(F.xxhash64(F.lit("Àb"))).first()[0] % 2**64 == simhash.fingerprint("ÀB")
    long = " ".join(f"w{i % 977}" for i in range(70_000))
    assert simhash.fingerprint(long) == slow_fingerprint(long)


def test_links_are_all_pairs_within_three_bits(spark):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    prints = {0, 2**64 - 1, *map(int, base)}
    for b in base:
        for k in (1, 2, 3, 4, 5):
            for _ in range(4):
                prints.add(int(b) ^ sum(1 << int(x) for x in rng.choice(64, k, replace=False)))
    own = np.array(sorted(prints), dtype=np.uint64)
    signed = own.view(np.int64).tolist()
    want = {tuple(sorted((signed[i], signed[j]), reverse=True)) for i in range(len(own)) for j in range(i) if int(own[i] ^ own[j]).bit_count() <= 3}
    frame = spark.createDataFrame([(x,) for x in signed], "fingerprint long")
    got = [tuple(r) for r in simhash.links(frame).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert {tuple(r) for r in simhash.links(frame, 1).collect()} == {p for p in want if ((p[0] ^ p[1]) % 2**64).bit_count() <= 1}


def test_components_of_long_paths_and_hubs(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, 201), (201, 200)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 160)}, 200: 200, 201: 200}
    assert graph.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_nulls_repeats_and_extra_columns(spark):
    a = "one two three four five six seven eight nine ten"
    rows = [(5, a, "x"), (3, a, "y"), (3, a, "y"), (None, a, "z"), (None, "quite another text here", "z"), (9, None, "q"), (8, "", "q"), (None, None, "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    got = sorted(((r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect()), key=str)
    assert got == sorted([(5, 3), (3, 3), (3, 3), (None, 3), (None, None), (9, 8), (8, 8), (None, 8)], key=str)
    kept = sorted(((r.doc_id, r.text, r.component_id) for r in simhash.keep_one(docs).collect()), key=str)
    assert kept == sorted([(3, a, "y"), (None, "quite another text here", "z"), (8, "", "q")], key=str)
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_crowded_halves_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CROWD", 20)
    rng = np.random.default_rng(6)
    base = int(rng.integers(0, 2**32)) << 32
    prints = {base | int(x) for x in rng.integers(0, 2**32, 150)} | {(int(x) << 32) | 77 for x in rng.integers(0, 2**32, 60)}
    for b in list(prints)[:60]:
        prints |= {b ^ sum(1 << int(x) for x in rng.choice(64, k, replace=False)) for k in (1, 2, 3, 4)}
    own = np.array(sorted(prints), dtype=np.uint64)
    signed = own.view(np.int64).tolist()
    want = {tuple(sorted((signed[i], signed[j]), reverse=True)) for i in range(len(own)) for j in range(i) if int(own[i] ^ own[j]).bit_count() <= 3}
    got = [tuple(r) for r in simhash.links(spark.createDataFrame([(x,) for x in signed], "fingerprint long")).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_many_fingerprints_with_one_half(spark):
    """All with all would be 2 * 10 ** 8 candidates."""
    low = np.random.default_rng(7).choice(2**32, 20_000, replace=False)
    frame = spark.createDataFrame([(int(x),) for x in low], "fingerprint long")
    assert simhash.candidates(frame).count() < 20_000 * 40


def test_ids_that_are_no_numbers_are_refused(spark):
    docs = spark.createDataFrame([("d1", "a b c")], "doc_id string, text string")
    for run in (simhash.near_duplicates, simhash.keep_one, repeats.find_spans, superkmers.find_spans):
        with pytest.raises(ValueError, match="doc_id must be a whole number"):
            run(docs)


def test_helper_names_of_the_input_stay(spark):
    docs = spark.createDataFrame([(1, "a b c", "k", "h"), (2, "a b c", "k2", "h2")], "doc_id long, text string, ID_key_ string, text_hash_ string")
    assert [tuple(r) for r in simhash.keep_one(docs).collect()] == [(1, "a b c", "k", "h")]
    items = spark.createDataFrame([(1, "x y z u v w")], "item_id long, text string")
    assert sorted(tuple(r) for r in decontaminate.remove(docs, items).collect()) == [(1, "a b c", "k", "h"), (2, "a b c", "k2", "h2")]
    masked = spark.createDataFrame([(1, "password=hunter2secret", "k", "s")], "doc_id long, text string, id_key_ string, spans_ string")
    assert [tuple(r) for r in secrets.redact(masked).collect()] == [(1, "[secret]", "k", "s")]


@pytest.mark.parametrize("query,reads", [
    (queries.op4_simhash, {"fingerprints", "edges"}), (queries.op7_repeats, {"repeat-spans"}), (queries.op12_windows, {"window-spans"}),
    (queries.op13_merkle, {"merkle-sorted", "merkle-sorted-runs", "merkle-nodes", "merkle-roots", "merkle-roots-runs", "merkle-upper", "merkle-tree-proofs"}),
    (queries.op11_whitening, set()),
])
def test_a_query_leaves_only_what_its_result_reads(spark, sf_dir, query, reads):
    folder = spark.conf.get("spark.checkpoint.dir")
    tables = lambda: {n for _, names, _ in os.walk(folder) for n in names if re.fullmatch(r"[a-z0-9-]+-[0-9a-f]{8}", n)}
    before = tables()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    left = {re.sub(r"(-\d+)?-[0-9a-f]{8}$", "", n) for n in tables() - before}
    assert left <= reads
