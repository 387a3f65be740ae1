import hashlib
import random
import resource

import numpy as np
import pandas as pd
import pytest

from tidemark.llm import ranges, repeats, suffix
from tidemark.llm.queries import op7_repeats


def slow(rows, length):
    """rows: (doc_id, text); per row the digest fields, by a table of all strings."""
    texts = [(repeats.NO_ID if d is None else d, (t or "").encode()) for d, t in rows]
    least = {}
    for d, t in texts:
        for i in range(len(t) - length + 1):
            least[t[i : i + length]] = min(least.get(t[i : i + length], d), d)
    out = []
    for d, t in texts:
        gone = np.zeros(len(t), dtype=bool)
        for i in range(len(t) - length + 1):
            if least[t[i : i + length]] < d:
                gone[i : i + length] = True
        runs = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(t), int(gone.sum()), runs, hashlib.sha256(bytes(b for b, g in zip(t, gone) if not g)).hexdigest()))
    return out


def result(df):
    return [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest()) for r in df.collect()]


def random_rows(rnd, n):
    alphabet = rnd.choice(["ab", "abcé 😀", "a", "abcdefghij \n\0"])
    passages = ["".join(rnd.choices(alphabet, k=rnd.randint(3, 60))) for _ in range(5)]
    rows = []
    for i in range(n):
        text = "".join(rnd.choice([rnd.choice(passages), "".join(rnd.choices(alphabet, k=rnd.randint(0, 30)))]) for _ in range(rnd.randint(0, 6)))
        rows.append((rnd.choice([i, i, i, 3, None]), rnd.choice([text, text, text, rows[-1][1] if rows else None, None])))
    return rows


def solved(rows, shards, length, gram, hot=None):
    """The operator's own steps without Spark: cut in slices of three rows, solve every shard, drop."""
    own = [(repeats.NO_ID if d is None else d, i, (t or "").encode()) for i, (d, t) in enumerate(rows)]
    cutter = repeats.Cutter(shards, length, gram, hot)
    blobs = [b for k in range(0, len(own), 3) for b in cutter.add(own[k : k + 3])] + list(cutter.flush())
    spans = {i: [] for i in range(len(rows))}
    for s in {s for s, _ in blobs}:
        shard = repeats.Shard()
        for t, blob in blobs:
            if t == s:
                shard.add(blob)
        for _, key, start, end in zip(*shard.spans(length, gram)):
            spans[int(key)].append((int(start), int(end)))
    out = []
    for i, (_, _, t) in enumerate(own):
        removed, runs, left = repeats.kept_bytes(t, spans[i])
        out.append((len(t), removed, runs, hashlib.sha256(left).hexdigest()))
    return out


@pytest.mark.parametrize("memory,piece,held", [(64 << 20, 4 << 20, 64 << 20), (100, 37, 64 << 20), (100, 37, 300)])
def test_steps_equal_brute_force(monkeypatch, memory, piece, held):
    monkeypatch.setattr(repeats, "HELD", held)
    monkeypatch.setattr(suffix, "MEMORY", memory)
    monkeypatch.setattr(repeats, "PIECE", piece)
    rnd = random.Random(memory)
    for _ in range(80):
        rows, length, gram = random_rows(rnd, rnd.randint(1, 12)), rnd.choice([16, 20, 50]), rnd.choice([8, 12, 16])
        assert solved(rows, rnd.choice([1, 3]), length, gram) == slow(rows, length)


def test_frames_with_nulls_repeats_and_extra_columns(spark):
    a = "".join(random.Random(1).choices("abcdefgh ", k=120))
    rows = [(2, a, 0), (1, "x" + a[10:80], 0), (1, "x" + a[10:80], 0), (None, a, 1), (None, a, 1), (3, None, 1), (4, "", 1), (5, "short", 1), (2, a[30:], 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start int")
    want = [(r[0], *w) for r, w in zip(rows, slow([r[:2] for r in rows], 50))]
    assert sorted(result(repeats.deduplicate(docs)), key=str) == sorted(want, key=str)
    assert repeats.deduplicate(docs.limit(0)).count() == 0


def test_query_equals_brute_force(spark, sf_dir):
    docs = pd.read_parquet(f"{sf_dir}/documents.parquet")
    want = dict(zip(docs.doc_id, slow(list(zip(docs.doc_id, docs.text)), 50)))
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in op7_repeats(spark, sf_dir).collect()}
    assert got == want and sum(x[1] for x in want.values()) > 0


def test_numbers_travel_thin():
    for values in ([], [0], [1, 2, 300], [2**40, 5], [-1, 3], [repeats.NO_ID, 0]):
        own = np.array(values, dtype=np.int64)
        assert repeats.widen(repeats.thin(own)).tolist() == values


def test_a_shard_is_a_partition(spark):
    dealt = spark.range(13).selectExpr("cast(id as int) as shard").repartitionById(13, "shard")
    assert [r.shard for r in dealt.selectExpr("shard", "spark_partition_id() as p").where("shard <> p").collect()] == []


def hot_by_hand(rows, length, gram, share):
    hot = []
    for _ in range(ranges.levels(length, gram)):
        counting = repeats.counter(length, gram, hot)
        sums = {}
        for keys, units, _ in [*counting.add([r[2] for r in rows]), counting.flush()]:
            for k, n in zip(keys.view(np.uint64).tolist(), units.tolist()):
                sums[k] = sums.get(k, 0) + n
        level = sorted(k for k, n in sums.items() if n >= share)
        if not level:
            break
        hot.append(np.array(level, dtype=np.uint64))
    return hot


@pytest.mark.parametrize("seed", range(30))
def test_hot_anchors_and_short_runs_equal_brute_force(monkeypatch, seed):
    rnd = random.Random(seed)
    monkeypatch.setattr(repeats, "RUN", rnd.choice([2, 7, 4096]))
    length = rnd.choice([16, 20, 50])
    rows = random_rows(rnd, rnd.randint(2, 14))
    phrase = "".join(rnd.choices("abcdef", k=rnd.randint(8, 60)))
    rows += [(50 + i, "".join(rnd.choices("abcdefgh", k=30)) + phrase + "".join(rnd.choices("abcdefgh", k=30))) for i in range(6)]
    own = [(repeats.NO_ID if d is None else d, i, (t or "").encode()) for i, (d, t) in enumerate(rows)]
    want = slow(rows, length)
    gram = rnd.choice([8, 12])
    hot = hot_by_hand(own, length, gram, 1)
    assert hot and solved(rows, 3, length, gram) == want and solved(rows, 3, length, gram, hot) == want


@pytest.mark.parametrize("period", [1, 3, 10])
def test_runs_of_a_period_stay_small(period):
    """16 MB of blanks, of a period of three and of ten."""
    piece = "".join(chr(32 + i) for i in range(period)).encode()
    text = (piece * ((16 << 20) // period))[: 16 << 20]
    cutter = repeats.Cutter(4, 50, 16)
    began = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    boxes = [*cutter.add([(1, 1, text), (2, 2, text)]), *cutter.flush()]
    assert sum(len(b) for _, b in boxes) < 4 << 20  # they travel as a few equal strings
    found = 0
    for s in range(4):
        shard = repeats.Shard()
        for t, blob in boxes:
            if t == s:
                shard.add(blob)
        if shard.parts:
            ids, _, start, end = shard.spans(50, 16)
            assert (ids == 2).all()
            found += int((end - start).sum())
    assert found >= len(text) and resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - began < 700_000  # kB


def test_one_phrase_in_many_documents_is_dealt_out():
    rnd = random.Random(3)
    phrase = "a phrase that a third of all documents have "
    rows = [(i, i, ("".join(rnd.choices("abcdefghijklmnop", k=80)) + phrase + "".join(rnd.choices("abcdefghijklmnop", k=80))).encode()) for i in range(4000)]
    hot = hot_by_hand(rows, 50, 16, 20_000)

    def largest(hot):
        text = np.frombuffer(b"".join(r[2] for r in rows) + bytes(8), dtype=np.uint8)[:-8]
        sizes = np.array([len(r[2]) for r in rows])
        _, count, _, key = repeats.segments(text, np.cumsum(sizes) - sizes, sizes, 50, 16, hot)
        return np.bincount(np.unique(key, return_inverse=True)[1], weights=count + 49).max(), (count + 49).sum()

    (before, all_before), (after, all_after) = largest([]), largest(hot)
    assert hot and before > 8 * after and all_after < 2 * all_before
