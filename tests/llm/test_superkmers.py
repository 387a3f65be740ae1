import hashlib
import random
import re

import numpy as np
import pytest

from tidemark.llm import superkmers
from tidemark.llm.repeats import NO_ID

SPACES = " \t\n\x0b\x0c\r"


def slow(rows, length):
    """rows: (doc_id, text); per row words, words removed and digest of what is left, by a table of all windows."""
    texts = [(NO_ID if d is None else d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in rows]
    least = {}
    for d, w in texts:
        for i in range(len(w) - length + 1):
            k = tuple(w[i : i + length])
            least[k] = min(least.get(k, d), d)
    out = []
    for d, w in texts:
        gone = [False] * len(w)
        for i in range(len(w) - length + 1):
            if least[tuple(w[i : i + length])] < d:
                gone[i : i + length] = [True] * length
        out.append((len(w), sum(gone), hashlib.sha256(" ".join(x for x, g in zip(w, gone) if not g).encode()).hexdigest()))
    return out


def random_rows(rnd, n):
    words = rnd.choice([["a"], ["a", "b"], ["a", "b", "ab", "é", "\xa0", "😀"], [f"w{i}" for i in range(40)], [f"w{i}" for i in range(5000)]])
    passages = [rnd.choices(words, k=rnd.randint(1, 40)) for _ in range(5)] + [rnd.choices(words, k=rnd.randint(1, 4)) * rnd.randint(1, 12)]
    rows = []
    for i in range(n):
        parts = [w for _ in range(rnd.randint(0, 6)) for w in rnd.choice([rnd.choice(passages), rnd.choices(words, k=rnd.randint(0, 30))])]
        text = "".join(w + rnd.choice(SPACES) * rnd.randint(1, 2) for w in parts)
        rows.append((rnd.choice([i, i, i, 3, None]), rnd.choice([text, text, text, " " + text.strip(), rows[-1][1] if rows else None, None])))
    return rows


def hot_by_hand(rows, length, gram, share):
    """Keys by level of at least ``share`` words, as the Spark job finds them."""
    hot = []
    for _ in range(superkmers.levels(length, gram)):
        counter = superkmers.counter(length, gram, hot)
        found = [*counter.add([r[2] for r in rows]), counter.flush()]
        sums = {}
        for keys, words, _ in found:
            for k, n in zip(keys.view(np.uint64).tolist(), words.tolist()):
                sums[k] = sums.get(k, 0) + n
        level = sorted(k for k, n in sums.items() if n >= share)
        if not level:
            break
        hot.append(np.array(level, dtype=np.uint64))
    return hot


def solved(rows, shards, length, gram, share=None):
    """The operator's own steps without Spark: cut three rows at a time, solve every bucket, drop."""
    own = [(NO_ID if d is None else d, i, (t or "").encode()) for i, (d, t) in enumerate(rows)]
    hot = hot_by_hand(own, length, gram, share) if share else []
    cutter = superkmers.Cutter(shards, length, gram, hot)
    boxed = [b for k in range(0, len(own), 3) for b in cutter.add([r for r in own[k : k + 3] if r[2]])] + list(cutter.flush())
    spans = {i: [] for i in range(len(rows))}

    def keep(found):
        for _, key, start, end in zip(*found):
            spans[int(key)].append((int(start), int(end)))

    for _, _, known in (b for b in boxed if b[1] is None):
        keep(known)
    boxed = [b for b in boxed if b[1] is not None]
    for s in {b[0] for b in boxed}:
        shard = superkmers.Shard(length)
        for t, blob, _ in boxed:
            if t == s:
                for found in shard.add(blob):
                    keep(found)
        for found in shard.spans():
            keep(found)
    out = []
    for i, (_, _, t) in enumerate(own):
        n, removed, left = superkmers.kept_words(t, spans[i])
        out.append((n, removed, hashlib.sha256(left).hexdigest()))
    return out, len(hot)


@pytest.mark.parametrize("seed", range(60))
def test_steps_equal_brute_force(monkeypatch, seed):
    rnd = random.Random(seed)
    for name, sizes in (("HELD", [1, 300, 10**6]), ("RUN", [3, 4096]), ("SHARD_WORDS", [40, 10**6])):
        monkeypatch.setattr(superkmers, name, rnd.choice(sizes))
    piece = rnd.choice([40, 700, 1 << 20])
    monkeypatch.setattr(superkmers.pieces, "__defaults__", (piece,))
    length = rnd.choice([2, 5, 9, 50])
    rows = random_rows(rnd, rnd.randint(1, 14))
    gram = rnd.randint(1, min(length, 8))
    want = slow(rows, length)
    assert solved(rows, rnd.choice([1, 3]), length, gram)[0] == want
    for share in (1, 30):
        assert solved(rows, rnd.choice([1, 3]), length, gram, share)[0] == want


def test_colliding_hashes_are_told_apart(monkeypatch):
    monkeypatch.setattr(superkmers.Ranges, "of", lambda self, first, size: np.zeros(len(first), np.uint64))
    rnd = random.Random(9)
    rows = [(i, " ".join(rnd.choices("abc", k=12))) for i in range(20)]
    assert solved(rows, 1, 3, 2)[0] == slow(rows, 3)


def test_periodic_text_is_a_few_strings():
    for period in (1, 2, 3, 7):
        text = " ".join(f"w{i % period}" for i in range(600_000)).encode()
        rows = [(1, 1, text), (2, 2, text)]
        assert hot_by_hand(rows, superkmers.LENGTH, superkmers.GRAM, 8 * superkmers.RUN) == []
        cutter = superkmers.Cutter(5)
        blobs = list(cutter.add(rows))
        assert cutter.words < 1_300_000 and not blobs
        shard = superkmers.Shard()
        for _, blob, known in cutter.flush():
            list(shard.add(blob)) if blob is not None else None
        assert shard.words < 40 * period * superkmers.RUN


def test_common_line_is_dealt_out():
    rnd = random.Random(4)
    line = [f"line{i}" for i in range(24)]
    rows = [(i, i, " ".join(rnd.choices([f"w{k}" for k in range(3000)], k=60) + line + rnd.choices([f"w{k}" for k in range(3000)], k=60)).encode()) for i in range(300)]
    hot = hot_by_hand(rows, 50, 8, 1000)
    assert len(hot) >= 1

    def largest(hot):
        counter = superkmers.Cutter(1 << 20, hot=hot)
        list(counter.add(rows))
        shard, sizes = (np.concatenate([h[k] for h in counter.held]) for k in (0, 3))
        return max(np.bincount(np.unique(shard, return_inverse=True)[1], weights=sizes)), sizes.sum()

    (before, all_before), (after, all_after) = largest([]), largest(hot)
    assert before > 5 * after and all_after < 3 * all_before


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "x", "y", 1) for d, t in rows], "doc_id long, text string, kept string, spans string, start int")


def result(df):
    return [(r.n_words, r.n_removed, hashlib.sha256(r.kept.encode()).hexdigest()) for r in df.collect()]


def test_spark_job_equals_brute_force(spark):
    for seed in (1, 2):
        rows = random_rows(random.Random(seed), 60)
        assert sorted(result(superkmers.deduplicate(frame(spark, rows), 5, 2))) == sorted(slow(rows, 5))
    rnd = random.Random(8)
    line = " ".join(f"l{i}" for i in range(30))
    text = lambda k: " ".join(f"w{rnd.randrange(900)}" for _ in range(k))
    rows = [(i, f"{text(40)} {line} {text(40)}" if i % 3 else rows_text) for rows_text in [text(400)] for i in range(400)]
    got = superkmers.hot_keys(frame(spark, rows).select("text"), lambda hot: superkmers.counter(50, 8, hot), 6, superkmers.SHARD_WORDS, superkmers.LEAST_HOT)
    assert len(got[0]) >= 1  # the line is hot, so the job below goes by more words
    assert sorted(result(superkmers.deduplicate(frame(spark, rows)))) == sorted(slow(rows, 50))


def test_edges(spark):
    assert superkmers.deduplicate(frame(spark, [])).count() == 0
    long = " ".join(f"w{i % 2999}" for i in range(400_000))
    rows = [(2, long), (1, long[: len(long) // 2]), (None, "a " * 60), (None, "a " * 60), (3, ""), (4, None), (5, " \n\t"), (6, "w" * 3_000_000), (7, "a " * 60), (7, "a " * 60)]
    assert sorted(result(superkmers.deduplicate(frame(spark, rows)))) == sorted(slow(rows, 50))
