import random
import re

import pytest

from tests.parity import differences, duck
from tidemark.llm import decontaminate, shingles
from tidemark.llm.queries import STATEMENTS, op1_decontaminate


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def slow(docs, items, threshold=0.8):
    out = set()
    for d, text in docs:
        own = words(text)
        for i, item in items:
            w = words(item)
            if not w:
                continue
            k = min(5, len(w))
            want = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)}
            have = {tuple(own[j : j + k]) for j in range(len(own) - k + 1)}
            if len(want & have) >= threshold * len(want) - 1e-9:
                out.add((d, i, len(want), len(want & have)))
    return out


def cases():
    rnd = random.Random(4)
    vocabulary = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(rnd.choices(vocabulary, k=n))) for i, n in enumerate([1, 2, 3, 4, 5, 6, 8, 9, 12, 20, 30, 33, 60, 64, 120])]
    docs = []
    for d in range(60):
        body = rnd.choices(vocabulary, k=rnd.randint(0, 200))
        _, item = rnd.choice(items)
        part = item.split()
        for _ in range(rnd.randint(0, 2)):  # near copies around the threshold
            part[rnd.randrange(len(part))] = "other"
        at = rnd.randint(0, len(body))
        docs.append((d, " ".join(body[:at] + part + body[at:])))
    return docs, items


@pytest.mark.parametrize("limit", [shingles.BROADCAST_ROWS, 0])
def test_equals_brute_force_broadcast_or_shuffled(spark, monkeypatch, limit):
    monkeypatch.setattr(shingles, "BROADCAST_ROWS", limit)
    docs, items = cases()
    found = decontaminate.find(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id, r.n_shingles, r.n_found) for r in found.collect()} == slow(docs, items)


def test_a_sketch_is_never_missed():
    """Any document that may miss as much as the threshold allows still holds a hash of the sketch."""
    for n in range(1, 3000):
        largest = 2 ** (n.bit_length()) - 1
        may_miss = n - -(-4 * n // 5)
        assert int(0.2 * largest + 1e-9) + 1 > may_miss


def test_query_equals_its_statement(spark, sf_dir):
    got = op1_decontaminate(spark, sf_dir).toPandas()
    assert len(got) and not differences(got, duck(sf_dir).execute(STATEMENTS["op1_decontaminate"]).df(), 1e-12)


def test_nulls_repeats_ties_and_extra_columns(spark):
    item = "one two three four five six seven"
    docs = spark.createDataFrame([
        (1, f"x, {item.upper()}! y", 5), (1, f"x, {item.upper()}! y", 5), (2, None, 5), (3, "", 5), (None, item, None), (4, "one two three four five", 1), (4, "clean text here", 1),
    ], "doc_id long, text string, item_id long")
    items = spark.createDataFrame([(7, item, "a"), (7, item, "a"), (8, None, "a"), (9, "", "a"), (None, "ONE two", "b")], "item_id long, text string, doc_id string")
    got = sorted(((r.doc_id, r.item_id, r.n_found) for r in decontaminate.find(docs, items).collect()), key=str)
    assert got == sorted([(1, 7, 3), (1, None, 1), (None, 7, 3), (None, None, 1), (4, None, 1)], key=str)
    kept = sorted(((r.doc_id, r.text, r.item_id) for r in decontaminate.remove(docs, items).collect()), key=str)
    assert kept == sorted([(2, None, 5), (3, "", 5), (4, "clean text here", 1)], key=str)
    assert decontaminate.find(docs.limit(0), items).count() == 0 == decontaminate.find(docs, items.limit(0)).count()
    assert decontaminate.remove(docs, items.limit(0)).count() == docs.count()
