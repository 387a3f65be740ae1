import random
import re

import pandas as pd
import pytest

from tests.parity import differences, duck
from tidemark.llm import quality
from tidemark.llm.queries import STATEMENTS, op10_quality


def slow(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    wins = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    covered = {p for i, w in enumerate(wins) if wins.count(w) > 1 for p in range(i, i + 8)}
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def test_measures_equal_brute_force():
    rnd = random.Random(3)
    for _ in range(150):
        text = "".join(rnd.choice(["a", "b", "é ", " ", "\n", "a b ", "#", "\x0b", "\x85x", "a b c d a b c d "]) for _ in range(rnd.randint(0, 90)))
        f = quality.Facts(text)
        assert tuple(getattr(f, m) for m in quality.MEASURES) == slow(text), text


def test_query_equals_its_statement(spark, sf_dir):
    got = op10_quality(spark, sf_dir).toPandas()
    assert not differences(got, duck(sf_dir).execute(STATEMENTS["op10_quality"]).df())


def test_clean_documents_stay(spark):
    docs = pd.read_parquet("/root/testdata/sf0.01/documents.parquet").merge(pd.read_parquet("/root/testdata/sf0.01/labels.parquet"), on="doc_id")
    names = [r.name for r in quality.order(docs.text[:100].tolist())]
    ordered = tuple(next(r for r in quality.RULES if r.name == n) for n in names)
    failed = [quality.verdict(quality.Facts(t), ordered) for t in docs.text]
    good = [f for f, q, t in zip(failed, docs.quality, docs.text) if q == 1 and len(t.split()) >= 20]
    bad = [f for f, q in zip(failed, docs.quality) if q == 0]
    assert not any(good) and sum(map(bool, bad)) / len(bad) > 0.8


def test_order_changes_no_verdict_and_puts_worth_first():
    texts = ["word " * 5, "one two three four five six seven eight nine ten " * 9, "# * | " * 30, None, "A" * 90]
    for rules in (quality.RULES, quality.RULES[::-1]):
        assert [quality.verdict(quality.Facts(t), rules) is None for t in texts] == [False] * 5
    found = quality.estimates(texts)
    assert all(0 <= e.rejected <= 1 and e.seconds > 0 for e in found)
    by = quality.order(texts)
    worth = {e.rule.name: e.rejected for e in found}
    assert [worth[r.name] > 0 for r in by] == sorted((worth[r.name] > 0 for r in by), reverse=True)
    assert set(quality.order([])) == set(quality.RULES)


def test_rules_are_short_circuited():
    asked = []
    rules = (quality.Rule("a", lambda f: asked.append("a") or True), quality.Rule("b", lambda f: asked.append("b") or True))
    assert quality.verdict(quality.Facts("x"), rules) == "a" and asked == ["a"]


def test_nulls_repeats_and_extra_columns(spark):
    fine = " ".join(f"word{i}" for i in range(40))
    rows = [(1, None, "x"), (2, "", "x"), (None, fine, "y"), (None, fine, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, rule string")
    got = sorted(((r.doc_id, r.n_words, r.base_failed, r.kept) for r in quality.cascade(docs, measures=True).collect()), key=str)
    assert got == sorted([(1, 0, True, False), (2, 0, True, False), (None, 40, False, True), (None, 40, False, True)], key=str)
    assert quality.cascade(docs).columns == ["doc_id", "text", "rule", "kept"]
    assert quality.cascade(docs.limit(0)).count() == 0


@pytest.mark.parametrize("n", [7, 8, 9, 16, 17])
def test_window_edges(n):
    text = "w " * n
    assert quality.Facts(text).n_repeat_words == slow(text)[4]


def test_sample_comes_from_all_partitions(spark):
    docs = spark.range(0, 40_000, 1, 8).selectExpr("id as doc_id", "cast(id as string) as text")
    ids = sorted(map(int, quality.sample(docs)))
    assert 300 < len(ids) < 500 and ids == sorted(map(int, quality.sample(docs)))
    assert {i // 5000 for i in ids} == set(range(8))


def test_columns_of_the_output_names_are_replaced_and_long_texts_pass(spark):
    long = " ".join(f"word{i}" for i in range(200_000))
    docs = spark.createDataFrame([(1, long, "old", 5)], "doc_id long, text string, KEPT string, n_words int")
    got = quality.cascade(docs, measures=True)
    assert got.columns.count("n_words") == 1 and "KEPT" not in got.columns
    assert got.select("n_words", "kept").first() == (200_000, True)
