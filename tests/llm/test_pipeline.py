import os
import re

import pandas as pd
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.test_decontaminate import slow as slow_leaks
from tests.llm.test_simhash import slow_components, slow_fingerprint
from tidemark.llm import langid, secrets
from tidemark.llm.queries import vocabulary_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Each stage's result at sf0.01, written and read again."""
    sf_dir = "/root/testdata/sf0.01"
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), {}
    out["documents"] = docs.toPandas()
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        out[name] = docs.toPandas()
    return out


def test_columns_and_order(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "simhash_dedup", "decontaminate", "secret_scan", "bpe"]
    for name in ("language_id", "simhash_dedup", "decontaminate", "secret_scan"):
        assert list(stages[name].columns) == COLUMNS


def test_language(spark, stages):
    docs = stages["documents"]
    model = langid.learn(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    found = [model.predict(t) for t in docs.text]
    want = {d for d, (x, s) in zip(docs.doc_id, found) if x != "und" and s >= model.threshold}
    assert set(stages["language_id"].doc_id) == want and len(want) > 0.98 * len(docs)


def test_simhash(stages):
    import numpy as np

    docs = stages["language_id"].reset_index(drop=True)
    roots = slow_components(np.array([slow_fingerprint(t) for t in docs.text], dtype=np.uint64), docs.doc_id.tolist())
    assert sorted(stages["simhash_dedup"].doc_id) == sorted(set(roots)) and len(set(roots)) < len(docs)


def test_decontamination(stages):
    docs, items = stages["simhash_dedup"], pd.read_parquet("/root/testdata/sf0.01/benchmark.parquet")
    leaks = {d for d, *_ in slow_leaks(list(zip(docs.doc_id, docs.text)), list(zip(items.item_id, items.text)))}
    assert set(stages["decontaminate"].doc_id) == set(docs.doc_id) - leaks and leaks


def test_secrets(stages):
    before, after = stages["decontaminate"].set_index("doc_id"), stages["secret_scan"].set_index("doc_id")
    assert set(before.index) == set(after.index) and (after.n_chars == after.text.str.len()).all()
    changed = 0
    for d, text in before.text.items():
        hits = [m for r in secrets.RULES for m in re.finditer(r.strict or r.pattern, text)]
        changed += bool(hits)
        assert bool(hits) == (after.text[d] != text)
        assert not any(m[0] in after.text[d] for m in hits)
    assert changed


def test_tokens(stages):
    library = Tokenizer.from_file(vocabulary_path())
    docs, coded = stages["secret_scan"].set_index("doc_id"), stages["bpe"].set_index("doc_id")
    assert set(docs.index) == set(coded.index)
    for d, text in docs.text.items():
        assert coded.ids[d].tolist() == library.encode(text, add_special_tokens=False).ids and coded.n_tokens[d] == len(coded.ids[d])


def test_nulls_repeats_and_extra_columns_go_through(spark):
    body = "the of and to in is it for on that by this with are be as at from was an or " * 4
    rows = [(1, body, None, "s", 5, "x"), (1, body, None, "s", 5, "x"), (2, None, "en", "s", None, "x"), (None, "another kind of text in plain english words for the nameless one", "en", None, 3, "x"), (3, "", "en", "s", 0, "x"), (4, "plain words of another text to learn english from", "en", "s", 0, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, lang_pred_note string")
    for name, stage in corpus_pipeline.STAGES:
        empty = stage(spark, docs.limit(0), "/root/testdata/sf0.001")
        assert empty.count() == 0
        docs = stage(spark, docs, "/root/testdata/sf0.001")
    assert sorted(str(r.doc_id) for r in docs.collect()) == ["1", "4", "None"]


def test_run(spark, sf_dir):
    assert corpus_pipeline.run(spark, sf_dir).columns == ["doc_id", "lang", "source", "n_tokens", "ids", "decoded_sha256"]


def test_columns_of_any_name_pass(spark, tmp_path):
    rows = [(i, f"some plain words number {i} of an english text that is long enough to be told", "en", "s", 70, 1.5, "k", "p", True) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score double, id_key_ string, lang_pred string, accepted boolean")
    spark.createDataFrame([(1, "quite another passage of a benchmark")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
        assert {(r.score, r.id_key_, r.lang_pred, r.accepted) for r in out.collect()} == {(1.5, "k", "p", True)}, name


def test_stages_leave_only_the_result(spark, tmp_path):
    folder = spark.conf.get("spark.checkpoint.dir")
    tables = lambda: {f"{d}/{n}" for d, names, _ in os.walk(folder) for n in names if re.fullmatch(r"[a-z0-9-]+-[0-9a-f]{8}", n)}
    before = tables()
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    left = tables() - before
    assert len(left) == 1 and "/stage-bpe-" in left.pop() and out.count() > 0
