import gc
import hashlib
import tracemalloc

import pandas as pd
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import bpe
from tidemark.llm.batches import SLICE_BYTES
from tidemark.llm.queries import op5_bpe, vocabulary_path

PATH = vocabulary_path()
LIBRARY = Tokenizer.from_file(PATH)
OWN = bpe.Encoder(bpe.read_vocabulary(PATH))
TOKENS = bpe.tokens(bpe.read_vocabulary(PATH))


def same(text):
    ids = LIBRARY.encode(text, add_special_tokens=False).ids
    assert OWN.encode(text) == ids
    assert bpe.spell(ids, TOKENS) == LIBRARY.decode(ids, skip_special_tokens=False)


@settings(deadline=None, max_examples=300)
@given(st.text(alphabet=st.characters(codec="utf-8", max_codepoint=0x2FFF, exclude_categories=["Cn", "Cs"])))
def test_any_text(text):
    same(text)


@settings(deadline=None, max_examples=300)
@given(st.text(alphabet="aehinrstABÉüß '’.,!<|>0129\ń\xa0Σς"))
def test_likely_text(text):
    same(text)


@pytest.mark.parametrize("text", [
    "", " ", "the", "The THE the", "<|startoftext|>a<|endoftext|> <|endoftext|", "é<|endoftext|>́", "ΑΣ ΟΔΟΣ", "İI",
    "don't WE'LL 'sx", "1234", "a" * 5000, "the" * 3000, "\x1c\x1d\x85 x", "🙂🙂👩‍👩‍👧",
])
def test_edges(text):
    same(text)


def test_every_cut_is_certain():
    """No token of the vocabulary spans a cut, and texts are in fact cut inside words."""
    cut = 0
    for token in TOKENS[:49406]:
        plain = token.removesuffix(bpe.END)
        if token.endswith(bpe.END) and plain.isascii() and len(plain) > 1:
            assert OWN.cuts(plain.encode()) == []
    for word in ("xqzj", "qqvkx", "zzxqw"):
        cut += len(OWN.cuts(word.encode()))
    assert cut > 0


def test_remembered_words_are_small():
    """Four bytes an id beside the word and its place: workers keep these while other stages run."""
    own = bpe.Encoder(bpe.read_vocabulary(PATH))
    words = [hashlib.md5(str(i).encode()).hexdigest().translate(str.maketrans("0123456789", "ghijklmnop")) for i in range(20_000)]
    own.encode(" ".join(words[:10]))
    gc.collect()
    tracemalloc.start()
    try:
        for word in words:
            own.word(word)
        held, _ = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    assert len(own.words) == len(words) and held / len(words) < 200
    assert own.encode(words[5]) == LIBRARY.encode(words[5], add_special_tokens=False).ids


def test_batches_are_bounded_in_bytes(spark):
    """Ten thousand rows of long texts are not one batch, neither in the executor nor in its worker."""
    docs = spark.range(0, 3000, 1, 1).selectExpr("id AS doc_id", "repeat('abcd efgh ', 1000) AS text")
    coded = bpe.encode_decode(docs, PATH)
    sizes = docs.mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"n": [b.nbytes]}) for b in batches), "n long")
    assert max(r.n for r in sizes.collect()) < 2 * SLICE_BYTES
    assert coded.where("size(ids) > 0").count() == 3000


def test_memory_is_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 10)
    own = bpe.Encoder(bpe.read_vocabulary(PATH))
    text = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200))
    assert own.encode(text) == LIBRARY.encode(text, add_special_tokens=False).ids
    assert len(own.words) <= 10 and len(own.older) <= 10


def test_frames_with_nulls_repeats_and_extra_columns(spark):
    rows = [(1, None, "x"), (2, "", "y"), (None, "the the", None), (2, "", "y"), (3, "a <|endoftext|>", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = sorted(map(tuple, bpe.decode(bpe.encode(docs, PATH), PATH).select("doc_id", "text", "n_tokens", "ids", "decoded").collect()), key=str)
    want = []
    for a, t, x in rows:
        ids = LIBRARY.encode(t or "", add_special_tokens=False).ids
        want.append((a, t, x, ids, LIBRARY.decode(ids, skip_special_tokens=False)))
    assert got == sorted(want, key=str)
    both = bpe.encode_decode(docs, PATH)
    assert both.columns == ["doc_id", "n_tokens", "ids", "decoded"]
    assert sorted(map(tuple, both.collect()), key=str) == sorted(((a, *r) for a, _, *r in want), key=str)
    assert bpe.encode(docs.limit(0), PATH).count() == 0 == bpe.encode_decode(docs.limit(0), PATH).count()


def test_query_equals_the_library(spark, sf_dir):
    docs = pd.read_parquet(f"{sf_dir}/documents.parquet")
    want = {}
    for d, t in zip(docs.doc_id, docs.text.fillna("")):
        ids = LIBRARY.encode(t, add_special_tokens=False).ids
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), LIBRARY.decode(ids, skip_special_tokens=False))]
        want[d] = (len(ids), *sha)
    assert {r.doc_id: tuple(r)[1:] for r in op5_bpe(spark, sf_dir).collect()} == want
