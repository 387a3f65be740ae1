import math

import numpy as np
import pandas as pd
import pytest

from tidemark.llm import whitening
from tidemark.llm.queries import op11_whitening


def spectrum(rng, values):
    q, _ = np.linalg.qr(rng.standard_normal((len(values), len(values))))
    return (q * np.array(values)) @ q.T


@pytest.mark.parametrize("values", [
    [9, 5, 4, 3, 2, 1], [3, 3, 3, 1, 1, 0.5], [1] * 8, [5, 5 - 1e-9, 5 - 2e-9, 2, 1], [7, 1e-3, 1e-6, 0, 0], [4], [0, 0, 0],
    [100, *np.linspace(60, 40, 60)], [2, 1 + 1e-13, 1, 1 - 1e-13, 0.1],
])
def test_leading_pairs_of_known_spectra(values):
    rng = np.random.default_rng(len(values))
    a = spectrum(rng, values) if len(values) > 1 else np.array([[float(values[0])]])
    a = (a + a.T) / 2
    want = sorted((v for v in values if v > 0), reverse=True)[:32]
    got, vectors = whitening.leading(a, 32)
    assert np.allclose(got, want, rtol=0, atol=1e-12 * max(values, default=1))
    assert np.allclose(vectors @ vectors.T, np.eye(len(got)), atol=1e-13)
    assert np.abs(a @ vectors.T - vectors.T * got).max(initial=0) <= 1e-11 * max(values)


def test_inertia_counts_and_solutions():
    rng = np.random.default_rng(3)
    for n in (1, 2, 3, 9, 30):
        for _ in range(20):
            a = rng.integers(-3, 4, (n, n)).astype(float)
            a = a + a.T - 2 * np.diag(np.diag(a)) if n > 1 and rng.random() < 0.5 else a + a.T  # zero diagonals too
            e = np.linalg.eigvalsh(a)
            shift = float(rng.normal())
            f = whitening.Factors(a - shift * np.eye(n))
            assert f.negative() == int((e < shift).sum())
            b = rng.standard_normal(n)
            if np.abs(e - shift).min() > 1e-3:
                assert np.allclose((a - shift * np.eye(n)) @ f.solve(b, 1e-300), b, atol=1e-8)


def slow(rows):
    """rows: (vec_id, list or None); the query's columns by plain numpy and whole numbers of Python."""
    rows = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(64 * float(c)) + 1_000_000 for c in v] for _, v in rows]
    n, s = len(x), [sum(c) for c in zip(*x)]
    centred = np.array([[(n * a - b) / n for a, b in zip(v, s)] for v in x])
    e, u = np.linalg.eigh(centred.T @ centred / n)
    e, u = e[::-1], u[:, ::-1]
    keep = [j for j in range(min(32, len(e))) if e[j] > 1e-9 * e[0]] if e[0] > 0 else []
    dev = [sum((n * a - b) ** 2 for a, b in zip(v, s)) for v in x]
    return {(rows[r][0], j + 1): (n, dev[r], centred[r] @ u[:, j] / math.sqrt(e[j]), e[j] / e.sum()) for r in range(n) for j in keep}


def compare(got, want):
    assert sorted((r.vec_id, r.component) for r in got) == sorted(want)
    sign = {}
    for r in got:
        n, dev, white, share = want[r.vec_id, r.component]
        assert (r.n, r.deviation) == (n, dev) and r.explained == pytest.approx(share, rel=1e-9) and r.identity_error < 1e-9
        if abs(white) > 1e-3:
            assert sign.setdefault(r.component, np.sign(white * r.whitened)) == np.sign(white * r.whitened)
        assert abs(r.whitened) == pytest.approx(abs(white), abs=1e-6)


def test_query_equals_brute_force(spark, sf_dir):
    table = pd.read_parquet(f"{sf_dir}/embeddings.parquet")
    compare(op11_whitening(spark, sf_dir).collect(), slow([(i, list(map(float, v))) for i, v in zip(table.vec_id, table.embedding)]))


def written(spark, tmp_path, rows, kind="float", extra=""):
    spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>{extra}").write.parquet(f"{tmp_path}/embeddings.parquet")
    return op11_whitening(spark, str(tmp_path)).collect()


def test_dropped_rows_copies_and_clashing_columns(spark, tmp_path):
    rng = np.random.default_rng(1)
    rows = [(i, [float(np.float32(c)) for c in rng.standard_normal(5) * [3, 2, 1, 0.5, 0.3]]) for i in range(60)]
    rows += [(100 + i, rows[0][1]) for i in range(400)] + [(7, rows[3][1])] * 2
    bad = [(900, None), (901, []), (902, [1.0, None, 1.0, 1.0, 1.0]), (903, [1.0, math.nan, 1.0, 1.0, 1.0]), (904, [math.inf] * 5)]
    got = written(spark, tmp_path, [(*r, 1, 2.0, "w") for r in rows + bad], extra=", component int, n double, whitened string")
    want = slow(rows)
    assert len(got) == len(rows) * 5
    compare({(r.vec_id, r.component): r for r in got}.values(), want)


def test_degenerate_tables(spark, tmp_path):
    assert written(spark, tmp_path / "none", []) == []
    assert written(spark, tmp_path / "bad", [(1, None), (2, [])]) == []
    assert written(spark, tmp_path / "one", [(1, [1.0, 2.0])]) == []
    assert written(spark, tmp_path / "same", [(i, [1.0, 2.0]) for i in range(9)]) == []
    line = written(spark, tmp_path / "line", [(i, [float(i), 2.0 * i, 1.0]) for i in range(9)])
    assert {r.component for r in line} == {1} and all(r.explained == pytest.approx(1) for r in line)
    big = [(i, [1e8 * i, 1.0 - i % 2]) for i in range(3)]
    frame = spark.createDataFrame(big, "vec_id long, embedding array<double>")
    got = whitening.whiten(frame, whitening.fit(frame)).collect()  # beyond a long
    assert {int(r.deviation) for r in got} == {r[1] for r in slow(big).values()} and max(int(r.deviation) for r in got) > 2**63
    huge = spark.createDataFrame([(1, [1e300]), (2, [0.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="too large for a whole number"):
        whitening.fit(huge)
    with pytest.raises(Exception, match="differ in length"):
        written(spark, tmp_path / "ragged", [(1, [1.0]), (2, [1.0, 2.0])])


def test_moments_do_not_depend_on_the_cut():
    rng = np.random.default_rng(2)
    x = rng.integers(-300, 300, (1000, 4))
    whole, parts = whitening.Moments(), whitening.Moments()
    whole.add(x.astype(float), x)
    for i in range(0, 1000, 7):
        parts.add(x[i : i + 7].astype(float), x[i : i + 7])
    assert parts.totals == whole.totals == x.sum(axis=0).tolist()
    assert np.allclose(parts.products / 1000, np.cov(x.T, bias=True)) and np.allclose(whole.products, parts.products)
