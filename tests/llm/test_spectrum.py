from fractions import Fraction
from math import floor

import numpy as np
import pytest

from cartlens.llm import queries, spectrum


def covariance(rng, n, d):
    x = rng.standard_normal((n, d)) * np.linspace(1, 3, d)
    return np.cov(x.T, bias=True).reshape(d, d)


@pytest.mark.parametrize("seed", range(8))
def test_inertia_counts(seed):
    rng = np.random.default_rng(seed)
    m = rng.standard_normal((9, 9))
    m = m + m.T
    if seed % 2:
        np.fill_diagonal(m, 0.0)  # needs pivots of two rows
    values = np.linalg.eigvalsh(m)
    assert spectrum.inertia(m) == ((values < 0).sum(), 0, (values > 0).sum())
    assert spectrum.inertia(np.zeros((3, 3))) == (0, 3, 0)


@pytest.mark.parametrize("d,k", [(1, 8), (5, 8), (30, 8), (64, 3)])
def test_leading_against_full_decomposition(d, k):
    v = covariance(np.random.default_rng(d), 400, d)
    values, vectors = spectrum.leading(v, k)
    expected = np.linalg.eigvalsh(v)[::-1][:k]
    assert np.allclose(values, expected, rtol=1e-13)
    assert np.allclose(v @ vectors, vectors * values, atol=1e-13 * values[0])
    assert np.allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-10)


@pytest.mark.parametrize("diagonal", [[5, 5, 5, 2, 2, 1, 1, 1, 1, 1], [3] * 12, [4, 4 + 1e-9, 1, 0, 0], [1, 1e-3, 1e-14, 0], [7, 7 - 1e-12, 7]])
def test_equal_close_and_zero_eigenvalues(diagonal):
    rng = np.random.default_rng(1)
    q = np.linalg.qr(rng.standard_normal((len(diagonal),) * 2))[0]
    v = q @ np.diag(np.array(diagonal, float)) @ q.T
    v = (v + v.T) / 2
    values, vectors = spectrum.leading(v, 8)
    expected = sorted((x for x in diagonal if x > 1e-10 * max(diagonal)), reverse=True)[:8]
    assert np.allclose(values, expected, rtol=1e-9)
    assert np.allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-9)
    assert np.allclose(v @ vectors, vectors * values, atol=1e-9)


def brute(rows):
    """Exact deviations and the spectrum, from whole numbers and fractions."""
    x = [(i, [floor(1024 * float(c)) + 100_000 for c in e]) for i, e in rows]
    n, d = len(x), len(x[0][1])
    s = [sum(e[k] for _, e in x) for k in range(d)]
    deviations = sorted((i, sum((n * e[k] - s[k]) ** 2 for k in range(d))) for i, e in x)
    v = np.array([[float(Fraction(sum((n * e[a] - s[a]) * (n * e[b] - s[b]) for _, e in x), n**3)) for b in range(d)] for a in range(d)])
    return n, deviations, v, {i: np.array([float(Fraction(n * e[k] - s[k], n)) for k in range(d)]) for i, e in x}


def check(got, rows):
    n, deviations, v, centred = brute(rows)
    values = np.linalg.eigvalsh(v)[::-1]
    k = min(8, int((values > 1e-10 * values[0]).sum()))
    assert {r["n"] for r in got} == {n}
    for c in range(1, k + 1):
        mine = [r for r in got if r["component"] == c]
        assert sorted((r["vec_id"], int(r["deviation"])) for r in mine) == deviations
        assert all(abs(r["explained"] - values[c - 1] / np.trace(v)) < 1e-10 for r in mine)
    assert len(got) == k * n
    ids = sorted(centred)
    z = {(r["vec_id"], r["component"]): r["whitened"] for r in got}
    z = np.array([[z[i, c] for c in range(1, k + 1)] for i in ids])
    errors = {r["identity_error"] for r in got}
    assert len(errors) == 1 and max(errors) <= 1e-4
    if n > k:
        assert abs(np.abs(z.T @ z / n - np.eye(k)).max() - max(errors)) < 1e-7
    _, turn = np.linalg.eigh(v)
    y = np.array([centred[i] for i in ids]) @ turn[:, ::-1][:, :k] / np.sqrt(values[:k])
    gaps = np.diff(values[: k + 1]) if len(values) > k else np.r_[np.diff(values[:k]), -values[k - 1]]
    for c in range(k):  # sign is free; a vector is only fixed where its value stands alone
        if min(-gaps[c], -gaps[c - 1] if c else np.inf) > 1e-5 * values[0]:
            assert np.allclose(z[:, c], np.sign(z[:, c] @ y[:, c]) * y[:, c], atol=1e-6)


def test_query_against_fractions(spark, folder):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    check(queries.op11_whitening(spark, folder).collect(), rows)


def test_faulty_and_odd_vectors(spark):
    rng = np.random.default_rng(4)
    good = [(k, [float(c) for c in rng.standard_normal(4).astype(np.float32)]) for k in range(40)]
    bad = [(100, None), (101, [1.0, None, 2.0, 3.0]), (102, [float("nan"), 1.0, 1.0, 1.0]), (103, [1.0, float("-inf"), 0.0, 0.0]),
           (104, [1.0, 2.0]), (105, []), (106, [1.0] * 7)]
    frame = spark.createDataFrame([(i, e, 1, "x") for i, e in good + bad], "vec_id bigint, embedding array<float>, n int, Component string")
    check(spectrum.whiten(frame).collect(), good)
    small = spectrum.whiten(spark.createDataFrame(good, "vec_id bigint, embedding array<double>"), components=2)
    assert small.count() == 80


def test_large_entries_stay_exact(spark):
    rows = [(k, [float(k * 10_000_000 + (k * k) % 7), float((k % 5) * 30_000_000)]) for k in range(50)]
    got = spectrum.whiten(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()
    assert sorted((r["vec_id"], int(r["deviation"])) for r in got if r["component"] == 1) == brute(rows)[1]
    with pytest.raises(Exception, match="beyond"):
        spectrum.whiten(spark.createDataFrame([(1, [1e300])], "vec_id bigint, embedding array<double>"))


def test_too_little_to_whiten(spark):
    kind = "vec_id bigint, embedding array<float>"
    for rows in ([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None)], [(1, [])]):
        out = spectrum.whiten(spark.createDataFrame(rows, kind))
        assert out.count() == 0 and out.columns[0] == "vec_id"
    flat = [(None, [float(k), 2.0 * k, 5.0]) for k in range(9)] * 2
    out = spectrum.whiten(spark.createDataFrame(flat, kind)).collect()
    assert len(out) == 18 and {r["component"] for r in out} == {1} and abs(out[0]["explained"] - 1) < 1e-12
