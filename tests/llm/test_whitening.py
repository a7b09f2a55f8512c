"""Whitening against plain integer and fraction arithmetic."""

import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from dialtone.llm import whitening as W
from dialtone.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, x string, n int"


def frame(spark, vectors):
    return spark.createDataFrame([(k, v, 1, "x", 1) for k, v in enumerate(vectors)], SCHEMA)


def whole(v):
    return v is not None and len(v) and all(c is not None and math.isfinite(c) for c in v)


def plain_code(vectors):
    """(n, sums, covariance, x of each usable row) in integers and doubles."""
    x = {k: tuple(math.floor(float(np.float32(c)) * 64) + 1_000_000 for c in v) for k, v in enumerate(vectors) if whole(v)}
    fit = np.array(sorted(set(x.values())), dtype=object)
    n, sums = len(fit), fit.sum(axis=0)
    moved = fit * n - sums
    cov = np.array([[float(sum(moved[:, i] * moved[:, j])) for j in range(fit.shape[1])] for i in range(fit.shape[1])]) / n ** 3
    return n, sums, cov, x


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 5), st.integers(1, 150), st.integers(0, 60), st.randoms(use_true_random=False))
def test_popcounts_equal_products(dims, rows, bits, r):
    y = np.array([[r.randint(-2 ** bits, 2 ** bits) for _ in range(dims)] for _ in range(rows)], dtype=np.int64)
    sums, products = W.cross_products(y)
    wide = y.astype(object)
    assert list(sums) == list(wide.sum(axis=0))
    assert (products == wide.T @ wide).all()


def test_limbs_keep_signs():
    for number in (0, 1, -1, 2 ** 150 + 7, -2 ** 150 - 7):
        assert sum(x << W.LIMB * k for k, x in enumerate(W._limbs(number))) == number


def test_small_eigenvalues_beside_large_ones():
    rng = np.random.default_rng(3)
    q, _ = np.linalg.qr(rng.normal(size=(12, 12)))
    wanted = np.array([10.0 ** -k for k in range(12)], dtype=np.longdouble)
    v = (q.astype(np.longdouble) * wanted) @ q.T.astype(np.longdouble)
    values, rows = W.eigenvectors((v + v.T) / 2, 8)
    assert np.allclose(values.astype(float), wanted[:8].astype(float), rtol=1e-5)
    covariance = (rows @ v @ rows.T) / np.sqrt(np.outer(values, values))
    assert np.abs(covariance - np.eye(8)).max() < 1e-4


def check(spark, vectors, k=16):
    n, sums, cov, x = plain_code(vectors)
    df = frame(spark, vectors)
    model = W.fit(df, k=k)
    assert model.n == n and list(model.sums) == list(sums)
    values = np.linalg.eigvalsh(cov)[::-1][:k]
    assert np.allclose(model.eigenvalues.astype(float), values, rtol=1e-9, atol=1e-9 * values[0])
    assert np.allclose(model.explained, values / np.trace(cov), rtol=1e-6, atol=1e-12)
    got = W.whiten(df, model).collect()
    assert sorted(r["vec_id"] for r in got) == sorted(x)
    for r in got:
        moved = [n * c - s for c, s in zip(x[r["vec_id"]], sums)]
        assert int(r["deviation"]) == sum(m * m for m in moved)
        for c, value in enumerate(r["whitened"]):
            if model.eigenvalues[c] > 0:
                axis = model.components[c].astype(float)
                assert value == pytest.approx(float(np.dot(np.array(moved, dtype=float) / n, axis)) / math.sqrt(values[c]), rel=1e-6, abs=1e-6)
            else:
                assert value is None
    return model, got


def test_rows_equal_plain_code(spark):
    r = random.Random(1)
    vectors = [[r.gauss(0, 1) * s for s in (1, 2, 0.1, 4, 1, 1)] for _ in range(80)]
    vectors += [vectors[0], vectors[0], None, [1.0, None, 0.0, 0.0, 0.0, 0.0], [float("nan")] * 6, [float("inf")] + [0.0] * 5]
    model, got = check(spark, vectors)
    assert len(got) == 82 and len(got[0]["whitened"]) == 6 and model.identity_error < 1e-9
    assert check(spark, vectors, k=2)[0].components.shape == (2, 6)


def test_without_variance(spark):
    model, got = check(spark, [[1.0, float(k), 2.0 * k] for k in range(6)] * 2)  # rank 1, each vector twice
    assert [v is None for v in got[0]["whitened"]] == [False, True, True] and model.identity_error < 1e-9
    df = frame(spark, [[1.0, 2.0]] * 3)
    model = W.fit(df)
    assert model.n == 1 and model.identity_error is None and model.explained == (0.0, 0.0)
    assert [r["whitened"] for r in W.whiten(df, model).collect()] == [[None, None]] * 3


def test_large_entries_and_odd_rows(spark):
    r = random.Random(4)
    vectors = [[r.choice((1e9, -1e9, 1e-3, 5.0)), r.uniform(-1e15, 1e15), r.uniform(-1, 1)] for _ in range(50)]
    vectors += [[1e30, 0.0, 0.0], [1.0], [], [1.0, 2.0]]  # too large for an integer; other lengths
    df = frame(spark, vectors)
    model = W.fit(df)
    got = W.whiten(df, model).collect()
    assert model.dims == 3 and len(got) == 50 and sorted(r["vec_id"] for r in got) == list(range(50))
    n, sums, _, x = plain_code(vectors[:50])
    assert (model.n, list(model.sums)) == (n, list(sums))
    for r in got:
        assert int(r["deviation"]) == sum((n * c - s) ** 2 for c, s in zip(x[r["vec_id"]], sums))
    assert model.identity_error < 1e-4
    empty = frame(spark, [None, []])
    assert W.whiten(empty, W.fit(empty)).count() == 0 and W.whiten(df.where("false"), W.fit(df.where("false"))).count() == 0


def test_query(spark, sf_dir):
    rows = QUERIES["op11_whitening"](spark, sf_dir)
    vectors = [r["embedding"] for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").orderBy("vec_id").collect()]
    n, sums, cov, x = plain_code(vectors)
    values = np.linalg.eigvalsh(cov)[::-1]
    got = rows.collect()
    assert len(got) == 16 * len(x) and rows.columns[:7] == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    square = dict.fromkeys(range(1, 17), 0.0)
    for r in got:
        assert r["n"] == n and r["identity_error"] < 1e-9
        assert r["explained"] == pytest.approx(values[r["component"] - 1] / np.trace(cov), rel=1e-9)
        square[r["component"]] += r["whitened"] ** 2
    if len(set(x.values())) == len(x):
        assert all(v / n == pytest.approx(1, rel=1e-9) for v in square.values())
