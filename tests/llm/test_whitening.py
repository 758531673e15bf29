"""Whitening against numpy's eigenvectors, and the defined cases."""

import numpy as np
import pytest

from airwave.llm import whitening
from airwave.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = "vec_id long, embedding array<double>, x int, n int"


def matrices():
    rng = np.random.default_rng(1)
    q = np.linalg.qr(rng.normal(size=(40, 40)))[0]
    x = rng.normal(size=(300, 64)) * np.linspace(1, 5, 64)
    yield "spread", x.T @ x
    yield "equal", np.eye(20)
    yield "clusters", q @ np.diag([5.0] * 10 + [3.0] * 20 + [1.0] * 10) @ q.T
    yield "falling", q @ np.diag(10.0 ** -np.arange(40)) @ q.T
    yield "few", x[:5].T @ x[:5]
    yield "near", np.array([[0, 0, 0], [0, 1e8, 1e-3], [0, 1e-3, 1e8]])
    yield "one", np.array([[2.0]])
    yield "none", np.zeros((4, 4))


@pytest.mark.parametrize("name,v", list(matrices()))
def test_leading_eigenvectors(name, v):
    e, u = whitening.leading(v, 16)
    true = np.linalg.eigvalsh(v)[::-1]
    size = abs(true[0])
    assert len(e) == min(16, (true > 1000 * len(v) * 2.3e-16 * size).sum()) or name == "falling"
    assert np.allclose(e, true[: len(e)], rtol=0, atol=1e-13 * size)
    assert np.allclose(v @ u, u * e, rtol=0, atol=1e-13 * size) and np.allclose(u.T @ u, np.eye(len(e)), atol=1e-13)


def test_counts_are_the_eigenvalues_above():
    rng = np.random.default_rng(2)
    v = rng.normal(size=(30, 30))
    v += v.T
    diagonal, off, q = whitening.tridiagonal(v)
    whole = np.diag(diagonal) + np.diag(off, 1) + np.diag(off, -1)
    assert np.allclose(q @ whole @ q.T, v)
    values = np.linalg.eigvalsh(v)
    for shift in [*rng.normal(size=200) * 8, 0.0]:
        factors = whitening.Factors(diagonal, off, shift)
        assert factors.above() == (values > shift).sum()
        x = rng.normal(size=30)
        assert np.allclose((whole - shift * np.eye(30)) @ factors.solve(x), x, atol=1e-6)


def test_query_equals_numpy(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    x = np.floor(64 * np.array([r["embedding"] for r in rows], float)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(0)
    centred = (n * fit - s).astype(float) / n
    v = centred.T @ centred / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1], u[:, ::-1]
    got = QUERIES["op13_whitening"](spark, SF).toPandas()
    assert len(got) == 16 * len(rows) and set(got["n"]) == {n} and got["identity_error"].max() < 1e-12
    by_id = {r["vec_id"]: i for i, r in enumerate(rows)}
    for k, own in got.groupby("component"):
        at = [by_id[i] for i in own["vec_id"]]
        want = (n * x[at] - s).astype(float) / n @ u[:, k - 1] / np.sqrt(e[k - 1])
        sign = np.sign(want @ own["whitened"])
        assert np.allclose(sign * own["whitened"], want, atol=1e-9) and np.allclose(own["explained"], e[k - 1] / np.trace(v))
        assert own["deviation"].tolist() == ((n * x[at] - s) ** 2).sum(1).tolist()


def whitened(spark, rows):
    df = whitening.vectors(spark.createDataFrame([(i, v, 1, 1) for i, v in rows], COLUMNS))
    return whitening.whitened(df, whitening.fit(df)).collect()


def test_defined_cases(spark):
    usable = [(1, [1.0, 2.0]), (2, [2.0, 1.0]), (3, [5.0, 5.0]), (3, [5.0, 5.0]), (None, [0.0, 7.0])]
    odd = [(4, None), (5, []), (6, [None, 1.0]), (7, [float("nan"), 1.0]), (8, [float("inf"), 1.0]), (9, [1.0]), (10, [1e300, 1.0])]
    got = whitened(spark, usable + odd)
    assert sorted((r["vec_id"] or 0, r["component"]) for r in got) == sorted(
        (i, c) for i in (0, 1, 2, 3, 3) for c in (1, 2)
    )
    assert {r["n"] for r in got} == {4}
    assert whitened(spark, odd[:5]) == [] and whitened(spark, []) == []
    assert whitened(spark, [(1, [1.0, 2.0])] * 3) == []
    far = whitened(spark, [(i, [2.0**50 * i, float(i % 2)]) for i in range(9)])  # sums of squares beyond a long
    assert {r["deviation"] for r in far if r["vec_id"] != 4} == {None} and len(far) == 9
