import numpy as np
import pytest
from pyspark.sql import functions as F

from reelstat.llm import whitening
from reelstat.llm.queries import op13_shifted_cholesky_whitening

SCHEMA = "vec_id long, embedding array<float>"


def brute(vectors, most=32):
    """(variances, shares, axes, whitened, deviations) by eigenvalues of the covariance."""
    x = np.array([[int(np.floor(64 * float(c))) + 1_000_000 for c in v] for v in vectors], dtype=object)
    n, sums = len(x), x.sum(axis=0)
    off = n * x - sums
    z = (off / n).astype(np.float64)
    values, axes = np.linalg.eigh(z.T @ z / n)
    values, axes = values[::-1], axes[:, ::-1]
    k = min(most, int((values > 1e-12 * values[0]).sum()))
    return values[:k], values[:k] / values.sum(), axes[:, :k], z @ axes[:, :k] / np.sqrt(values[:k]), (off**2).sum(axis=1)


def check(found, vectors, ids=None):
    values, shares, axes, white, deviations = brute(vectors)
    k, n = len(values), len(vectors)
    assert len(found) == n * k
    got = np.zeros((n, k))
    place = {i: at for at, i in enumerate(ids if ids is not None else range(n))}
    for r in found:
        at, c = place[r["vec_id"]], r["component"] - 1
        got[at, c] = r["whitened"]
        assert r["n"] == n and r["deviation"] == deviations[at]
        assert abs(r["explained"] / shares[c] - 1) < 1e-9 and r["identity_error"] < 1e-8
    for c in range(k):
        gap = np.abs(np.delete(values, c) - values[c]).min(initial=values[0]) / values[0]
        sign = np.sign(got[:, c] @ white[:, c])
        assert np.abs(sign * got[:, c] - white[:, c]).max() < 1e-9 / max(gap, 1e-6)
    assert np.abs(got.T @ got / n - np.eye(k)).max() < 1e-8


@pytest.mark.parametrize(("n", "size", "spread"), [(400, 64, 1.0), (60, 40, 300.0), (50, 3, 1e4), (2, 5, 1.0)])
def test_whitening_equals_eigenvectors(frame, n, size, spread):
    rng = np.random.default_rng(size)
    scales = np.geomspace(1, spread, size) / spread * 20
    vectors = (rng.normal(size=(n, size)) * scales @ np.linalg.qr(rng.normal(size=(size, size)))[0]).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    check(whitening.whitened(frame(SCHEMA, rows)).collect(), vectors)


def test_registered_query_equals_eigenvectors(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    found = op13_shifted_cholesky_whitening(spark, sf_dir).collect()
    check(found, [r["embedding"] for r in rows], [r["vec_id"] for r in rows])


def test_columns_without_variance_and_equal_columns(frame):
    rng = np.random.default_rng(1)
    own = rng.normal(size=(80, 4)).astype(np.float32)
    vectors = np.concatenate((own, own[:, :2], np.full((80, 2), 3, np.float32)), axis=1)
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    found = whitening.whitened(frame(SCHEMA, rows)).collect()
    assert {r["component"] for r in found} == {1, 2, 3, 4}
    check(found, vectors)


def test_first_pass_is_shifted_and_later_ones_orthogonalise():
    rng = np.random.default_rng(2)
    a = rng.normal(size=(500, 20)) * np.geomspace(1, 1e-9, 20)
    first = whitening.factor(a.T @ a, len(a), True)
    q = whitening.solved(a, first)
    assert np.allclose(q @ first, a, atol=1e-14)
    assert np.linalg.cond(q) < np.linalg.cond(a) / 100
    for _ in range(3):
        q = whitening.solved(q, whitening.factor(q.T @ q, len(q), False))
    assert np.abs(q.T @ q - np.eye(20)).max() < 1e-12


def test_edges(frame):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0]), (1, [3.0, 5.0]), (None, [2.0, -1.0]), (2, None), (3, []), (4, [1.0, None]),
        (5, [nan, 1.0]), (6, [1.0, inf]), (7, [1.0, 2.0, 3.0]), (1, [3.0, 5.0]),
    ]
    table = frame(SCHEMA, rows).withColumns({"n": F.lit("x"), "component": F.lit(0), "x": F.lit(1)})
    found = whitening.whitened(table).collect()
    assert sorted((r["vec_id"] is None, r["vec_id"] or 0, r["component"]) for r in found) == [
        (False, 0, 1), (False, 0, 2), (False, 1, 1), (False, 1, 1), (False, 1, 2), (False, 1, 2),
        (True, 0, 1), (True, 0, 2),
    ]
    assert {r["n"] for r in found} == {4}
    assert whitening.whitened(table.limit(0)).count() == 0
    assert whitening.whitened(frame(SCHEMA, [(1, [2.0, 3.0])] * 3)).count() == 0
    assert whitening.whitened(frame(SCHEMA, [(1, None), (2, [nan])])).count() == 0


def test_large_numbers(frame):
    rows = [(0, [1e30, 1.0]), (1, [-1e30, 2.0]), (2, [0.0, 4.0])]
    found = whitening.whitened(frame(SCHEMA, rows)).collect()
    assert {r["deviation"] is None for r in found if r["vec_id"] < 2} == {True}
    few = [(i, [float(i % 7) * 1e4, float(i % 3)]) for i in range(50)]
    check(whitening.whitened(frame(SCHEMA, few)).collect(), [v for _, v in few])


def test_ids_of_another_type(frame):
    rows = [("a", [1.0, 0.5]), ("b", [2.0, 0.25]), ("c", [4.0, 8.0])]
    found = whitening.whitened(frame("name string, v array<double>", rows), "name", "v", components=1)
    assert sorted(r["name"] for r in found.collect()) == ["a", "b", "c"]
