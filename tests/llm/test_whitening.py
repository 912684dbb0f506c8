import math

import numpy as np
import pytest

from winnow.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>, label int"


def exact(vectors):
    """x as integers, and eigenvalues and vectors of the dense covariance."""
    x = np.array([[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in vectors], object)
    y = (x - (x.sum(0) // len(x))).astype(float)
    y -= y.mean(0)
    values, turn = np.linalg.eigh(y.T @ y / len(y))
    return x, y, values[::-1], turn[:, ::-1]


def run(spark, tmp_path, rows):
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' as x", "'y' as _v", "1 as n")
    df.repartition(4).write.mode("overwrite").parquet(f"{tmp_path}/embeddings.parquet")
    return W.op13_embedding_whitening(spark, str(tmp_path))


@pytest.mark.parametrize("d, spread", [(64, 0.0), (100, 0.5), (20, 1.0)])
def test_query_equals_a_dense_eigensolution(spark, tmp_path, d, spread):
    rng = np.random.default_rng(d)
    vecs = np.float32(rng.standard_normal((500, d)) * np.exp(-spread * np.arange(d) / 10) + 3)
    rows = [(i, [float(c) for c in v], 0) for i, v in enumerate(vecs)]
    got = run(spark, tmp_path, rows).toPandas()
    x, y, values, turn = exact(vecs)
    k = min(32, d)
    assert len(got) == 500 * k and set(got["component"]) == set(range(1, k + 1)) and set(got["n"]) == {500}
    assert got["identity_error"].nunique() == 1 and got["identity_error"][0] < 1e-9
    white = got.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    want = y @ turn[:, :k] / np.sqrt(values[:k])
    sign = np.sign((white * want).sum(0))
    assert np.abs(white * sign - want).max() < 1e-7
    explained = got.groupby("component")["explained"].first().to_numpy()
    assert np.allclose(explained, values[:k] / values.sum(), rtol=1e-9)
    n, sums = 500, x.sum(0)
    deviation = got.groupby("vec_id")["deviation"].first()
    assert all(int(deviation[i]) == sum((n * a - s) ** 2 for a, s in zip(x[i], sums)) for i in range(500))


@pytest.mark.parametrize("kind", ["flat", "falling", "clustered", "equal", "low rank"])
def test_subspace_is_certified_for_every_kind_of_spectrum(kind):
    rng = np.random.default_rng(3)
    d, k = 300, 32
    values = {"flat": 1 + 0.05 * rng.random(d), "falling": 1.0 / (1 + np.arange(d)), "clustered": np.r_[np.full(40, 5.0), np.full(d - 40, 1.0)],
              "equal": np.full(d, 2.0), "low rank": np.r_[np.arange(10) + 1.0, np.zeros(d - 10)]}[kind]
    turn = np.linalg.qr(rng.standard_normal((d, d)))[0]
    v = (turn * values) @ turn.T
    calls = []
    got, vectors, residual = W.subspace(lambda q: (calls.append(q.shape), v @ q)[1], d, k)
    assert np.allclose(got, np.sort(values)[::-1][:k], atol=1e-10) and residual <= W.GOOD * got[0]
    assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-12 and len(calls) < 400


def test_edges(spark, tmp_path):
    bad = [(1, None, 0), (2, [1.0, None], 0), (3, [1.0, float("nan")], 0), (4, [float("inf"), 1.0], 0), (5, [1.0], 0), (6, [], 0)]
    good = [(7, [0.5, 1.0], 0), (7, [0.5, 1.0], 0), (None, [0.25, -1.0], 0)]
    rows = run(spark, tmp_path, bad + good).collect()
    assert len(rows) == 6 and {r["n"] for r in rows} == {3} and {r["vec_id"] for r in rows} == {7, None}
    assert all(r["whitened"] is not None for r in rows if r["component"] == 1)
    assert all(r["whitened"] is None and abs(r["explained"]) < 1e-12 for r in rows if r["component"] == 2)
    one = run(spark, tmp_path, bad[:4] + good[:1]).collect()
    assert [(r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in one] == [(0, None, None, None)] * 2
    assert run(spark, tmp_path, bad[:4]).count() == 0 and run(spark, tmp_path, bad[:0]).count() == 0
    huge = [(1, [3e38, 1.0], 0), (2, [-3e38, 2.0], 0), (3, [1.0, 3.0], 0)]
    found = run(spark, tmp_path, huge).collect()
    assert len(found) == 6 and {r["deviation"] for r in found} <= {None, *range(10**6)}


def test_partial_sums_are_added_in_a_tree(spark, monkeypatch):
    monkeypatch.setattr(W, "FAN_IN", 2)
    rows = W.integers(spark.range(100).selectExpr("id as vec_id", "array(cast(id as float), cast(id * id as float)) as embedding").repartition(9))
    assert W._sums(rows) == (100, [64 * sum(range(100)) + 10**8, 64 * sum(i * i for i in range(100)) + 10**8])


def test_wide_deviations_are_exact():
    x, r = np.array([[1 << 40, -5], [3, 4]], np.int64), np.array([2, 2], np.int64)
    want = [sum((10**9 * (int(a) - 2) - b) ** 2 for a, b in zip(row, (7, -9))) for row in x]
    assert W._deviations(x, r, 10**9, [7, -9]) == [None if w >= 1 << 63 else w for w in want]
