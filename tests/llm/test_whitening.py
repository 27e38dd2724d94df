"""Whitening: eigenvectors, whitened rows and exact sums against numpy's dense solver."""

import numpy as np
import pytest

from claimweave.llm import whitening
from claimweave.llm.queries import QUERIES

SCHEMA = "vec_id bigint, embedding array<double>, label int, id string, deviation string, vector int"


def rows_of(x):
    return [(k, None if v is None else [None if e is None else float(e) for e in v], 0, "x", "y", 1) for k, v in enumerate(x)]


def frame(spark, rows, parts=3):
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def dense(x, wanted=8):
    """(n, S, values, vectors, trace) of the whole-number rows x."""
    x = np.array(x, dtype=object)
    n, total = len(x), x.sum(axis=0)
    y = ((x * n - total) / n).astype(float)
    value, vector = np.linalg.eigh(y.T @ y / n)
    return n, total, y, value[::-1][:wanted], vector[:, ::-1][:, :wanted], float(np.trace(y.T @ y / n))


def check(spark, x, scale=1024, shift=100_000, tolerance=1e-9):
    whole = [[int(np.floor(scale * e)) + shift for e in v] for v in x]
    n, total, y, value, vector, trace = dense(whole)
    model, rows = whitening.whiten(frame(spark, rows_of(x)))
    got = {r["id"]: r for r in rows.collect()}
    assert model.centre.n == n and list(model.centre.total) == list(total) and len(got) == n
    keep = len(model.values)
    assert np.allclose(model.values, value[:keep], rtol=1e-11) and abs(model.trace / trace - 1) < 1e-12
    assert model.identity_error < 1e-9
    z = y @ vector[:, :keep] / np.sqrt(value[:keep])
    own = np.array([got[k]["whitened"] for k in range(n)])
    sign = np.sign((own * z).sum(axis=0))
    assert np.abs(own * sign - z).max() < tolerance
    assert [got[k]["deviation"] for k in range(n)] == [int(sum((v * n - t) ** 2 for v, t in zip(r, total))) for r in whole]
    return model


@pytest.mark.parametrize("dims", [2, 8, 24, 25, 40, 90])
def test_equals_dense_solver(spark, dims):
    rng = np.random.default_rng(dims)
    check(spark, rng.normal(size=(300, dims)) * rng.uniform(0.5, 1.5, dims))


def test_flat_spectrum_needs_the_filter(spark):
    x = np.random.default_rng(3).normal(0, 0.1, size=(5000, 64))
    assert 1 < check(spark, x, tolerance=1e-7).rounds < 60


def test_decaying_spectrum(spark):
    x = np.random.default_rng(4).normal(size=(400, 50)) * 0.7 ** np.arange(50)
    check(spark, x)


def test_chebyshev_damps_the_interval():
    value = np.array([5.0, 4.0, 2.0, 1.5, 1.0, 0.5])
    times = lambda q: value[:, None] * q
    x = np.eye(6)
    y = np.diag(whitening.chebyshev(times, x, times(x), 0.5, 2.0, 5.0, 8))
    assert abs(y[0] - 1) < 1e-12 and np.abs(y[2:]).max() < 1e-5 < 1e-3 < y[1]
    # The same polynomial by numpy's Chebyshev series.
    t = lambda v: np.polynomial.chebyshev.chebval((v - 1.25) / 0.75, [0] * 8 + [1])
    assert np.allclose(y, t(value) / t(5.0), atol=1e-12)


def test_dropped_rows(spark):
    x = np.random.default_rng(6).normal(size=(50, 6)).tolist()
    rows = rows_of(x)
    bad = [None, [], [1.0, None, 0.0, 0.0, 0.0, 0.0], [float("nan")] * 6, [float("inf")] * 6, [1.0, 2.0]]
    rows += [(100 + k, v, 0, "x", "y", 1) for k, v in enumerate(bad)] + [(None, x[0], 0, "x", "y", 1), (3, x[3], 0, "x", "y", 1)]
    model, got = whitening.whiten(frame(spark, rows))
    ids = sorted((r["id"] is None, r["id"] or 0) for r in got.collect())
    assert model.centre.n == 52 and ids == sorted([(False, k) for k in range(50)] + [(False, 3), (True, 0)])
    assert model.identity_error < 1e-9


def test_nothing_to_whiten(spark):
    for rows in ([], rows_of([[1.0, 2.0]]), rows_of([[1.0, 2.0]] * 5), rows_of([None])):
        model, got = whitening.whiten(frame(spark, rows))
        assert len(model.values) == 0 and all(r["whitened"] == [] for r in got.collect())


def test_rank_below_the_components(spark):
    a = np.random.default_rng(7).integers(-9, 9, size=(60, 2)).astype(float)
    x = np.concatenate([a, a, -a, a, a], axis=1)
    model, got = whitening.whiten(frame(spark, rows_of(x)))
    assert len(model.values) == 2 and model.identity_error < 1e-9 and len(got.first()["whitened"]) == 2


def test_numbers_beyond_a_long(spark):
    x = [[2.0 ** 62 * k, 2.0 ** 61 * (k % 3), float(k)] for k in range(1, 7)]
    model, got = whitening.whiten(frame(spark, rows_of(x)))
    want = [sum((int(np.floor(1024 * v[j])) + 100_000) for v in x) for j in range(3)]
    assert list(model.centre.total) == want and model.identity_error < 1e-6
    assert all(r["deviation"] is None for r in got.collect())


def test_query(spark, tmp_path):
    x = np.random.default_rng(8).normal(size=(40, 10))
    frame(spark, rows_of(x)).write.parquet(f"{tmp_path}/embeddings.parquet")
    out = QUERIES["op13_embedding_whitening"](spark, str(tmp_path))
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    rows = out.collect()
    assert len(rows) == 40 * 8 and {r["component"] for r in rows} == set(range(1, 9)) and {r["n"] for r in rows} == {40}
    by = {r["component"]: r["explained"] for r in rows}
    assert all(by[k] > by[k + 1] > 0 for k in range(1, 8)) and sum(by.values()) < 1
