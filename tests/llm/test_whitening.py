"""Whitening against a dense eigendecomposition."""

import numpy as np
import pytest

from dbtelemetry.llm import whitening

SF_SMALL = "/root/testdata/sf0.001"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, n int, x int")


def dense(x, k):
    """Components, variances, trace of whole-number rows."""
    c = x - x.mean(axis=0)
    values, vectors = np.linalg.eigh(c.T @ c / len(x))
    return vectors[:, ::-1][:, :k], values[::-1][:k], values.sum()


def check(out, ids, x, k, gap=1e-9):
    vectors, values, trace = dense(x.astype(float), k)
    n, total = len(x), x.astype(object).sum(axis=0)
    got = {}
    for r in out:
        got.setdefault(r.vec_id, {})[r.component] = r
    assert sorted(got) == sorted(ids) and len(out) == len(ids) * k
    w = np.array([[got[i][j].whitened for j in range(1, k + 1)] for i in ids])
    want = (x - x.mean(axis=0)) @ vectors / np.sqrt(values)
    sign = np.sign((w * want).sum(axis=0))
    assert np.abs(w * sign - want).max() < 1e-7
    for i, row in zip(ids, x, strict=True):
        assert got[i][1].deviation == sum((n * int(a) - t) ** 2 for a, t in zip(row, total, strict=True)) and got[i][1].n == n
    assert np.allclose([got[ids[0]][j].explained for j in range(1, k + 1)], values / trace, rtol=1e-9)
    assert all(r.identity_error < 1e-9 for r in out) and len({r.identity_error for r in out}) == 1


def test_registered_whitening_against_dense(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select("vec_id", "embedding").collect()
    keep = [(r.vec_id, r.embedding) for r in rows if r.embedding is not None and all(v is not None and np.isfinite(v) for v in r.embedding)]
    x = np.floor(np.array([v for _, v in keep], np.float64) * 1024).astype(np.int64) + 100_000
    check(whitening.op13_embedding_whitening(spark, SF_SMALL).collect(), [i for i, _ in keep], x, 8)


@pytest.mark.parametrize("spread", [0.02, 0.5])
def test_decaying_spectrum(spark, spread):
    rng = np.random.default_rng(1)
    dims = 24
    basis, _ = np.linalg.qr(rng.standard_normal((dims, dims)))
    c = (rng.standard_normal((400, dims)) * np.exp(-spread * np.arange(dims)) @ basis * 3).astype(np.float32)
    c[50:150] = c[3]  # repeated rows
    rows = [(i, v.tolist()) for i, v in enumerate(c)]
    x = np.floor(c.astype(np.float64) * 1024).astype(np.int64) + 100_000
    check(whitening.whiten(frame(spark, rows).repartition(7)).collect(), [i for i, _ in rows], x, 8)


def test_repeated_eigenvalues_and_missing_directions(spark):
    # Corners of a cross: every eigenvalue is the same; a constant dimension has none.
    rows = []
    for d in range(4):
        for s in (-1.0, 1.0):
            v = [0.0] * 5
            v[d] = s
            rows.append((len(rows), v))
    out = whitening.whiten(frame(spark, rows)).collect()
    assert len(out) == 8 * 4 and all(abs(r.explained - 0.25) < 1e-12 and r.identity_error < 1e-9 for r in out)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    good = [(1, [1.0, 2.0]), (2, [2.0, 1.0]), (2, [2.0, 1.0]), (None, [-5.5, 0.25])]
    bad = [(3, None), (4, [nan, 1.0]), (5, [1.0, inf]), (6, [None, 1.0]), (7, []), (8, [1.0, 2.0, 3.0]), (9, [3e38, 0.0])]
    out = whitening.whiten(frame(spark, good + bad)).collect()
    assert sorted((str(r.vec_id), r.component) for r in out) == sorted((str(i), k) for i, _ in good for k in (1, 2))
    assert {r.n for r in out} == {4}
    assert whitening.whiten(frame(spark, [])).count() == 0
    assert whitening.whiten(frame(spark, bad[:2])).count() == 0
    assert whitening.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0  # no variance
    assert whitening.whiten(frame(spark, [(1, [2.0]), (2, [1.0])])).count() == 2


def test_exact_arithmetic_beyond_longs():
    x = np.array([[2**40, -(2**40)], [0, 5]])
    total = [2**40, 5 - 2**40]
    assert whitening._deviations(x, 2**22, total)[0] is None
    assert whitening._deviations(x[1:], 2, [0, 0]) == [100]
    c = whitening._centred(x, 2**30, [0, 0])
    assert c.dtype == float and c[0, 0] == 2.0**40
