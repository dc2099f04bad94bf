"""Whitening against a dense eigendecomposition of the whole table."""

import numpy as np
import pytest

from firmlens.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, x string, length int, id int, component string, n string"


def _frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1, 2, "c", "n") for i, v in rows], SCHEMA).repartition(4)


def _dense(vectors, k=16):
    x = np.floor(64 * np.asarray(vectors, np.float32).astype(float)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = (n * fit - sums) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:k]
    return x, n, sums, values[order], vectors[:, order], values.sum()


def _rows(out):
    return {(r.vec_id, r.component): r for r in out.collect()}


@pytest.mark.parametrize("dims, spread", [(20, 1.0), (60, 0.02)])
def test_components_match_a_dense_decomposition(spark, dims, spread):
    rng = np.random.default_rng(dims)
    data = (rng.standard_normal((700, dims)) * np.linspace(1, 1 + spread, dims)).tolist()
    data += data[:5] * 40  # repeated vectors count once in the fit
    out = _rows(whitening.whiten(_frame(spark, list(enumerate(data)))))
    x, n, sums, values, vectors, trace = _dense(data)
    assert len(out) == len(data) * 16
    got = np.array([[out[i, c].whitened for c in range(1, 17)] for i in range(len(data))])
    want = (n * x - sums) / n @ vectors / np.sqrt(values)
    assert np.allclose(got, want * np.sign((got * want).sum(axis=0)), atol=1e-8)
    assert [out[0, c].explained for c in range(1, 17)] == pytest.approx((values / trace).tolist(), rel=1e-10)
    deviation = ((n * x - sums) ** 2).sum(axis=1)
    assert all(int(out[i, 1].deviation) == deviation[i] and out[i, 1].n == n for i in range(len(data)))
    assert out[0, 1].identity_error < 1e-10


def test_filter_passes_end_on_hard_spectra():
    rng = np.random.default_rng(1)
    base = np.linalg.qr(rng.standard_normal((120, 120)))[0]
    for spectrum in (np.ones(120), np.r_[np.full(20, 2.0), np.linspace(1.9, 1.99, 100)], np.r_[1e6, np.linspace(1, 2, 119)], np.r_[np.ones(3), np.zeros(117)], np.zeros(120)):
        matrix, passes = (base * spectrum) @ base.T, []
        values, vectors = whitening.leading(lambda q: passes.append(1) or matrix @ q, 120, 16)
        assert np.allclose(values, np.sort(spectrum)[::-1][:16], atol=1e-10 * max(spectrum.max(), 1))
        assert np.abs(matrix @ vectors - vectors * values).max() <= 1e-10 * max(spectrum.max(), 1)


def test_odd_vectors(spark):
    good = [[0.1, 0.2, 0.3], [0.5, -0.2, 0.1], [0.0, 0.9, -0.4], [0.1, 0.2, 0.3]]
    odd = [None, [None, 1.0, 2.0], [float("nan"), 0.0, 0.0], [float("inf"), 0.0, 0.0], []]
    rows = [(k, v) for k, v in enumerate(good + odd)] + [(None, good[1]), (2, good[2])]
    out = whitening.whiten(_frame(spark, rows)).collect()
    assert sorted((r.vec_id is None, r.vec_id or 0) for r in out if r.component == 1) == [(False, 0), (False, 1), (False, 2), (False, 2), (False, 3), (True, 0)]
    assert {r.n for r in out} == {3}
    by = {r.component: r for r in out if r.vec_id == 0}
    assert by[1].whitened is not None and by[3].whitened is None and by[3].explained == 0.0  # three points span a plane


def test_alike_vectors_and_lengths(spark):
    out = whitening.whiten(_frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [1.0, 2.0, 3.0]), (4, [2.0, 2.0, 3.0])])).collect()
    alike = [r for r in out if r.vec_id in (1, 2)]
    assert len(alike) == 4 and all(r.whitened is None and r.explained is None and r.n == 1 and r.deviation == 0 for r in alike)
    longer = [r for r in out if r.vec_id == 3 and r.component == 1]
    assert abs(abs(longer[0].whitened) - 1) < 1e-12 and longer[0].n == 2
    assert whitening.whiten(_frame(spark, [(1, [1.0])]).limit(0)).count() == 0


def test_large_entries_stay_exact(spark):
    data = [[3e7, 1.0], [-3e7, 2.0], [3e38, 0.0]]
    out = [r for r in whitening.whiten(_frame(spark, list(enumerate(data)))).collect() if r.component == 1]
    clipped = [[min(64 * float(np.float32(c)), float(1 << 40)) for c in v] for v in data]
    x = [[int(np.floor(c)) + 1_000_000 for c in v] for v in clipped]
    sums = [sum(c) for c in zip(*x)]
    assert {r.vec_id: int(r.deviation) for r in out} == {i: sum((3 * c - s) ** 2 for c, s in zip(v, sums)) for i, v in enumerate(x)}
