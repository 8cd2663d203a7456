"""op11 against a full eigendecomposition, and odd vectors."""

import math
import random

import numpy as np
import pytest

from quayside.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, whitening int, deviation string"


def vectors(n=400, dims=40, seed=3):
    rng = np.random.default_rng(seed)
    mix = rng.standard_normal((dims, dims)) * np.linspace(2, 0.05, dims)
    return (rng.standard_normal((n, dims)) @ mix * 0.3).astype(np.float32)


def frame(spark, found):
    return spark.createDataFrame(
        [(k, None if v is None else [None if c is None else float(c) for c in v], 1, "x")
         for k, v in found], SCHEMA).repartition(5)


def brute(rows, components=16):
    """vec_id -> (deviation, whitened up to signs), and the shares."""
    whole = {k: [math.floor(64 * float(c)) + 1_000_000 for c in v] for k, v in rows}
    fit = np.array(sorted(set(map(tuple, whole.values()))), dtype=object)
    n, sums = len(fit), fit.sum(axis=0)
    centred = (fit * n - sums).astype(float) / n
    cov = centred.T @ centred / n
    e, v = np.linalg.eigh(cov)
    e, v = e[::-1][:components], v[:, ::-1][:, :components]
    out = {}
    for k, x in whole.items():
        d = [n * a - s for a, s in zip(x, sums)]
        out[k] = (sum(a * a for a in d), (np.array(d, float) / n) @ v / np.sqrt(e))
    return n, out, e / np.trace(cov)


def held(rows):
    got = {}
    for r in rows:
        got.setdefault(r.vec_id, []).append(r)
    return got


def test_equals_a_full_decomposition(spark):
    found = vectors()
    data = [(k, v) for k, v in enumerate(found)] + [(1_000 + k, found[7]) for k in range(300)]
    rows = whitening.op11(frame(spark, data)).collect()
    n, expected, shares = brute(data)
    assert len(rows) == 16 * len(data)
    signs = None
    for k, each in held(rows).items():
        each.sort(key=lambda r: r.component)
        assert [r.component for r in each] == list(range(1, 17))
        assert {r.n for r in each} == {n} and {r.deviation for r in each} == {expected[k][0]}
        values = np.array([r.whitened for r in each])
        signs = np.sign(values * expected[k][1]) if signs is None else signs  # those of one row
        assert np.allclose(values, expected[k][1] * signs, atol=1e-9)
        assert np.allclose([r.explained for r in each], shares, rtol=1e-9)
        assert each[0].identity_error < 1e-10


def test_odd_vectors_go_and_repeated_rows_are_fitted_once(spark):
    odd = [None, [], [1.0, None], [math.nan, 0.0], [math.inf, 0.0], [0.0, -math.inf],
           [1.0, 2.0, 3.0]]
    rng = random.Random(4)
    fine = [[rng.gauss(0, 1), rng.gauss(0, 3)] for _ in range(30)]
    data = list(enumerate(fine)) + [(None, fine[0]), (5, fine[5])]
    rows = whitening.op11(frame(spark, data + [(900 + k, v) for k, v in enumerate(odd)])).collect()
    assert len(rows) == 2 * len(data) and {r.n for r in rows} == {30}
    assert not {r.vec_id for r in rows} & set(range(900, 910))
    n, expected, _ = brute(list(enumerate(np.array(fine, np.float32))))
    assert all(r.deviation == expected[r.vec_id][0] for r in rows if r.vec_id is not None)


def test_tables_without_variance_have_no_components(spark):
    for data in ([], [(1, None)], [(1, [0.5, 0.5])], [(k, [0.5, 0.25]) for k in range(9)]):
        none = whitening.op11(frame(spark, data))
        assert none.collect() == []
        assert none.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained",
                                "identity_error"]


def test_directions_without_variance_are_no_components(spark):
    data = [(k, [k / 8, k / 8, float(k % 3), 1.0]) for k in range(20)]
    rows = whitening.op11(frame(spark, data)).collect()
    assert {r.component for r in rows} == {1, 2}
    assert sum(r.explained for r in rows if r.vec_id == 1) == pytest.approx(1)


def test_keeps_other_columns_and_replaces_its_own(spark):
    data = list(enumerate(vectors(60, 6)))
    model = whitening.fit(frame(spark, data), components=3)
    got = model.apply(frame(spark, data))
    assert got.columns == ["vec_id", "embedding", "deviation", "whitening"]
    assert {len(r.whitening.whitened) for r in got.collect()} == {3}


def test_wide_deviations_are_exact_or_null():
    sums, n = [5, -7], 3
    x = np.array([[1 << 40, 3], [1, 2], [1 << 33, -(1 << 33)], [1 << 30, 1 << 29]], np.int64)
    exact = [sum((n * int(v) - s) ** 2 for v, s in zip(r, sums)) for r in x]
    assert whitening._deviations(x, n, sums).to_pylist() == [
        e if e < 1 << 63 else None for e in exact]


def test_flat_and_steep_spectra_converge(spark):
    rng = np.random.default_rng(8)
    steep = rng.standard_normal((300, 50)) * np.logspace(4, 0, 50)
    flat = rng.standard_normal((300, 50))
    for found in (steep, flat):
        model = whitening.fit(frame(spark, list(enumerate(found.astype(np.float32)))))
        _, _, shares = brute(list(enumerate(found.astype(np.float32))))
        assert np.allclose(model.values / model.trace, shares, rtol=1e-8)
        assert model.identity_error < 1e-8
