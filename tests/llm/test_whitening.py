import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from lakeward.llm import op11_whitening as w

NAN, INF = float("nan"), float("inf")


def brute(vectors):
    """Per row (id, vector) of one length: x, n, S, eigenvalues (falling) and eigenvectors of the covariance."""
    x = np.array([[int(np.floor(64 * float(c))) + 1_000_000 for c in v] for v in vectors], dtype=object)
    n, s = len(x), x.sum(axis=0)
    y = (x * n - s).astype(float) / n
    values, base = np.linalg.eigh(y.T @ y / n)
    return n, [int(t) for t in ((x * n - s) ** 2).sum(axis=1)], y, values[::-1], base[:, ::-1]


def check(got, ids, vectors, most=32):
    """``got`` (rows of the query) against the dense solution, for vectors of one length."""
    n, deviations, y, values, base = brute(vectors)
    d, trace = y.shape[1], values.sum()
    rank = int((values > 1e-12 * max(trace, 1e-300)).sum())
    k = min(d, most)
    deviations = [v if v < 1 << 63 else None for v in deviations]
    # repeated rows have the same values, so any of them may stand for the other
    held = defaultdict(list)
    for r in got:
        assert r.n == n
        held[r.vec_id, r.deviation, r.component].append(r)
    assert {key: len(rows) for key, rows in held.items()} == Counter(
        (i, v, c + 1) for i, v in zip(ids, deviations, strict=True) for c in range(k))
    rows = [[held[i, v, c + 1].pop() for c in range(k)] for i, v in zip(ids, deviations, strict=True)]
    got = rows[0]
    white = np.array([[np.nan if r.whitened is None else r.whitened for r in row] for row in rows])
    assert np.isnan(white[:, rank:]).all() and not np.isnan(white[:, :min(rank, k)]).any()
    for c in range(k):
        share = got[c].explained
        if c < rank:
            assert share == pytest.approx(values[c] / trace, rel=1e-8)
        else:
            assert share == (0.0 if trace else None)
    top = min(rank, k)
    if top:
        used = white[:, :top]
        # the basis of equal eigenvalues is free: compare the projections they span
        ref = y @ (base[:, :top] / np.sqrt(values[:top]))
        if rank == d or top < rank:
            gap = top == d or values[top - 1] - values[top] > 1e-6 * values[0]
        else:
            gap = True
        if gap:
            assert np.allclose(used @ used.T, ref @ ref.T, atol=1e-6)
        cov = (used - used.mean(axis=0)).T @ (used - used.mean(axis=0)) / n
        error = np.abs(cov - np.eye(top)).max()
        assert error < 1e-8 and got[0].identity_error < 1e-8
    else:
        assert {r.identity_error for r in got} <= {None}


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1) for i, v in rows],
                                 "vec_id bigint, embedding array<double>, component string, d int")


def test_against_dense_solution(spark):
    r = np.random.default_rng(3)
    for n, d, spread in ((300, 40, np.ones(40)), (200, 5, np.array([1e-3, 1, 1, 50, 4e3])), (150, 33, 10.0 ** -np.arange(33) + 0.1)):
        vectors = (r.standard_normal((n, d)) * spread).tolist()
        check(w.components(frame(spark, list(enumerate(vectors)))).collect(), list(range(n)), vectors)


def test_edge_rows(spark):
    r = random.Random(2)
    good = [[r.uniform(-2, 2) for _ in range(4)] for _ in range(40)]
    rows = [(k, v) for k, v in enumerate(good)]
    rows += [(3, good[3]), (None, good[5]), (None, None), (50, None), (51, []), (52, [1.0, None, 2.0, 3.0]), (53, [1.0, NAN, 2.0, 3.0]),
             (54, [INF, 1.0, 2.0, 3.0]), (55, [1e200, 1.0, 2.0, 3.0])]
    got = w.components(frame(spark, rows)).collect()
    check(got, [*range(40), 3, None], good + [good[3], good[5]])


def test_lengths_are_fitted_by_themselves(spark):
    r = np.random.default_rng(5)
    two, three = r.standard_normal((30, 2)).tolist(), r.standard_normal((50, 3)).tolist()
    got = w.components(frame(spark, list(enumerate(two + three)))).collect()
    check([x for x in got if x.vec_id < 30], list(range(30)), two)
    check([x for x in got if x.vec_id >= 30], list(range(30, 80)), three)


def test_little_or_no_variance(spark):
    one = [[1.0, 2.0, 3.0]]
    check(w.components(frame(spark, [(7, one[0])])).collect(), [7], one)
    same = [[1.0, 2.0, 3.0]] * 9
    check(w.components(frame(spark, list(enumerate(same)))).collect(), list(range(9)), same)
    flat = [[float(k), 2.0, float(k)] for k in range(9)]
    check(w.components(frame(spark, list(enumerate(flat)))).collect(), list(range(9)), flat)
    assert w.components(frame(spark, [(1, one[0])]).limit(0)).collect() == []
    assert w.components(frame(spark, [(1, None), (2, [])])).collect() == []


def test_large_values_stay_exact(spark):
    r = random.Random(4)
    vectors = [[r.uniform(-1, 1) * 10.0 ** r.randint(0, 9) for _ in range(3)] for _ in range(60)]
    got = w.components(frame(spark, list(enumerate(vectors)))).collect()
    n, deviations, *_ = brute(vectors)
    assert {r.vec_id: r.deviation for r in got} == {k: v if v < 1 << 63 else None for k, v in enumerate(deviations)}
    assert got[0].identity_error < 1e-8


def symmetric(values, seed=1):
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))
    return (q * np.array(values)) @ q.T


@pytest.mark.parametrize("values", [
    [0.5, 0.2, 0.1, 0.1, 0.1], [1.0], [0.25] * 4, [0.9, 0.1, 1e-13, 0.0], [2.0**-k for k in range(1, 40)],
    [0.02] * 20 + [0.0300001, 0.03] * 10, list(np.linspace(0.001, 0.03, 60)), [0.99] + [1e-6] * 30])
def test_contour_finds_all_eigenpairs(spark, values):
    values = sorted(np.array(values) / sum(values), reverse=True)
    a = symmetric(values)
    for point in (0.0, 1e-7, 0.015, 0.11, 0.6):
        if min(abs(np.array(values) - point)) > 1e-12:
            assert w.above(a, point) == sum(v > point for v in values)
    for wanted in (1, 3, 32):
        real = [v for v in values if v > 8 * len(a) * np.finfo(float).eps][:wanted]
        got, vectors = w.leading(spark, a, wanted)
        assert np.allclose(got, real, rtol=1e-9, atol=1e-15)
        assert np.allclose(vectors.T @ vectors, np.eye(len(real)), atol=1e-12)
        assert np.abs(a @ vectors - vectors * got).max() < 1e-12


def test_partial_sums_are_exact():
    r = random.Random(6)
    for v in [0, -1, 1, 1 << 130, -(1 << 130), *[r.randint(-(1 << 140), 1 << 140) for _ in range(50)]]:
        assert w._whole(dict(zip(w._PART_NAMES, w._parts(v), strict=True))) == v
        assert all(abs(p) < 1 << 63 for p in w._parts(v))
    y = np.array([[r.randint(-(1 << 61), 1 << 61) for _ in range(3)] for _ in range(20)])
    pieces = w._pieces(y)
    assert (sum(p.astype("int64").astype(object) << 20 * k for k, p in enumerate(pieces)) == y.astype(object)).all()
