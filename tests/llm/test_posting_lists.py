import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeward.llm import op2_posting_lists as op2

SCHEMA = "vec_id bigint, embedding array<float>, label int, ids string"


def brute(ids, x, most=20):
    out = {}
    for q in np.flatnonzero(ids % 20 == 0):
        score = (x * x[q]).sum(axis=1)
        others = np.flatnonzero(ids != ids[q])
        best = others[np.lexsort((ids[others], -score[others]))[:most]]
        out[int(ids[q])] = [(int(ids[b]), score[b]) for b in best]
    return out


def answers(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    for v in out.values():
        assert [x[0] for x in v] == list(range(1, len(v) + 1))
        assert all((a[2], -a[1]) > (b[2], -b[1]) for a, b in zip(v, v[1:]))
    return out


def table(spark, ids, x):
    return spark.createDataFrame([(int(i), [float(c) for c in v], 0, "extra") for i, v in zip(ids, x)], SCHEMA)


@pytest.mark.parametrize("spread", [0.0, 1.0])
def test_recall(spark, spread):
    r = np.random.default_rng(1)
    x = r.normal(size=(4000, 24)).astype("float32") + spread * r.normal(size=(10, 24))[r.integers(0, 10, 4000)]
    x = x.astype("float32").astype(float) * (r.uniform(0.5, 2, (4000, 1)) if spread else 1)
    x = x.astype("float32").astype(float)
    ids = np.arange(4000)
    got, want = answers(op2.search(table(spark, ids, x), F.col("id") % 20 == 0)), brute(ids, x)
    assert set(got) == set(want)
    hits = sum(len({v for _, v, _ in got[q]} & {v for v, _ in want[q]}) for q in want)
    assert hits >= 0.9 * sum(len(v) for v in want.values())
    for q, found in got.items():
        assert len(found) == 20
        for _, v, s in found:
            assert s == pytest.approx(float((x[q] * x[v]).sum()), rel=1e-12)


def test_common_vector_and_ties(spark):
    r = np.random.default_rng(2)
    x = r.integers(-2, 3, size=(1500, 6)).astype(float)
    x[300:1000] = x[7] = [1, 2, 0, -1, 2, 1]
    x[(x == 0).all(axis=1)] = 1
    ids = np.arange(1500) * 5
    got, want = answers(op2.search(table(spark, ids, x), F.col("id") % 20 == 0)), brute(ids, x)
    hits = sum(len({v for _, v, _ in got[q]} & {v for v, _ in want[q]}) for q in want)
    assert hits >= 0.9 * sum(len(v) for v in want.values())
    assert [v for _, v, _ in got[2000]] == [v for v, _ in want[2000]]


def test_odd_vectors_and_few_rows(spark):
    nan, inf = float("nan"), float("inf")
    data = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (1, [0.5, 0.5]), (2, None), (3, []), (4, [0.0, 0.0]), (5, [nan, 1.0]),
            (6, [inf, 1.0]), (7, [1.0, None]), (8, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (20, [-0.0, 1.0]), (21, [0.0, 1.0]),
            (40, None)]
    df = spark.createDataFrame([(i, v, 0, "x") for i, v in data], SCHEMA)
    got = answers(op2.search(df, F.col("id") % 20 == 0))
    assert {q: [v for _, v, _ in found] for q, found in got.items()} == {0: [1, 20, 21], 20: [21, 1, 0]}
    assert op2.search(df.limit(0), F.col("id") % 20 == 0).collect() == []
    assert op2.search(df.filter("vec_id = 1"), F.col("id") % 20 == 0).collect() == []


def test_cells_split_rows_and_queries(spark, monkeypatch):
    monkeypatch.setattr(op2, "CELL_ROWS", 200)
    monkeypatch.setattr(op2, "CELL_QUERIES", 30)
    r = np.random.default_rng(5)
    x = r.normal(size=(1500, 8)).astype("float32").astype(float)
    ids = np.arange(1500)
    got, want = answers(op2.search(table(spark, ids, x), F.col("id") % 20 == 0)), brute(ids, x)
    hits = sum(len({v for _, v, _ in got[q]} & {v for v, _ in want[q]}) for q in want)
    assert hits >= 0.9 * sum(len(v) for v in want.values())


def test_graph_search_finds_near_centroids():
    r = np.random.default_rng(3)
    x = r.normal(size=(5000, 16))
    c = op2.Centroids(x, 100)
    ids, dist = c.search(x[:200], 16)
    true = np.argsort(op2.Centroids._distances(x[:200], c.c), axis=1)[:, :8]
    assert np.mean([len(set(a[:8]) & set(b)) / 8 for a, b in zip(ids, true)]) > 0.9
    assert (np.diff(dist, axis=1) >= 0).all()


@pytest.mark.parametrize("scale", [1.0, 1e25])
def test_near_equal_vectors_are_told_apart(spark, scale):
    """Vectors that single precision cannot tell apart, and products that it cannot hold."""
    r = np.random.default_rng(7)
    x = (np.array([3.0, -1.0, 2.0, 0.5]) + 1e-10 * r.normal(size=(200, 4))) * scale
    ids = np.arange(200)
    df = spark.createDataFrame([(int(i), [float(c) for c in v]) for i, v in zip(ids, x)],
                               "vec_id bigint, embedding array<double>")
    got, want = answers(op2.search(df, F.col("id") % 20 == 0)), brute(ids, x)
    assert {q: [v for _, v, _ in found] for q, found in got.items()} == {q: [v for v, _ in w] for q, w in want.items()}


def test_huge_components_and_two_lengths(spark):
    r = np.random.default_rng(4)
    x = r.normal(size=(3000, 12))
    x[[5, 700]] *= 1e200
    x[40] *= 1e300
    y = r.normal(size=(900, 7))
    rows = [(k, v.tolist()) for k, v in enumerate(x)] + [(10_000 + k, v.tolist()) for k, v in enumerate(y)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = answers(op2.search(df, F.col("id") % 20 == 0))
    for ids, v in ((np.arange(3000), x), (10_000 + np.arange(900), y)):
        with np.errstate(over="ignore"):
            want = brute(ids, v)
        assert set(got) >= set(want)
        hits = sum(len({i for _, i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
        assert hits >= 0.9 * sum(len(w) for w in want.values())
        # the longest vectors are in every answer that they belong to
        for q, w in want.items():
            big = {i for i, score in w if abs(score) > 1e100}
            assert big <= {i for _, i, _ in got[q]}
    assert len(got) == 150 + 45 and all(len(v) == 20 for v in got.values())


def test_search_of_the_graph_stops_early():
    r = np.random.default_rng(5)
    points = r.normal(size=(4000, 8))
    centroids = op2.Centroids(points, 500)
    opened = []
    whole, _ = centroids.search(points[:50], 500)
    for beam in (op2.BEAM,):
        near, _ = centroids.search(points[:50], beam)
        opened.append(np.mean([len(set(a[:20]) & set(b[:20])) for a, b in zip(near, whole)]))
    assert opened[0] >= 18
