"""Whitening against dense linear algebra and whole-number arithmetic."""

import math

import numpy as np
import pytest

from tallywatch.llm import whitening
from tallywatch.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<double>"


def symmetric(values, seed=1):
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))
    return q @ np.diag(values) @ q.T


@pytest.mark.parametrize(
    "values",
    [
        [3.0, 2.0, 1.0],
        [5.0] * 4 + [1.0] * 3,
        [1e6, 1.0, 1e-3, 1e-9, 0.0],
        list(np.linspace(0.1, 2, 40)),
        [0.0, 0.0, 7.0],
        [1.0, 1.0, 1.0],
        [-2.0, 0.0, 2.0],
    ],
)
def test_components_are_eigenvectors(values):
    a = symmetric(values)
    found, vectors = whitening.components(a)
    size = max(map(abs, values))
    assert np.allclose(found, sorted(values, reverse=True), atol=1e-13 * size * len(values))
    assert np.linalg.norm(a @ vectors - vectors * found) < 1e-12 * size * len(values)
    assert np.allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-12)


def test_polar_is_the_sign_of_the_matrix():
    a = symmetric([4.0, 1.0, -1e-8, -3.0])
    u = whitening.polar(a)
    assert np.allclose(u @ u, np.eye(4), atol=1e-7)
    assert round(float(np.trace(u))) == 0


def brute(rows):
    """The contract in dense arithmetic: rows is [(id, vector)] of one length."""
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for _, v in rows]
    fit = sorted({tuple(v) for v in x})
    n, d = len(fit), len(fit[0])
    sums = [sum(v[i] for v in fit) for i in range(d)]
    centred = np.array([[v[i] - sums[i] / n for i in range(d)] for v in fit])
    cov = centred.T @ centred / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    out = {}
    for (vec_id, _), v in zip(rows, x):
        deviation = sum((n * a - s) ** 2 for a, s in zip(v, sums))
        y = (np.array([a - s / n for a, s in zip(v, sums)]) @ vectors) / np.sqrt(np.maximum(values, 1e-300))
        out[vec_id] = (n, deviation, y, values / values.sum())
    return out


def check(found, wanted, most=16):
    by_id = {}
    for r in found:
        by_id.setdefault(r["vec_id"], []).append(r)
    assert by_id.keys() == wanted.keys()
    flips = {}
    for vec_id, rows in by_id.items():
        n, deviation, y, explained = wanted[vec_id]
        rows.sort(key=lambda r: r["component"])
        assert [r["component"] for r in rows] == list(range(1, min(most, len(y)) + 1))
        for r in rows:
            i = r["component"] - 1
            assert (r["n"], r["deviation"]) == (n, deviation)
            assert abs(r["explained"] / explained[i] - 1) < 1e-9
            assert r["identity_error"] < 1e-9
            if abs(y[i]) > 1e-6:
                sign = flips.setdefault(i, 1 if y[i] * r["whitened"] > 0 else -1)
                assert abs(sign * r["whitened"] - y[i]) < 1e-7


def test_equals_dense_arithmetic(spark):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((300, 20)) * np.linspace(4, 0.3, 20)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(1_000 + i, rows[7][1]) for i in range(150)]  # copies count once
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    check(whitening.whiten(df).collect(), brute(rows))


def test_query_over_the_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    table = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()]
    table = [(i, v) for i, v in table if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    found = QUERIES["op12_whitening"](spark, sf)
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check(found.collect(), brute(table))


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    good = [(0, [0.0, 1.0]), (1, [2.0, 0.5]), (2, [1.0, -3.0]), (2, [1.0, -3.0]), (None, [0.5, 0.5])]
    bad = [(5, None), (6, [1.0, None]), (7, [nan, 1.0]), (8, [1.0, -inf]), (9, [])]
    other = [(20, [1.0]), (21, [3.0])]  # another length: another fit
    df = spark.createDataFrame(good + bad + other, "vec_id long, embedding array<double>")
    df = df.selectExpr("*", "'t' as x", "1 as n", "2 as component")
    out = whitening.whiten(df).collect()
    ids = sorted((-1 if r["vec_id"] is None else r["vec_id"], r["component"]) for r in out)
    twice = [(i, c) for i in (-1, 0, 1, 2, 2) for c in (1, 2)]
    assert ids == sorted([*twice, (20, 1), (21, 1)])
    assert {r["n"] for r in out if r["vec_id"] in (20, 21)} == {2}
    assert {r["n"] for r in out if r["vec_id"] in (0, 1, 2)} == {4}


def test_equal_vectors_and_no_rows_give_nothing(spark):
    same = spark.createDataFrame([(i, [1.5, 2.5]) for i in range(9)], SCHEMA)
    assert whitening.whiten(same).count() == 0
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).count() == 0


def test_entries_out_of_reach_are_held(spark):
    rows = [(0, [1e300, 0.0]), (1, [-1e300, 1.0]), (2, [0.0, 0.25])]
    out = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r["deviation"] for r in out if r["vec_id"] == 0} == {None}
    assert all(math.isfinite(r["whitened"]) for r in out)


def test_exact_beyond_doubles():
    big = whitening.Fit(3, [10**12, -5], np.zeros(0), np.zeros((2, 0)), 0.0)
    x = np.array([[10**8, 7], [10**12 // 3, -1]], np.int64)
    wanted = [sum((3 * v - s) ** 2 for v, s in zip(row, big.sums)) for row in x.tolist()]
    assert big.deviations(x) == [w if w < 1 << 63 else None for w in wanted]
