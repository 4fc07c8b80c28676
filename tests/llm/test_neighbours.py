import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallywatch.llm import neighbours, queries
from tests.llm.edges import clashing

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute_force(rows, k=10):
    """Each query's nearest, ties to the smaller vec_id; rows by their place."""
    ok = [
        (i, v)
        for i, v, _ in rows
        if v and any(v) and all(x is not None and math.isfinite(x) for x in v)
    ]
    x = np.array([np.float32(v) for _, v in ok], np.float64)
    ids = np.array([i for i, _ in ok])
    out = {}
    for q in np.flatnonzero(ids % 100 == 0):
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        d[q] = np.inf
        order = np.lexsort((ids, d))[: min(k, len(ids) - 1)]
        out.setdefault(int(ids[q]), []).append([(int(ids[j]), float(d[j])) for j in order])
    return out


def got(df, **how):
    rows = neighbours.search(df, F.col("vec_id") % 100 == 0, **how).collect()
    out = {}
    for r in sorted(rows, key=lambda r: r["rank"]):
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return out


def clustered(n, dim=16, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 3, (40, dim))
    x = centres[rng.integers(0, 40, n)] + rng.normal(0, 1, (n, dim))
    return [(i, [float(a) for a in v], 0) for i, v in enumerate(x)]


def test_recall_with_few_partitions_searched(spark, monkeypatch):
    rows = clustered(6000)
    want = brute_force(rows)
    out = got(spark.createDataFrame(rows, SCHEMA), sample=3000, partitions=16)
    hits = sum(len({v for _, v, _ in out[q]} & {v for v, _ in w[0]}) for q, w in want.items())
    assert hits >= 0.95 * sum(len(w[0]) for w in want.values())
    exact = {(q, v): s for q, r in out.items() for _, v, s in r}
    x = {i: np.array(np.float32(v), np.float64) for i, v, _ in rows}
    assert all(s == np.sqrt(((x[q] - x[v]) ** 2).sum()) for (q, v), s in exact.items())


def test_partitions_are_balanced_and_cut_few_edges():
    x = np.array([v for _, v, _ in clustered(2000)])
    graph = neighbours.nearest(x, x, 8, same=True)
    label = neighbours.partition_graph(x, graph, 8)
    assert np.bincount(label, minlength=8).max() <= np.ceil(1.1 * 2000 / 8)
    assert (label[graph] == label[:, None]).mean() > 0.6


def test_few_queries_need_all_partitions():
    x = np.array([v for _, v, _ in clustered(4000)])
    router = neighbours.fit(x, 16, 0.95, 10, 1)
    assert 1 <= router.probes < 16


def test_edges(spark):
    v = [1.0, 2.0, 3.0]
    rows = [
        (0, v, 0), (1, v, 0), (1, v, 0), (2, [1.0, 2.0, 4.0], 0), (100, v, 0), (100, v, 0),
        (3, None, 0), (4, [], 0), (5, [0.0, 0.0, 0.0], 0), (6, [1.0, None, 2.0], 0),
        (200, [float("nan"), 1.0, 1.0], 0), (7, [float("inf"), 1.0, 1.0], 0), (8, [5.0], 0),
    ]
    df = clashing(spark.createDataFrame(rows, SCHEMA), "rank", "score", "part", "row")
    out = got(df)
    assert set(out) == {0, 100}
    assert [(r, i) for r, i, _ in out[0]] == [(1, 1), (2, 1), (3, 100), (4, 100), (5, 2)]
    assert len(out[100]) == 10 and {s for _, _, s in out[100][:6]} == {0.0}


@pytest.mark.parametrize("rows", [[], [(100, [1.0], 0)], [(100, None, 0)]])
def test_too_few(spark, rows):
    assert got(spark.createDataFrame(rows, SCHEMA)) == {}


def test_a_third_of_all_rows_alike(spark):
    rows = clustered(1500)
    rows = [(i, [1.0] * 16 if i % 3 == 0 else v, 0) for i, v, _ in rows]
    out, want = got(spark.createDataFrame(rows, SCHEMA)), brute_force(rows)
    for q, w in want.items():
        if q % 3 == 0:
            assert [v for _, v, _ in out[q]] == [v for v, _ in w[0]]


def test_query_recall(spark):
    sf = "/root/testdata/sf0.1"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want = brute_force(rows)
    out = {}
    for r in queries.op10_neighbours(spark, sf).collect():
        out.setdefault(r.query_id, set()).add(r.vec_id)
    hits = sum(len(out[q] & {v for v, _ in w[0]}) for q, w in want.items())
    assert hits >= 0.9 * sum(len(w[0]) for w in want.values())
