from collections import Counter

import numpy as np
import pytest

from tallywatch.llm import queries, sharding
from tests.llm.edges import clashing, edge_docs, edge_rows, empty_docs


def test_sizes_and_slots(spark):
    df = spark.range(1003).repartition(5)
    rows = sharding.shuffle_into_shards(df, shards=7, cell_rows=20).collect()
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r.slot)
    assert sorted(len(x) for x in by.values()) == [143] * 5 + [144] * 2
    assert all(sorted(x) == list(range(len(x))) for x in by.values())
    assert sorted(r.id for r in rows) == list(range(1003))


def test_every_place_is_equally_likely(spark):
    df, hits = spark.range(12).coalesce(1), np.zeros((12, 4))
    for seed in range(60):
        for r in sharding.shuffle_into_shards(df, shards=4, seed=seed).collect():
            hits[r.id, r.shard] += 1
    assert abs(hits / 60 - 0.25).max() < 0.25


def test_matrix_has_the_right_margins():
    sizes = [5, 0, 1000, 77]
    matrix = sharding._matrix(3, sizes, 6)
    assert matrix.sum(1).tolist() == sizes
    assert matrix.sum(0).max() - matrix.sum(0).min() <= 1
    rows = [sharding._row_of(3, sizes, matrix, p) for p in range(4)]
    assert np.array_equal(np.array(rows), matrix)


def test_groups_of_partitions_deal_on():
    sizes = [3 + i % 5 for i in range(3000)]
    matrix = sharding._matrix(1, sizes, 4)
    assert len(matrix) == sharding.GROUPS and matrix.sum() == sum(sizes)
    rows = sum(sharding._row_of(1, sizes, matrix, p) for p in range(3000))
    assert np.array_equal(rows, matrix.sum(0))


@pytest.mark.parametrize("size", [10**6, 3 * 10**9])
def test_hypergeometric_mean_and_spread(size):
    rng = np.random.default_rng(0)
    drawn = [sharding.hypergeometric(rng, size // 4, size - size // 4, 40_000) for _ in range(300)]
    assert abs(np.mean(drawn) - 10_000) < 25
    assert 60 < np.std(drawn) < 120


def test_edges(spark):
    df = clashing(edge_docs(spark), "shard", "slot", "size")
    out = sharding.shuffle_into_shards(df, shards=4).collect()
    assert Counter((r.doc_id, r.text) for r in out) == Counter(r[:2] for r in edge_rows())
    assert {r["size"] for r in out} == {"other"}
    assert sharding.shuffle_into_shards(empty_docs(spark)).count() == 0


def test_query(spark):
    rows = queries.op1_sharding(spark, "/root/testdata/sf0.001").collect()
    counts = Counter(r.shard for r in rows)
    assert max(counts.values()) - min(counts.get(s, 0) for s in range(40)) <= 1
    assert {r.law for r in rows} == {"rows"} and all(r.grown_shard is None for r in rows)
