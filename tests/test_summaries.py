"""Sketches against exact ranks and sets; merging in any order."""

import random

import pytest
from pyspark.sql import functions as F

from tallywatch.operators import summaries

SHARES = (0.0, 0.1, 0.5, 0.9, 1.0)


def amounts(seed, n=40_000):
    rnd = random.Random(seed)
    return [(rnd.choice("ab"), i % 30, rnd.choice([None, 5.0, rnd.lognormvariate(3, 2)])) for i in range(n)]


@pytest.mark.parametrize("parts", [1, 7])
def test_quantiles_of_merged_sketches_keep_their_rank(spark, folder, parts):
    rows = amounts(1)
    df = spark.createDataFrame(rows, "type string, day int, v double").repartition(parts)
    summaries.quantile_sketches(df, ["type", "day"], F.col("v")).write.parquet(f"{folder}/q")
    stored = spark.read.parquet(f"{folder}/q")
    for days in (range(30), range(3, 9), [4]):
        some = stored.filter(F.col("day").isin(list(days))).repartition(parts)
        found = summaries.merged_quantiles(some, ["type"], SHARES).collect()
        assert len(found) == 2 * len(SHARES)
        for r in found:
            values = sorted(v for t, d, v in rows if t == r["type"] and d in days and v is not None)
            below = sum(v < r["value"] for v in values) / len(values)
            upto = sum(v <= r["value"] for v in values) / len(values)
            bound = summaries.RANK_ERROR
            assert below <= r["share"] + bound and upto >= r["share"] - bound
            if r["share"] in (0.0, 1.0):
                assert r["value"] == (values[0] if r["share"] == 0 else values[-1])


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([("a", None), ("b", 1.0)], "type string, v double")
    found = summaries.merged_quantiles(summaries.quantile_sketches(df, ["type"], F.col("v")), ["type"], [0.5])
    assert [tuple(r) for r in found.collect()] == [("b", 0.5, 1.0)]
    none = summaries.quantile_sketches(df.limit(0), ["type"], F.col("v"))
    assert summaries.merged_quantiles(none, ["type"], [0.5]).count() == 0


def test_distinct_members_are_exact_below_the_size_and_close_above(spark):
    few = [("few", i % 10, f"d{i % 900}") for i in range(3_000)] + [("few", 1, None)]
    many = [("many", i % 10, f"m{i}") for i in range(30_000)]
    df = spark.createDataFrame(few + many, "k string, day int, dest string").repartition(5)
    daily = summaries.distinct_sketches(df, ["k", "day"], "dest")
    got = {r["k"]: r for r in summaries.compared_sets(daily, ["k"], F.col("day") < 6, F.col("day") >= 3).collect()}

    def exact(rows, which):
        return {m for _, d, m in rows if which(d) and m is not None}

    for k, rows in (("few", few), ("many", many)):
        a, b = exact(rows, lambda d: d < 6), exact(rows, lambda d: d >= 3)
        wanted = [len(a), len(b), len(a & b), len(a | b), len(a - b)]
        found = [got[k][c] for c in ("in_first", "in_second", "in_both", "in_either", "only_first")]
        if k == "few":
            assert found == wanted
        else:
            assert all(abs(f - w) < 0.08 * len(a | b) for f, w in zip(found, wanted))


def test_empty_ranges_and_tables(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 1, "x")], "k string, day int, dest string")
    daily = summaries.distinct_sketches(df, ["k", "day"], "dest")
    out = summaries.compared_sets(daily, ["k"], F.col("day") < 0, F.col("day") > 0).collect()
    assert [tuple(r) for r in out] == [("a", 0, 1, 0, 1, 0)]
    none = summaries.distinct_sketches(df.limit(0), ["k", "day"], "dest")
    assert summaries.compared_sets(none, ["k"], F.col("day") < 0, F.col("day") > 0).count() == 0
