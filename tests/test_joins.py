"""Interval and as-of joins, patterns and grouping sets on small tables with known answers."""

import datetime as dt
import random
import re
from itertools import product

import pytest
from pyspark.sql import functions as F

from tallywatch.operators import cubes, intervals, patterns
from tallywatch.operators.spread import Frames, framed
from tests.test_plans import plan

POINTS = "id long, k string, at int"
SPANS = "span long, k string, lo int, hi int"


def pairs_of(points, spans, keyed=True):
    return sorted(
        (p, s)
        for (p, pk, at), (s, sk, lo, hi) in product(points, spans)
        if (not keyed or (pk is not None and pk == sk))
        and at is not None
        and lo is not None
        and lo <= at
        and (hi is None or at < hi)
    )


def made_up(seed, n=300, m=120):
    rnd = random.Random(seed)
    key = lambda: rnd.choice(["hot", "hot", "a", "b", None])
    points = [(i, key(), rnd.choice([None, 7, *range(-50, 400)])) for i in range(n)]
    spans = []
    for i in range(m):
        lo = rnd.choice([None, 7, *range(-100, 420)])
        length = rnd.choice([None, 0, -3, 1, 2, 5, 40, 300, 10_000])
        spans.append((i, key(), lo, None if length is None or lo is None else lo + length))
    return points, spans


@pytest.mark.parametrize("seed, hot_rows, keyed", [(1, None, True), (2, 10, True), (3, 15, False), (4, 10**6, False)])
def test_interval_join_equals_all_pairs(spark, seed, hot_rows, keyed):
    points, spans = made_up(seed)
    right = spark.createDataFrame(spans, SPANS)
    right = right if keyed else right.drop("k")
    df = intervals.interval_join(
        spark.createDataFrame(points, POINTS), right, "at", "lo", "hi", ["k"] if keyed else [], hot_rows=hot_rows
    )
    assert df.columns == ["id", "k", "at", "span", "lo", "hi"]
    assert sorted((r.id, r.span) for r in df.collect()) == pairs_of(points, spans, keyed)


def test_left_interval_join_keeps_every_point(spark):
    points, spans = made_up(5)
    df = intervals.interval_join(
        spark.createDataFrame(points, POINTS),
        spark.createDataFrame(spans, SPANS),
        "at", "lo", "hi", ["k"], how="left", tie="id", hot_rows=20,
    )
    got = sorted((r.id, r.span if r.span is not None else -1) for r in df.collect())
    found = pairs_of(points, spans)
    alone = [(p, -1) for p in {p[0] for p in points} - {p for p, _ in found}]
    assert got == sorted(found + alone)


def test_interval_join_over_time_stamps_and_doubles(spark):
    start = dt.datetime(2025, 1, 1)
    at = [start + dt.timedelta(microseconds=rest) for rest in (0, 1, 3_600_000_000, 86_400_000_000 * 40)]
    points = spark.createDataFrame(list(enumerate(at)), "id long, at timestamp")
    spans = spark.createDataFrame([(0, at[0], at[1]), (1, at[1], at[2]), (2, at[0], None)], "s long, lo timestamp, hi timestamp")
    df = intervals.interval_join(points, spans, "at", "lo", "hi")
    assert sorted((r.id, r.s) for r in df.collect()) == [(0, 0), (0, 2), (1, 1), (1, 2), (2, 2), (3, 2)]
    points = spark.createDataFrame([(0, 0.5), (1, -1e300), (2, 1e-9)], "id long, at double")
    spans = spark.createDataFrame([(0, -1e301, 0.5), (1, 0.0, 1e-8)], "s long, lo double, hi double")
    df = intervals.interval_join(points, spans, "at", "lo", "hi")
    assert sorted((r.id, r.s) for r in df.collect()) == [(1, 0), (2, 0), (2, 1)]


def test_interval_join_of_empty_sides(spark):
    points, spans = made_up(6, 20, 20)
    p, s = spark.createDataFrame(points, POINTS), spark.createDataFrame(spans, SPANS)
    for a, b in ((p.limit(0), s), (p, s.limit(0)), (p.limit(0), s.limit(0)), (p.filter("at is null"), s)):
        assert intervals.interval_join(a, b, "at", "lo", "hi", ["k"]).count() == 0
        left = intervals.interval_join(a, b, "at", "lo", "hi", ["k"], "left", "id")
        assert left.count() == a.count()


def test_one_interval_over_everything_costs_no_more_than_its_pairs(spark):
    """Rows on both sides of the join stay in proportion to points, intervals and pairs."""
    points = spark.range(20_000).select("id", F.col("id").cast("int").alias("at"))
    spans = spark.range(5_000).selectExpr("id as s", "cast(id * 4 as int) as lo", "cast(id * 4 + 3 as int) as hi")
    spans = spans.union(spark.createDataFrame([(9_999, 0, 20_000)], "s long, lo int, hi int"))
    known = {}
    real = intervals._spread_cells

    def counted(a, b, cell, hot_rows):
        known["rows"] = a.count() + b.count()
        known["met"] = a.select(*cell).join(b.select(*cell), cell).count()
        return real(a, b, cell, hot_rows)

    intervals._spread_cells = counted
    try:
        df = intervals.interval_join(points, spans, "at", "lo", "hi")
        n = df.count()
    finally:
        intervals._spread_cells = real
    assert n == 20_000 + 15_000
    assert known["rows"] < 20_000 * 3 + 5_001 * 3
    assert known["met"] < 4 * n
    assert "CartesianProduct" not in plan(df) and "NestedLoop" not in plan(df)


def test_interval_join_refuses_what_is_unclear(spark):
    points, spans = spark.createDataFrame([(1, "a", 1)], POINTS), spark.createDataFrame([(1, "a", 0, 2)], SPANS)
    with pytest.raises(ValueError, match="rename"):
        intervals.interval_join(points, spans, "at", "lo", "hi")
    with pytest.raises(ValueError, match="tie"):
        intervals.interval_join(points, spans, "at", "lo", "hi", ["k"], "left")
    with pytest.raises(ValueError, match="inner"):
        intervals.interval_join(points, spans, "at", "lo", "hi", ["k"], "full")


# -- as-of -----------------------------------------------------------------------------------


def latest(left, right, exact, tolerance):
    out = []
    for id_, k, at in left:
        found = [
            (t, r) for r, rk, t in right
            if None not in (k, rk, at, t) and k == rk and (t <= at if exact else t < at)
        ]
        t, r = max(found, default=(None, None))
        if t is not None and tolerance is not None and at - t > tolerance:
            t = r = None
        out.append((id_, r, t))
    return sorted(out)


@pytest.mark.parametrize("exact", [True, False])
@pytest.mark.parametrize("hot_rows", [None, 12])
@pytest.mark.parametrize("tolerance", [None, 9])
def test_asof_join_equals_a_search(spark, exact, hot_rows, tolerance):
    rnd = random.Random(8)
    key = lambda: rnd.choice(["hot", "hot", "a", "b", None])
    left = [(-i, key(), rnd.choice([None, *range(60)])) for i in range(200)]
    right = [(i * 7 - 300, key(), rnd.choice([None, *range(60)])) for i in range(90)]
    df = intervals.asof_join(
        spark.createDataFrame(left, POINTS),
        spark.createDataFrame(right, "r long, k string, r_at int"),
        "at", "r_at", "id", "r", ["k"], exact, tolerance, hot_rows,
    )
    assert df.columns == ["id", "k", "at", "r", "r_at"]
    assert sorted((x.id, x.r, x.r_at) for x in df.collect()) == latest(left, right, exact, tolerance)


def test_asof_join_has_one_exchange_and_no_join(spark):
    left = spark.range(100).selectExpr("id", "cast(id % 5 as string) as k", "cast(id as int) as at")
    right = spark.range(50).selectExpr("id as r", "cast(id % 5 as string) as k", "cast(id as int) as r_at")
    df = intervals.asof_join(left, right, "at", "r_at", "id", "r", ["k"], hot_rows=None)
    text = plan(df)
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 1
    assert "Join" not in text and len(re.findall(r"\bSort \[", text)) == 1


def test_asof_join_of_time_stamps_with_tolerance_and_empty_sides(spark):
    day = dt.datetime(2025, 1, 1)
    left = spark.createDataFrame([(1, "a", day), (2, "a", day + dt.timedelta(hours=3))], "id long, k string, at timestamp")
    right = spark.createDataFrame([(5, "a", day, 1.5)], "r long, k string, r_at timestamp, rate double")
    df = intervals.asof_join(left, right, "at", "r_at", "id", "r", ["k"], tolerance=dt.timedelta(hours=2))
    assert sorted((x.id, x.rate) for x in df.collect()) == [(1, 1.5), (2, None)]
    assert intervals.asof_join(left.limit(0), right, "at", "r_at", "id", "r", ["k"]).count() == 0
    alone = intervals.asof_join(left, right.limit(0), "at", "r_at", "id", "r", ["k"])
    assert [x.rate for x in alone.collect()] == [None, None]
    with pytest.raises(ValueError, match="rename"):
        intervals.asof_join(left, right.withColumnRenamed("rate", "id"), "at", "r_at", "id", "r", ["k"])


def test_carried_values_cross_chunks(spark):
    data = [(i, "hot", i // 3, i if i % 40 == 5 else None) for i in range(400)]
    df = spark.createDataFrame(data, "id long, k string, at int, v int").repartition(4)
    for hot_rows in (None, 30):
        out = framed(df, ["k"], "at", "id", Frames(carried={"last": F.col("v")}), hot_rows)
        got = [r["last"] for r in out.orderBy("id").collect()]
        assert got == [None if i < 5 else (i - 5) // 40 * 40 + 5 for i in range(400)]


# -- patterns ------------------------------------------------------------------------------


def ends_of(rows, automaton):
    out, states = [], {}
    for at, id_, k, symbol in sorted(rows, key=lambda r: r[:2]):
        if k is None or symbol is None or not 0 <= symbol < len(automaton.next[0]):
            continue
        states[k] = automaton.next[states.get(k, 0)][symbol]
        if states[k] == automaton.accept:
            out.append((k, at, id_))
    return sorted(out)


@pytest.mark.parametrize("block, hot_rows", [(64, None), (3, None), (4, 25)])
@pytest.mark.parametrize(
    "automaton",
    [
        patterns.in_sequence([0, 1, 0, 1], 2),
        patterns.in_sequence([0, 1, 2], 4, reset=[3]),
        patterns.in_sequence([1], 2),
        patterns.Automaton(((1, 0), (1, 2), (0, 2)), 2),
    ],
)
def test_match_ends_equal_one_run(spark, monkeypatch, block, hot_rows, automaton):
    monkeypatch.setattr(patterns, "BLOCK", block)
    rnd = random.Random(block)
    key = lambda: rnd.choice(["hot", "hot", "hot", "a", "b", None])
    rows = [(rnd.randrange(40), i * 31 % 500, key(), rnd.choice([None, 0, 1, 2, 3, 9])) for i in range(400)]
    df = spark.createDataFrame(rows, "at int, id long, k string, s int").repartition(4)
    out = patterns.match_ends(df, ["k"], "at", "id", F.col("s"), automaton, hot_rows)
    assert out.columns == ["k", "at", "id"]
    found = sorted(tuple(r) for r in out.collect())
    assert found and found == ends_of(rows, automaton)


def test_match_ends_of_nothing(spark):
    df = spark.createDataFrame([], "at int, id long, k string, s int")
    assert patterns.match_ends(df, ["k"], "at", "id", F.col("s"), patterns.in_sequence([0], 1)).count() == 0


def test_a_hot_account_is_read_in_several_tasks(spark):
    """Groups of the fold hold a block of rows, however many the account has."""
    rows = spark.range(1_000).selectExpr("id as at", "id", "'hot' as k", "cast(id % 2 as int) as s")
    sizes = []
    real = patterns.pinned

    def noted(df, label):
        out = real(df, label)
        name = "__rows" if "__rows" in out.columns else "__parts"
        sizes.append(out.agg(F.count("*"), F.max(F.size(name))).first())
        return out

    patterns.pinned = noted
    try:
        out = patterns.match_ends(rows, ["k"], "at", "id", F.col("s"), patterns.in_sequence([0, 1], 2), 100)
        assert out.count() == 500
    finally:
        patterns.pinned = real
    assert [tuple(s) for s in sizes] == [(16, 64), (1, 16)]


# -- grouping sets ------------------------------------------------------------------------------


def test_grouping_sets_tell_missing_from_left_out(spark):
    data = [(1, "x", 10), (1, None, 20), (None, "x", None), (2, "x", 5), (2, "x", 5)]
    df = spark.createDataFrame(data, "a int, b string, v int")
    measures = {
        "total": ("sum", F.col("v")),
        "n": ("count", F.col("v")),
        "least": ("min", F.col("v")),
        "most": ("max", F.col("v")),
        "mean": ("avg", F.col("v")),
    }
    got = {(r.a, r.b, r.grouping_id): tuple(r)[3:] for r in cubes.grouping_sets(df, ["a", "b"], measures).collect()}
    wanted = {}
    for drop_a, drop_b in product((0, 1), (0, 1)):
        groups = {}
        for a, b, v in data:
            groups.setdefault((None if drop_a else a, None if drop_b else b), []).append(v)
        for (a, b), values in groups.items():
            v = [x for x in values if x is not None]
            row = (sum(v), len(v), min(v), max(v), sum(v) / len(v)) if v else (None, 0, None, None, None)
            wanted[(a, b, 2 * drop_a + drop_b)] = row
    assert got == wanted
    rolled = cubes.grouping_sets(df, ["a", "b"], measures, cubes.rollup_sets(["a", "b"]))
    assert {r.grouping_id for r in rolled.collect()} == {0, 1, 3}
    some = cubes.grouping_sets(df, ["a", "b"], measures, [["b"]], level="which")
    assert {r.which for r in some.collect()} == {2}


def test_grouping_sets_of_nothing_and_misuse(spark):
    df = spark.createDataFrame([], "a int, v int")
    out = cubes.grouping_sets(df, ["a"], {"n": ("count", F.col("v")), "s": ("sum", F.col("v"))}).collect()
    assert out == []
    with pytest.raises(ValueError, match="median"):
        cubes.grouping_sets(df, ["a"], {"m": ("median", F.col("v"))})
    with pytest.raises(ValueError, match="dims"):
        cubes.grouping_sets(df, ["a"], {"n": ("count", F.col("v"))}, [["z"]])


def test_cube_reads_the_rows_once_and_expands_only_groups(spark):
    df = spark.range(1_000).selectExpr("id % 3 as a", "id % 2 as b", "id as v")
    text = plan(cubes.grouping_sets(df, ["a", "b"], {"s": ("sum", F.col("v"))}))
    assert len(re.findall(r"\bRange \(", text)) == 1
    expand, finest = text.index("Expand"), text.rindex("HashAggregate")
    assert expand < finest  # printed from the top: the first aggregate lies below the expansion


def test_pivot_names_what_does_not_fit(spark):
    data = [("x", "a", 1), ("x", "a", 2), ("x", "b", 4), ("x", "b", 1), ("y", "c", 8), ("y", "d", 16), ("y", None, 32), (None, "a", None)]
    df = spark.createDataFrame(data, "k string, c string, v int")
    out = cubes.pivoted(df, ["k"], "c", F.col("v"), most=2)
    assert out.columns == ["k", "a", "b", "other", "missing"]
    got = {r.k: tuple(r)[1:] for r in out.collect()}
    assert got == {"x": (3, 5, None, None), "y": (None, None, 24, 32), None: (None, None, None, None)}
    whole = cubes.pivoted(df, ["k"], "c", F.col("v"))
    assert whole.columns == ["k", "a", "b", "c", "d", "missing"]
    assert cubes.pivoted(df.limit(0), ["k"], "c", F.col("v")).columns == ["k", "missing"]
    with pytest.raises(ValueError, match="twice"):
        cubes.pivoted(df.withColumn("c", F.lit("other")), ["k"], "c", F.col("v"))
