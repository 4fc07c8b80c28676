"""Both window lanes and the distributed rank against plain window functions."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallywatch.operators import patterns, spread
from tallywatch.operators import windows as w
from tallywatch.operators.spread import (
    Frames,
    attach,
    framed,
    hot_keys,
    match,
    position,
    rank_within,
    small_copy,
)
from tallywatch.session import pinned


def skewed(spark, seed, rows=600):
    """One account holds a third of the rows, one of its steps a third of those."""
    rnd = random.Random(seed)
    data = []
    for i in range(rows):
        kind = i % 3
        account = "hot" if kind == 0 else rnd.choice([None, "a", "b", "c", "d", "e"])
        step = 7 if kind == 0 and i % 9 == 0 else rnd.choice([None, *range(1, 60)])
        amount = rnd.choice([None, "0.00", "-5.00", "100.00", f"{rnd.randint(1, 10**6)}.25"])
        data.append((rnd.randint(-(10**12), 10**12) * 1000 + i, account, step, amount))
    df = spark.createDataFrame(data, "txn_id long, nameOrig_hashed string, step int, amount string")
    money = F.col("amount").cast("decimal(18,2)")
    return df.select(
        "txn_id",
        "nameOrig_hashed",
        "step",
        money.alias("amount"),
        money.alias("oldbalanceOrg"),
        F.when(F.col("txn_id") % 4 == 0, 1).otherwise(0).cast("decimal(18,2)").alias(
            "newbalanceOrig"
        ),
    )


def frame(df):
    return df.toPandas().sort_values("txn_id").reset_index(drop=True)


def assert_same(a, b):
    a, b = frame(a), frame(b)
    b = b[a.columns]
    for c in a.columns:
        if a[c].dtype.kind == "f":
            assert ((a[c] - b[c]).abs().fillna(0) < 1e-6).all(), c
            assert (a[c].isna() == b[c].isna()).all(), c
        else:
            assert ((a[c] == b[c]) | (a[c].isna() & b[c].isna())).all(), c


@pytest.mark.parametrize("seed,hot_rows", [(1, 10), (2, 31), (3, 64), (4, 150)])
def test_behavior_lanes_agree(spark, seed, hot_rows):
    df = skewed(spark, seed).cache()
    plain = w.behavior(df, hot_rows=None)
    split = w.behavior(df, hot_rows=hot_rows)
    assert hot_keys(df, ["nameOrig_hashed"], "txn_id", hot_rows) is not None
    assert_same(plain, split)


def test_plain_lane_when_nothing_is_hot(spark):
    df = skewed(spark, 5)
    assert hot_keys(df, ["nameOrig_hashed"], "txn_id", 10_000) is None
    plan = w.behavior(df, hot_rows=10_000)._jdf.queryExecution().executedPlan().toString()
    assert "Union" not in plan


def test_chunks_shorter_than_the_frame(spark):
    """A frame of 30 rows over chunks that would hold 5."""
    df = skewed(spark, 6)
    assert_same(
        w.behavior(df, ["recent", "volatility"], hot_rows=None),
        w.behavior(df, ["recent", "volatility"], hot_rows=5),
    )


@pytest.mark.parametrize("hot_rows", [8, 50])
def test_time_ordered_lanes_agree(spark, hot_rows):
    base = F.timestamp_add("SECOND", F.pmod("txn_id", F.lit(500_000)).cast("int"),
                           F.lit("2025-01-01 00:00:00").cast("timestamp_ntz"))
    df = skewed(spark, 7).withColumn("ts", base).cache()
    for operator in (w.sessionize, w.day_gap, w.account_age):
        assert_same(operator(df, hot_rows=None), operator(df, hot_rows=hot_rows))


def test_position_is_a_permutation(spark):
    df = skewed(spark, 8)
    out = position(df, ["nameOrig_hashed"], "step", "txn_id", "pos", 20)
    for _, part in out.toPandas().groupby("nameOrig_hashed", dropna=False):
        assert sorted(part["pos"]) == list(range(1, len(part) + 1))


def test_one_value_of_the_order_column(spark):
    """All rows of the hot key on one step, so only the tie can cut them."""
    df = skewed(spark, 9).withColumn("step", F.lit(3))
    assert_same(w.behavior(df, hot_rows=None), w.behavior(df, hot_rows=25))


def test_many_hot_keys_of_different_size(spark):
    ids = spark.range(2_000).select(
        F.col("id").alias("txn_id"),
        F.sqrt("id").cast("int").cast("string").alias("k"),
        (F.col("id") * 7 % 100).cast("int").alias("step"),
    )
    plain = position(ids, ["k"], "step", "txn_id", "pos", None)
    assert_same(plain, position(ids, ["k"], "step", "txn_id", "pos", 6))


@pytest.mark.parametrize("pieces", [1, 2, 7, 50])
def test_rank_equals_window(spark, pieces):
    df = skewed(spark, 10).withColumn("type", F.when(F.col("step") < 40, "A"))
    window = Window.partitionBy("type").orderBy(F.col("amount").desc())
    want = df.withColumn("r", F.rank().over(window))
    got = rank_within(df, "type", "amount", "r", pieces)
    assert_same(want.withColumn("r", F.col("r").cast("long")), got)


def test_framed_running_keeps_leading_nulls(spark):
    df = spark.createDataFrame(
        [(i, "k", i, None if i < 12 else i) for i in range(30)], "txn_id long, k string, s int, v int"
    )
    frames = Frames(running={"total": F.col("v")})
    plain = framed(df, ["k"], "s", "txn_id", frames, None)
    split = framed(df, ["k"], "s", "txn_id", frames, 5)
    assert_same(plain, split)
    assert frame(split)["total"].isna().sum() == 12


def test_small_copy_and_attach(spark):
    side = spark.range(20).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    assert small_copy(side, 19) is None
    assert small_copy(side, 20).count() == 20
    left = spark.range(5).select(F.col("id").alias("k"))
    for limit in (5, 100):
        out = attach(left, side, ["k"], limit)
        assert sorted((r.k, r.v) for r in out.collect()) == [(i, 2 * i) for i in range(5)]
    assert "Broadcast" in attach(left, side, ["k"], 100)._jdf.queryExecution().toString()


def test_match_joins_null_to_null(spark):
    a = spark.createDataFrame([(None, 1), ("x", 2)], "k string, a int")
    b = spark.createDataFrame([(None, 10)], "k string, b int")
    assert {(r.k, r.b) for r in match(a, b, ["k"]).collect()} == {(None, 10), ("x", None)}


def test_no_row_meets_all_cuts_of_a_long_key(spark, monkeypatch):
    """5,333 cuts: what is joined to each row stays near their square root, and ranks are exact."""
    tables = []

    def spied(df, label):
        tables.append((label, pinned(df, label)))
        return tables[-1][1]

    monkeypatch.setattr(spread, "pinned", spied)
    ids = spark.range(2_000).select(
        F.col("id").alias("txn_id"), F.lit("k").alias("k"), (F.col("id") * 7 % 900).cast("int").alias("step")
    )
    got = position(ids, ["k"], "step", "txn_id", "pos", 3)
    assert_same(position(ids, ["k"], "step", "txn_id", "pos", None), got)
    cuts = [df for label, df in tables if label == "cuts"]
    longest = [df.agg(F.max(F.size("__cuts"))).first()[0] for df in cuts]
    assert longest and max(longest) <= 100


def test_matches_read_their_rows_once(spark):
    """Rows may come from windows of their own, which numbering would compute anew each time."""
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    ids = spark.range(300).select(
        F.col("id").alias("txn_id"), (F.col("id") % 3).alias("k"), F.col("id").cast("int").alias("step")
    )
    rows = ids.mapInArrow(counted, ids.schema)
    twice = patterns.in_sequence([0, 1], 2)
    ends = patterns.match_ends(rows, ["k"], "step", "txn_id", F.col("step") % 2, twice, 20)
    # each k has steps k, k + 3, ...: symbols 0 and 1 in turn
    want = {(k, k + 3 * i) for k in range(3) for i in range(100) if (k + 3 * i) % 2 and (k % 2 == 0 or i > 0)}
    assert {(r.k, r.step) for r in ends.collect()} == want
    assert read.value == 300
