"""What must not get lost: steps beyond the calendar, repeated keys, swaps cut short."""

import shutil
import time

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallywatch.operators import dims, tables
from tallywatch.operators.spread import SLICES, Frames, _slice_plan, _sliced, framed, hot_keys, position
from tallywatch.plans import report
from tallywatch.queries import QUERIES
from tallywatch.sources import landing, store


def facts(spark, steps):
    rows = [(s, "PAYMENT", "Low", 10.0 + s, s % 2) for s in steps]
    df = spark.createDataFrame(rows, "step int, type string, type_risk_level string, amount double, isFraud int")
    return df.withColumn("amount", F.col("amount").cast("decimal(18,2)"))


def types_of(df):
    return df.select("type", "type_risk_level").distinct()


@pytest.mark.parametrize("calendar", ["own", "standard"])
def test_no_step_is_lost_in_the_mart(spark, calendar):
    df = facts(spark, [1, 744, 745, 900, 1001])
    dates = dims.dim_date_of(df) if calendar == "own" else dims.dim_date(spark)
    mart = report.daily_fraud(df, dates, types_of(df)).collect()
    assert sum(r.total_amount for r in mart) == df.agg(F.sum("amount")).first()[0]
    assert any(r.day_of_week is None for r in mart) == (calendar == "standard")
    steps = report.by_step(df, dates)
    assert {r.step for r in steps.collect()} == {1, 744, 745, 900, 1001}


def test_calendar_of_the_fact(spark):
    rows = {r.step: r for r in dims.dim_date_of(facts(spark, [1, 25, 900])).collect()}
    assert str(rows[1].calendar_date) == "2025-01-01" and str(rows[25].calendar_date) == "2025-01-02"
    assert str(rows[900].calendar_date) == "2025-02-07"
    inside = report.in_dates(facts(spark, [1, 900]), dims.dim_date_of(facts(spark, [1, 900])), "2025-02-01", "2025-03-01")
    assert [r.step for r in inside.collect()] == [900]


@pytest.fixture
def pair(spark):
    target = spark.createDataFrame([(1, "a"), (9, "z")], "k int, v string")
    return target, spark.createDataFrame([(1, "x"), (1, "y"), (2, "z")], "k int, v string")


@pytest.mark.parametrize(
    "operator",
    [
        lambda t, s, **o: tables.upsert(t, s, ["k"], **o),
        lambda t, s, **o: tables.insert_missing(t, s, ["k"], **o),
        lambda t, s, **o: tables.update_matched(t, s, ["k"], {"v": F.col("src_v")}, **o),
    ],
)
def test_repeated_source_keys(pair, operator):
    with pytest.raises(PySparkException, match="share a key"):
        operator(*pair).collect()
    rows = operator(*pair, order=["v"]).collect()
    assert len({r.k for r in rows}) == len(rows)


def test_null_keys_match_nothing(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    source = spark.createDataFrame([(None, "x"), (None, "y")], "k int, v string")
    assert tables.upsert(target, source, ["k"]).count() == 3


def test_a_swap_cut_short_is_made_good(spark, folder):
    path = f"{folder}/t"
    rows = [(1, "a", "d1"), (2, "b", "d1"), (3, "c", "d2")]
    store.write_table(spark.createDataFrame(rows, "k int, v string, d string"), path, partition_by=["d"])
    source = spark.createDataFrame([(1, "new", "d1")], "k int, v string, d string")

    swap = store.finish_swap
    store.finish_swap = lambda *_: False  # dies after the commit beside the table
    try:
        store.upsert_partitions(source, path, ["k"], "d")
    finally:
        store.finish_swap = swap
    shutil.rmtree(f"{path}/d=d1")  # as between delete and move
    store.upsert_partitions(source, path, ["k"], "d")
    got = sorted(tuple(r) for r in store.read_table(spark, path).select("k", "v", "d").collect())
    assert got == [(1, "new", "d1"), (2, "b", "d1"), (3, "c", "d2")]
    assert not store.finish_swap(spark, path, "d")


def test_dropped_column_is_a_change(spark):
    before = spark.createDataFrame([(1, "a", 5), (2, "b", None)], "k int, v string, w int")
    after = before.drop("w")
    changes = tables.change_set(before, after, ["k"]).collect()
    assert [(r.k, r.change_type, r.w) for r in changes] == [(1, "update", None)]


@pytest.mark.parametrize("start", ["T-", "a very long start that all of them share, number "])
def test_text_ties(spark, start):
    df = spark.range(3_000).select(
        F.concat(F.lit(start), F.lpad(F.col("id").cast("string"), 6, "0")).alias("tie"),
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        (F.col("id") * 7 % 5).cast("int").alias("step"),
    )
    window = Window.partitionBy("k").orderBy("step", "tie")
    want = {r.tie: r.n for r in df.withColumn("n", F.row_number().over(window)).collect()}
    for hot_rows in (None, 10_000, 150):
        got = position(df, ["k"], "step", "tie", "pos", hot_rows)
        assert {r.tie: r.pos for r in got.collect()} == want


def test_null_order_values_are_sliced(spark):
    df = spark.range(8_000).select(
        F.col("id").alias("tie"), F.lit("hot").alias("k"), F.when(F.col("id") % 2 == 0, F.col("id") % 40).alias("step")
    )
    hot = hot_keys(df, ["k"], "tie", 800, "step")
    from tallywatch.operators.spread import match

    sliced = _sliced(match(df, hot.table, ["k"], "inner"), ["k"], "step", "tie", hot)
    assert max(r["count"] for r in sliced.groupBy("__slice").count().collect()) < 4 * 800 / SLICES
    frames = Frames(position="n")
    a, b = ({r.tie: r.n for r in framed(df, ["k"], "step", "tie", frames, h).collect()} for h in (None, 800))
    assert a == b


def test_slice_plan_is_linear(spark):
    totals = spark.range(80_000).select(
        F.lit("k").alias("k"), F.col("id").alias("__slice"), F.lit(250).cast("long").alias("__n")
    )
    start = time.time()
    rows = _slice_plan(totals, ["k"], 30).agg(F.count("*"), F.sum(F.size("__chunks"))).first()
    assert rows[0] == 80_000 and rows[1] > 80_000
    assert time.time() - start < 20


def test_ids_of_several_runs_are_unique(spark):
    df = spark.range(1_000).repartition(7)
    runs = [landing.add_txn_id(df, f"run-{i}") for i in range(3)]
    ids = runs[0].union(runs[1]).union(runs[2]).select("txn_id")
    assert ids.distinct().count() == 3_000


@pytest.mark.parametrize("name", ["stream_velocity", "stream_sessions", "stream_upsert"])
def test_streams_read_a_folder_of_files(spark, folder, name):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.repartition(3).write.parquet(f"{folder}/events.parquet")
    got, want = (QUERIES[name](spark, d) for d in (folder, "/root/testdata/sf0.001"))
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_a_stream_without_rows_leaves_a_table(spark, folder):
    from tallywatch.streaming import streams

    (spark.createDataFrame([], "k int, v string")).write.parquet(f"{folder}/in")
    stream = spark.readStream.schema("k int, v string").parquet(f"{folder}/in")
    base = f"{folder}/t"
    streams.upsert_available(stream, base, ["k"], f"{folder}/mark", ["v"]).awaitTermination()
    assert store.read_version(spark, base).count() == 0


def test_state_is_dropped_behind_the_watermark(spark, folder):
    from tallywatch.streaming import streams

    schema = "account string, ts timestamp, amount double"

    def land(day):
        rows = f"select 'a' account, timestamp'2025-01-{day:02} 10:00:00' ts, 1.0D amount"
        spark.sql(rows).write.mode("append").parquet(f"{folder}/in")

    kept = []
    for day in range(1, 5):
        land(day)
        stream = spark.readStream.schema(schema).parquet(f"{folder}/in")
        result = streams.stream_velocity(stream, account="account")
        query = streams.upsert_available(
            result, f"{folder}/t", ["account", "window_start"], f"{folder}/mark", None, "update"
        )
        query.awaitTermination()
        kept.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    assert store.read_version(spark, f"{folder}/t").count() == 4 * 24
    assert max(kept) < 3 * 24
