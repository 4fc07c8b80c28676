"""Streaming forms: restart, archive, late rows, agreement with the batch form."""

import datetime as dt
import os

from pyspark.sql import functions as F

import pytest

from tallywatch.operators import quality
from tallywatch.queries import QUERIES
from tallywatch.schemas import CORRUPT, SOURCE
from tallywatch.sources import landing, store
from tallywatch.streaming import streams
from tests.conftest import rows

HEADER = "txn_id,step,type,amount,nameOrig,oldbalanceOrg,newbalanceOrig,nameDest,oldbalanceDest,newbalanceDest,isFraud,isFlaggedFraud\n"
GOOD = "{},1,TRANSFER,10.50,C1,20.00,9.50,M1,0,0,0,0\n"


def land(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write(text)


def landed(folder):
    land(folder, "a.csv", HEADER + GOOD.format(1) + GOOD.format(2))
    land(folder, "b.csv", HEADER + GOOD.format(3) + "x,1,TRANSFER,much,C1,20.00,9.50,M1,0,0,0,0\n")
    land(folder, "empty.csv", HEADER)
    land(folder, "notes.txt", "not a table\n")
    return folder


def test_landing_reads_csv_only_and_keeps_bad_lines(spark, folder):
    df = landing.read_landing(spark, landed(f"{folder}/in"))
    got = rows(df, "txn_id")
    assert [r["txn_id"] for r in got] == [1, 2, 3, None]
    assert got[3]["amount"] is None and got[3][CORRUPT].startswith("x,1,TRANSFER")
    audited = landing.add_audit_cols(df, "run", "2025-01-01 00:00:00")
    files = {os.path.basename(r.source_file) for r in audited.select("source_file").collect()}
    assert files == {"a.csv", "b.csv"}
    row = audited.first()
    assert (row.status, row.is_pii_flag, row.job_run_id) == ("New", True, "run")


def test_landing_without_csv_fails_the_gate(spark, folder):
    land(f"{folder}/in", "notes.txt", "nothing\n")
    report = quality.gate(landing.read_landing(spark, f"{folder}/in"))
    assert report.first()["is_empty"]


def test_header_in_another_order_is_an_error(spark, folder):
    first, *rest = HEADER.split(",")
    swapped = ",".join([rest[0], first, *rest[1:]])
    land(f"{folder}/in", "a.csv", swapped + GOOD.format(1))
    try:
        landing.read_landing(spark, f"{folder}/in").collect()
    except Exception as error:
        assert "header" in str(error).lower()
    else:
        raise AssertionError("read by position")


def test_ids_for_files_without_one(spark, folder):
    text = HEADER.split(",", 1)[1] + "".join(GOOD.format(0).split(",", 1)[1] for _ in range(50))
    land(f"{folder}/in", "a.csv", text)
    df = landing.add_txn_id(landing.read_landing(spark, f"{folder}/in", SOURCE), "run")
    assert df.select("txn_id").distinct().count() == 50


def test_landing_stream_restarts_without_rereading(spark, folder):
    source, archive = landed(f"{folder}/in"), f"{folder}/done"
    args = (f"{folder}/bronze", f"{folder}/mark")

    def run():
        stream = streams.landing_stream(spark, source, archive=archive)
        streams.append_available(stream, *args).awaitTermination()
        return spark.read.parquet(args[0]).count()

    assert run() == 4
    assert run() == 4
    land(source, "c.csv", HEADER + GOOD.format(9))
    assert run() == 5
    assert os.path.exists(f"{source}/notes.txt")
    moved = [f for _, _, files in os.walk(archive) for f in files]
    assert {"a.csv", "b.csv"} <= set(moved)


def events(spark, folder, name, *data):
    df = spark.createDataFrame(
        [(i, a, dt.datetime(2025, 1, 1) + dt.timedelta(minutes=m), 1.0) for i, a, m in data],
        "txn_id long, nameOrig_hashed string, ts timestamp, amount double",
    )
    df.coalesce(1).write.mode("append").parquet(f"{folder}/{name}")
    return f"{folder}/{name}"


def stream(spark, path):
    schema = "txn_id long, nameOrig_hashed string, ts timestamp, amount double"
    return spark.readStream.schema(schema).parquet(path)


def test_stream_upsert_equals_batch(spark, folder):
    path = events(spark, folder, "in", (1, "a", 0), (2, "a", 1))
    base, mark = f"{folder}/t", f"{folder}/mark"
    for extra in ((2, "b", 5), (3, "c", 6)):
        streams.upsert_available(stream(spark, path), base, ["txn_id"], mark, ["ts"]).awaitTermination()
        events(spark, folder, "in", extra)
    streams.upsert_available(stream(spark, path), base, ["txn_id"], mark, ["ts"]).awaitTermination()
    got = store.read_version(spark, base).select("txn_id", "nameOrig_hashed").collect()
    assert sorted(map(tuple, got)) == [(1, "a"), (2, "b"), (3, "c")]


def test_late_rows_are_dropped(spark, folder):
    path = events(spark, folder, "in", (1, "a", 0), (2, "a", 600))
    out, mark = f"{folder}/out", f"{folder}/mark"

    def run():
        result = streams.stream_sessions(stream(spark, path), late="30 minutes")
        streams.append_available(result, out, mark).awaitTermination()

    run()
    events(spark, folder, "in", (3, "a", 10), (4, "a", 590))  # 3 is past the watermark
    run()
    events(spark, folder, "in", (5, "a", 2000))
    run()
    got = spark.read.parquet(out).orderBy("session_start").collect()
    assert [r.txn_count for r in got] == [1, 2]


def test_stream_velocity_equals_counting(spark, folder):
    minutes = [0, 30, 61, 62, 1500, 1501]
    path = events(spark, folder, "in", *[(i, "a", m) for i, m in enumerate(minutes)])
    result = streams.stream_velocity(stream(spark, path))
    streams.replace_available(result, f"{folder}/v", f"{folder}/mark").awaitTermination()
    got = store.read_version(spark, f"{folder}/v").collect()
    start = dt.datetime(2025, 1, 1)
    for r in got:
        inside = [m for m in minutes if r.window_start <= start + dt.timedelta(minutes=m) < r.window_end]
        assert r.txns_last_24h == len(inside)
        assert r.txn_velocity_level == ("High Velocity" if len(inside) > 3 else "Normal")
    assert sum(r.txns_last_24h for r in got) == 24 * len(minutes)


def test_stream_sessions_equal_batch_count(spark, folder):
    path = events(spark, folder, "in", *[(i, "a", m) for i, m in enumerate((0, 59, 118, 200, 259))])
    result = streams.stream_sessions(stream(spark, path))
    streams.replace_available(result, f"{folder}/s", f"{folder}/mark").awaitTermination()
    got = store.read_version(spark, f"{folder}/s").orderBy("session_start").collect()
    assert [r.txn_count for r in got] == [3, 2]
    spans = [(r.session_end - r.session_start) for r in got]
    assert spans == [dt.timedelta(minutes=178), dt.timedelta(minutes=119)]


def sides(spark, folder):
    a = stream(spark, f"{folder}/out").select(F.col("txn_id").alias("o"), F.col("nameOrig_hashed").alias("account"), "ts")
    b = stream(spark, f"{folder}/in").select(
        F.col("txn_id").alias("i"), F.col("nameOrig_hashed").alias("incoming_account"), F.col("ts").alias("incoming_ts")
    )
    return streams.stream_match(a, b).select("o", "i")


def test_stream_match_emits_pairs_and_then_the_unmatched(spark, folder):
    """State shrinks behind the watermark, late rows are dropped, unmatched rows come once."""
    path, mark = f"{folder}/pairs", f"{folder}/mark"
    day = 24 * 60

    def run():
        query = streams.append_available(sides(spark, folder), path, mark)
        query.awaitTermination()
        state = query.recentProgress[-1].stateOperators[0]
        dropped = sum(p.stateOperators[0].numRowsDroppedByWatermark for p in query.recentProgress)
        return state.numRowsTotal, dropped

    events(spark, folder, "out", (1, "a", 0), (2, "b", 10), (3, None, 20))
    events(spark, folder, "in", (10, "a", day), (11, "a", day + 1), (12, "b", 9), (13, None, 30))
    first, _ = run()
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [(1, 10)]
    events(spark, folder, "out", (4, "c", 3 * day))
    events(spark, folder, "in", (14, "z", 3 * day))
    second, _ = run()
    got = sorted((r.o, r.i or 0) for r in spark.read.parquet(path).collect())
    assert got == [(1, 10), (2, 0), (3, 0)]
    assert second < first
    events(spark, folder, "out", (5, "a", 30))  # far behind the watermark
    events(spark, folder, "in", (15, "c", 3 * day + 60))
    _, dropped = run()
    assert dropped >= 1
    got = sorted((r.o, r.i or 0) for r in spark.read.parquet(path).collect())
    assert got == [(1, 10), (2, 0), (3, 0), (4, 15)]


def test_velocity_by_partition_rewrites_only_the_days_it_touches(spark, folder):
    path = events(spark, folder, "in", (1, "a", 0), (2, "a", 30))
    table, mark = f"{folder}/v", f"{folder}/mark"

    def run():
        result = streams.stream_velocity(stream(spark, path))
        result = result.withColumn("day", F.date_format("window_start", "yyyy-MM-dd"))
        keys, newest = ["nameOrig_hashed", "window_start"], ["txns_last_24h"]
        streams.upsert_parts_available(result, table, keys, "day", mark, newest, "update").awaitTermination()
        files = {}
        for folder_, _, names in os.walk(table):
            files.setdefault(os.path.basename(folder_), set()).update(n for n in names if n.endswith(".parquet"))
        return files

    before = run()
    events(spark, folder, "in", (3, "a", 5 * 24 * 60))
    after = run()
    assert after["day=2024-12-31"] == before["day=2024-12-31"]
    got = store.read_table(spark, table).groupBy().agg(F.sum("txns_last_24h")).first()[0]
    assert got == 24 * 3


def test_a_batch_is_computed_once(spark, folder):
    """Its state would be restored and saved again for each use of the batch."""
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    spark.range(50).selectExpr("id", "id % 2 as p", "id as n").write.parquet(f"{folder}/in")
    rows = spark.readStream.schema("id long, p long, n long").parquet(f"{folder}/in")
    rows = rows.mapInArrow(counted, rows.schema)
    path = f"{folder}/table"
    streams.upsert_parts_available(rows, path, ["id"], "p", f"{folder}/mark", ["n"]).awaitTermination()
    assert spark.read.parquet(path).count() == 50
    assert read.value == 50


def velocity(spark, folder, name, together, mode="update", **windows):
    """The table of a velocity stream over ``folder/in`` after one more run."""
    table, mark = f"{folder}/{name}", f"{folder}/{name}-mark"
    result = streams.stream_velocity(stream(spark, f"{folder}/in"), together=together, **windows)
    if mode == "complete":
        query = streams.replace_available(result, table, mark)
        query.awaitTermination()
        df = store.read_version(spark, table)
    else:
        result = result.withColumn("day", F.to_date("window_start"))
        keys = ["nameOrig_hashed", "window_start"]
        unique = {"unique": True, "until": "window_end"} if together > 1 else {}
        query = streams.upsert_parts_available(
            result, table, keys, "day", mark, ["txns_last_24h"], "update", **unique
        )
        query.awaitTermination()
        df = store.read_table(spark, table).drop("day")
    return sorted(map(tuple, df.collect()), key=str), query


@pytest.mark.parametrize(
    "together, windows",
    [
        (24, {}),
        (5, {"span": "100 minutes", "slide": "40 minutes"}),
        (2, {"span": "1 hour", "slide": "1 hour"}),
    ],
)
def test_windows_kept_together_give_the_same_counts(spark, folder, together, windows):
    path = events(spark, folder, "in", *[(i, "abc"[i % 3], i * i % 4000 - 1000) for i in range(60)])
    odd = [(None, "a", 1.0), (0, "b", None), (20_000, "d", None), (7, None, 1.0), (8, None, 2.0)]
    start = dt.datetime(2025, 1, 1)
    rows = [(100, a, None if m is None else start + dt.timedelta(minutes=m), v) for m, a, v in odd]
    schema = "txn_id long, nameOrig_hashed string, ts timestamp, amount double"
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    want, _ = velocity(spark, folder, "one", 1, "complete", **windows)
    assert len(want) > 20 and any(r[3] == 0 for r in want)
    got, _ = velocity(spark, folder, "together", together, "complete", **windows)
    assert got == want


def test_late_rows_stay_out_of_closed_windows_kept_together(spark, folder):
    """After each run the table is that of a state with one row for each window."""
    first = -24 * 20089  # 1970 begins, and with it the watermark
    hours = [[first - 3, first + 1], [0, 5, 30], [10, 12, 31], [3, 6, 29, 60], [30, 37, 41, 59], [200], [190, 199]]
    for run, batch in enumerate(hours):
        events(spark, folder, "in", *[(100 * run + i, "ab"[i % 2], 60 * h + 1) for i, h in enumerate(batch)])
        want, plain = velocity(spark, folder, "one", 1)
        got, query = velocity(spark, folder, "together", 24)
        assert got == want
    state = [q.lastProgress["stateOperators"][0]["numRowsTotal"] for q in (plain, query)]
    assert state[1] < state[0] / 5  # older blocks have left it


def test_the_velocity_query_keeps_two_state_rows_an_event(spark, folder, monkeypatch):
    start = dt.datetime(2024, 1, 10)
    data = [(i, start + dt.timedelta(minutes=517 * i), i % 3, "view", 1.0, "") for i in range(40)]
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame(data, schema).write.parquet(f"{folder}/events.parquet")
    queries, begin = [], streams.upsert_parts_available
    monkeypatch.setattr(
        streams, "upsert_parts_available", lambda *a, **o: queries.append(begin(*a, **o)) or queries[0]
    )
    got = QUERIES["stream_velocity"](spark, folder)
    assert got.agg(F.sum("txns_last_24h")).first()[0] == 24 * len(data)
    states = [p["stateOperators"][0]["numRowsUpdated"] for p in queries[0].recentProgress]
    assert sum(states) <= 2 * len(data)


def test_a_unique_batch_is_computed_and_written_once(spark, folder, monkeypatch):
    read, written = spark.sparkContext.accumulator(0), []
    write = store.write_table
    monkeypatch.setattr(store, "write_table", lambda *a, **o: written.append(a) or write(*a, **o))

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    def run(first, last):
        data = spark.range(first, last).selectExpr("id", "id div 10 as p", f"{first} as n")
        data.withColumn("n", F.col("n").cast("long")).write.mode("append").parquet(f"{folder}/in")
        rows = spark.readStream.schema("id long, p long, n long").parquet(f"{folder}/in")
        rows = rows.mapInArrow(counted, rows.schema)
        written.clear()
        streams.upsert_parts_available(
            rows, f"{folder}/table", ["id"], "p", f"{folder}/mark", ["n"], unique=True
        ).awaitTermination()
        got = store.read_table(spark, f"{folder}/table").select("id", "n").collect()
        assert sorted(os.listdir(folder)) == ["in", "mark", "table"]
        return {r.id: r.n for r in got}, len(written), read.value

    assert run(0, 50) == ({i: 0 for i in range(50)}, 2, 50)  # the empty table, then the batch
    assert run(50, 60)[1:] == (1, 60)
    after, writes, seen = run(35, 70)  # 35 to 59 are there
    assert after == {**{i: 0 for i in range(35)}, **{i: 35 for i in range(35, 70)}}
    assert (writes, seen) == (2, 95)


@pytest.mark.parametrize("unique", [False, True])
def test_partitions_that_are_moved_in_have_the_types_of_the_table(spark, folder, unique):
    path = f"{folder}/t"
    store.write_table(spark.sql("select 1L k, 2.5D v, 'a' p"), path, partition_by=["p"])
    for row in ("2 k, 3.5F v, 'b' p", "1 k, 4.5F v, 'a' p"):
        store.upsert_partitions(spark.sql(f"select {row}"), path, ["k"], "p", unique=unique)
    got = spark.read.schema("k long, v double, p string").parquet(path)
    assert sorted(map(tuple, got.collect())) == [(1, 4.5, "a"), (2, 3.5, "b")]
    each = [spark.read.parquet(f"{path}/p={p}").dtypes for p in "ab"]
    assert each == [[("k", "bigint"), ("v", "double")]] * 2
