"""Write semantics and account history."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tallywatch.operators import dims, tables
from tallywatch.operators.quality import IntegrityError
from tallywatch.queries import tables as queries
from tallywatch.session import scratch_dir
from tallywatch.sources import store
from tests.conftest import rows

RUNS = [f"2025-01-0{i} 00:00:00" for i in range(1, 5)]


def kv(spark, *pairs):
    return spark.createDataFrame(list(pairs), "k int, v string")


def content(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_upsert_twice_is_upsert_once(spark):
    target, source = kv(spark, (1, "a"), (2, "b")), kv(spark, (2, "B"), (3, "C"))
    once = tables.upsert(target, source, ["k"])
    assert content(once) == [(1, "a"), (2, "B"), (3, "C")]
    assert content(tables.upsert(once, source, ["k"])) == content(once)
    assert content(tables.upsert(target, source.limit(0), ["k"])) == content(target)


def test_upsert_with_duplicate_source_keys(spark):
    target, source = kv(spark, (1, "a")), kv(spark, (1, "y"), (1, "x"))
    assert content(tables.upsert(target, source, ["k"], order=["v"])) == [(1, "x")]
    with pytest.raises(IntegrityError):
        tables.upsert(target, source, ["k"], strict=True)


def test_upsert_widens_only_when_allowed(spark):
    target = kv(spark, (1, "a"))
    source = kv(spark, (2, "b")).withColumn("w", F.lit(9))
    wide = tables.upsert(target, source, ["k"], allow_new_columns=True)
    assert content(wide) == [(1, "a", None), (2, "b", 9)]
    with pytest.raises(Exception, match="w"):
        tables.upsert(target, source, ["k"]).collect()


def test_insert_missing_keeps_existing(spark):
    out = tables.insert_missing(kv(spark, (1, "a")), kv(spark, (1, "X"), (2, "b"), (2, "c")), ["k"], order=["v"])
    assert content(out) == [(1, "a"), (2, "b")]


def test_update_matched(spark):
    out = tables.update_matched(
        kv(spark, (1, "a"), (2, "b"), (3, None)),
        kv(spark, (2, "B"), (3, "C"), (4, "D")),
        ["k"],
        {"v": F.col("src_v")},
        when=F.col("v").isNotNull(),
    )
    assert content(out) == [(1, "a"), (2, "B"), (3, None)]


def test_change_set_round_trip(spark):
    before = kv(spark, (1, "a"), (2, "b"), (3, None), (4, None))
    after = kv(spark, (1, "a"), (2, "B"), (3, None), (4, "d"), (5, None))
    changes = tables.change_set(before, after, ["k"])
    assert {(r.change_type, r.k) for r in changes.collect()} == {
        ("update", 2), ("update", 4), ("insert", 5),
    }
    assert content(tables.apply_changes(before, changes, ["k"])) == content(after)
    back = tables.change_set(after, before, ["k"])
    assert content(tables.apply_changes(after, back, ["k"])) == content(before)


def test_versions(spark, folder):
    base = f"{folder}/t"
    assert store.read_version(spark, base) is None
    store.commit(kv(spark, (1, "a")), base)
    current = store.read_version(spark, base)
    assert store.commit(tables.upsert(current, kv(spark, (1, "b")), ["k"]), base) == 1
    assert content(store.read_version(spark, base)) == [(1, "b")]
    assert content(store.read_version(spark, base, 0)) == [(1, "a")]
    # a job that died: data without the commit mark
    kv(spark, (9, "z")).write.parquet(f"{base}/version=2")
    os.remove(f"{base}/version=2/_SUCCESS")
    assert content(store.read_version(spark, base)) == [(1, "b")]
    assert store.commit(kv(spark, (1, "c")), base) == 2
    assert content(store.read_version(spark, base)) == [(1, "c")]


def test_materialize(spark, folder):
    first = store.materialize(kv(spark, (1, "a"), (2, "b")), f"{folder}/m", ["k"]).first()
    again = store.materialize(kv(spark, (2, "B"), (3, "c")), f"{folder}/m", ["k"]).first()
    assert tuple(first) == (0, 2, 2, True) and tuple(again) == (2, 3, 1, False)


def test_partition_upsert_leaves_other_partitions_alone(spark, folder):
    path = f"{folder}/p"
    df = spark.range(60).select("id", (F.col("id") % 3).cast("int").alias("p"), F.lit("old").alias("v"))
    store.write_table(df, path, partition_by=["p"])
    untouched = sorted(os.listdir(f"{path}/p=0"))
    source = df.filter("p = 1 and id < 10").withColumn("v", F.lit("new"))
    source = source.unionByName(spark.sql("select 100L as id, 7 as p, 'new' as v"))
    for _ in range(2):  # the second run changes nothing
        store.upsert_partitions(source, path, ["id"], "p")
        got = {r.id: (r.p, r.v) for r in store.read_table(spark, path).collect()}
        assert len(got) == 61 and got[100] == (7, "new")
        assert {i for i, (_, v) in got.items() if v == "new"} == {1, 4, 7, 100}
    assert sorted(os.listdir(f"{path}/p=0")) == untouched


def test_clustered_files_do_not_overlap(spark, folder):
    df = spark.range(1000).select((F.col("id") * 37 % 100).alias("a"), "id")
    store.write_table(tables.compact_cluster(df, ["a", "id"], 4), f"{folder}/c")
    files = store.read_table(spark, f"{folder}/c").groupBy(F.input_file_name()).agg(
        F.min("a").alias("lo"), F.max("a").alias("hi")
    ).orderBy("lo", "hi").collect()
    assert len(files) == 4
    assert all(x.hi <= y.lo for x, y in zip(files, files[1:]))


def test_tags_survive_parquet(spark, folder):
    store.write_table(tables.tag_columns(kv(spark, (1, "a")), {"v": "PII"}), f"{folder}/t")
    assert store.read_table(spark, f"{folder}/t").schema["v"].metadata == {"comment": "PII"}


def test_scratch_uses_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    a, b = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert a != b and a.startswith(base)


# -- account history -----------------------------------------------------------------


def states(spark, *data):
    """(account, segment, step)"""
    schema = "nameOrig_hashed string, customer_segment string, step int"
    df = spark.createDataFrame(list(data), schema)
    return df.withColumns({
        "account_activity": F.lit("New Account"),
        "account_audit_status": F.lit("Clean"),
        "txn_id": F.monotonically_increasing_id(),
    })


def facts(dim):
    return sorted(
        (r.nameOrig_hashed, r.customer_segment or "", r.is_current, str(r.start_date)[:10], str(r.end_date)[:10])
        for r in dim.collect()
    )


def check_history(dim):
    spans = {}
    for r in dim.collect():
        spans.setdefault(r.nameOrig_hashed, []).append((r.start_date, r.end_date, r.is_current))
    for versions in spans.values():
        versions.sort()
        assert [c for *_, c in versions] == [False] * (len(versions) - 1) + [True]
        assert all(a[1] == b[0] for a, b in zip(versions, versions[1:]))
    keys = [r.account_sk for r in dim.collect()]
    assert len(keys) == len(set(keys))


def test_scd2_history(spark):
    first = states(spark, ("same", "Gold", 1), ("turns", "Gold", 1), ("gone", "Gold", 1),
                   ("null", None, 1), (None, "Gold", 1), ("turns", "Standard", 0))
    second = states(spark, ("same", "Gold", 2), ("turns", "Platinum", 2), ("new", "Gold", 2), ("null", "Gold", 2))
    third = states(spark, ("null", None, 3), ("turns", "Platinum", 3))
    dim = dims.dim_account(first, RUNS[0])
    assert dim.count() == 4
    for batch, run in ((second, RUNS[1]), (third, RUNS[2])):
        staged = dims.scd2_stage(dims.account_states(batch), dim)
        stepwise = dims.scd2_apply(dim, staged, run)
        dim = dims.scd2_update(dim, batch, run)
        assert sorted(map(tuple, dim.collect()), key=str) == sorted(map(tuple, stepwise.collect()), key=str)
        check_history(dim)
    assert facts(dim) == [
        ("gone", "Gold", True, "2025-01-01", "None"),
        ("new", "Gold", True, "2025-01-02", "None"),
        ("null", "", False, "2025-01-01", "2025-01-02"),
        ("null", "", True, "2025-01-03", "None"),
        ("null", "Gold", False, "2025-01-02", "2025-01-03"),
        ("same", "Gold", True, "2025-01-01", "None"),
        ("turns", "Gold", False, "2025-01-01", "2025-01-02"),
        ("turns", "Platinum", True, "2025-01-02", "None"),
    ]
    again = dims.scd2_update(dim, third, RUNS[3])
    assert facts(again) == facts(dim)


def test_duplicate_current_rows_are_repaired_by_row(spark):
    a = dims.dim_account(states(spark, ("x", "Gold", 1), ("y", "Gold", 1)), RUNS[0])
    b = dims.dim_account(states(spark, ("x", "Platinum", 1)), RUNS[1])
    fixed = dims.scd2_dedupe_current(a.unionByName(b).unionByName(b), RUNS[2])
    assert fixed.count() == 4
    current = fixed.filter("is_current").collect()
    assert sorted(r.nameOrig_hashed for r in current) == ["x", "y"]


def test_lookup_takes_the_valid_version(spark):
    dim = dims.dim_account(states(spark, ("x", "Gold", 1)), RUNS[1])
    dim = dims.scd2_update(dim, states(spark, ("x", "Platinum", 2)), RUNS[2])
    at = spark.createDataFrame(
        [(i, n, dt.datetime(2025, 1, i)) for i, n in ((1, "x"), (2, "x"), (3, "x"), (4, "x"), (4, None))],
        "txn_id int, nameOrig_hashed string, at timestamp",
    )
    found = dims.lookup_account(at, dim, "at").join(dim.select("account_sk", "customer_segment"), "account_sk", "left")
    assert rows(found.select("txn_id", "nameOrig_hashed", "customer_segment"), "txn_id", "nameOrig_hashed") == [
        {"txn_id": 1, "nameOrig_hashed": "x", "customer_segment": None},
        {"txn_id": 2, "nameOrig_hashed": "x", "customer_segment": "Gold"},
        {"txn_id": 3, "nameOrig_hashed": "x", "customer_segment": "Platinum"},
        {"txn_id": 4, "nameOrig_hashed": None, "customer_segment": None},
        {"txn_id": 4, "nameOrig_hashed": "x", "customer_segment": "Platinum"},
    ]


def test_calendar(spark):
    cal = dims.dim_date(spark)
    assert cal.count() == 744
    first, last = cal.orderBy("step").first(), cal.orderBy(F.col("step").desc()).first()
    assert (str(first.calendar_date), first.day_name, first.day_of_week, first.hour_of_day) == ("2025-01-01", "Wednesday", 4, 0)
    assert (str(last.calendar_date), last.hour_of_day, last.temporal_risk_bucket) == ("2025-01-31", 23, "High Risk")


def test_landed_files_are_of_bounded_length(spark, folder, monkeypatch):
    """One file as long as it is short; no task writes all rows of a longer table."""
    events = spark.range(500).selectExpr(
        "id as event_id",
        "timestamp_ntz'2024-01-01 00:00:00' as ts",
        "id % 7 as user_id",
        "'click' as event_type",
        "cast(id as double) as value",
        "'' as props",
    )
    events.write.parquet(f"{folder}/events.parquet")
    short = queries._landed(spark, folder, "short", 1)
    monkeypatch.setattr(queries, "FILE_ROWS", 100, raising=False)
    longer = queries._landed(spark, folder, "longer", 1)
    sizes = [
        sorted(r["count"] for r in df.groupBy("_metadata.file_path").count().collect())
        for df in (queries._read_back(spark, path) for path in (short, longer))
    ]
    assert sizes[0] == [500]
    assert len(sizes[1]) == 5 and sum(sizes[1]) == 500 and max(sizes[1]) <= 120
