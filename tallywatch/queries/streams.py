"""Streaming forms, run over all of ``events`` as a file stream until it is read."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallywatch import rules
from tallywatch.queries.base import register
from tallywatch.session import scratch_dir
from tallywatch.sources import store
from tallywatch.sources.events import read_events
from tallywatch.streaming import streams


def _event_stream(spark, d):
    schema = read_events(spark, d).schema
    # the table's own path: one file, or the folder of its files
    return spark.readStream.schema(schema).parquet(f"{d}/events.parquet*").select(
        F.col("user_id").alias("account"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("value").alias("amount"),
        F.col("event_id").alias("txn_id"),
    )


@register(
    "stream_velocity",
    """with t as (select user_id, value, date_trunc('hour', ts) as h from events),
    w as (select user_id as account, h - k * interval 1 hour as s, value
      from t, (select unnest(range(24)) as k) x)
    select account, strftime(s, '%Y-%m-%d %H:%M:%S') as window_start,
      count(value) as txns_last_24h,
      case when count(value) > 3 then 'High Velocity' else 'Normal' end as txn_velocity_level
    from w group by account, s""",
)
def stream_velocity(spark, d):
    path, mark = scratch_dir(spark, "velocity"), scratch_dir(spark, "velocity-mark")
    together = rules.VELOCITY_STEPS  # windows an hour apart: as many as overlap
    result = streams.stream_velocity(_event_stream(spark, d), account="account", together=together)
    result = result.withColumn("day", F.to_date("window_start"))
    keys, newest = ["account", "window_start"], ["txns_last_24h"]  # counts only grow
    query = streams.upsert_parts_available(
        result, path, keys, "day", mark, newest, "update", until="window_end", unique=True
    )
    query.awaitTermination()
    return store.read_table(spark, path).select(
        "account",
        F.col("window_start").cast("string").alias("window_start"),
        "txns_last_24h",
        "txn_velocity_level",
    )


@register(
    "stream_sessions",
    """with t as (select user_id, ts, lag(ts) over (partition by user_id order by ts, event_id) as p
      from events),
    s as (select user_id, ts, sum(case when p is null or date_diff('microsecond', p, ts) >= 3600000000
        then 1 else 0 end) over (partition by user_id order by ts rows unbounded preceding) as k
      from t)
    select user_id as account, strftime(min(ts), '%Y-%m-%d %H:%M:%S') as session_start,
      count(*) as txn_count from s group by user_id, k""",
)
def stream_sessions(spark, d):
    base, mark = scratch_dir(spark, "sessions"), scratch_dir(spark, "sessions-mark")
    result = streams.stream_sessions(_event_stream(spark, d), account="account")
    streams.replace_available(result, base, mark).awaitTermination()
    return store.read_version(spark, base).select(
        "account",
        F.date_format("session_start", "yyyy-MM-dd HH:mm:ss").alias("session_start"),
        "txn_count",
    )


@register(
    "stream_upsert",
    "with t as (select event_id, user_id, value from events) "
    "select event_id as txn_id, user_id as account, value as amount from t",
)
def stream_upsert(spark, d):
    # the same files twice, as after a lost checkpoint: the second run changes nothing
    path = scratch_dir(spark, "upsert")
    for _ in range(2):
        mark = scratch_dir(spark, "upsert-mark")
        stream = _event_stream(spark, d).withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
        query = streams.upsert_parts_available(stream, path, ["txn_id"], "day", mark, ["ts"])
        query.awaitTermination()
    return store.read_table(spark, path).select("txn_id", "account", "amount")


@register(
    "stream_match",
    """with t as (select * from events),
    o as (select event_id as out_id, ts, concat('C', event_id % 89) as account from t
      where event_type = 'view' and event_id % 3 <> 0),
    i as (select event_id as in_id, ts, concat('C', user_id) as account from t where event_type = 'click'),
    p as (select out_id, in_id from o join i on o.account = i.account
      and i.ts >= o.ts and i.ts <= o.ts + interval 24 hour),
    m as (select least((select max(ts) from o), (select max(ts) from i)) - interval 2 hour as until)
    select out_id, in_id from p
    union all
    select out_id, null from o, m
    where o.ts + interval 24 hour < until and out_id not in (select out_id from p)""",
)
def stream_match(spark, d):
    # transfers to an account and what it cashes out within a day
    schema = read_events(spark, d).schema

    def side(kind):
        events = spark.readStream.schema(schema).parquet(f"{d}/events.parquet*")
        return events.filter(F.col("event_type") == kind).withColumn("ts", F.col("ts").cast("timestamp"))

    received = side("view").filter("event_id % 3 <> 0").select(
        F.col("event_id").alias("out_id"),
        F.concat(F.lit("C"), (F.col("event_id") % 89).cast("string")).alias("account"),
        "ts",
    )
    cashed = side("click").select(
        F.col("event_id").alias("in_id"),
        F.concat(F.lit("C"), F.col("user_id").cast("string")).alias("incoming_account"),
        F.col("ts").alias("incoming_ts"),
    )
    path, mark = scratch_dir(spark, "match"), scratch_dir(spark, "match-mark")
    result = streams.stream_match(received, cashed).select("out_id", "in_id")
    streams.append_available(result, path, mark).awaitTermination()
    return spark.read.schema("out_id long, in_id long").parquet(path)
