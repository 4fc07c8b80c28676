"""Streaming forms: file landing, incremental upsert, velocity, sessions, matching.

Stateful queries need a watermark; rows later than it are dropped by Spark and
do not reach the result. State is kept per group and window only.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tallywatch import rules
from tallywatch.operators.tables import upsert
from tallywatch.schemas import CORRUPT, LANDING
from tallywatch.session import pinned
from tallywatch.sources import store
from tallywatch.sources.landing import CSV_ONLY

# -- landing -------------------------------------------------------------------


def landing_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType = LANDING,
    *,
    glob: str = CSV_ONLY,
    archive: str | None = None,
) -> DataFrame:
    """CSV files as they land. With ``archive``, read files are moved there.

    Files of the last batch move when the next run starts; no file is read twice.
    """
    reader = (
        spark.readStream.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("pathGlobFilter", glob)
    )
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.csv(path)


def append_available(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append everything available now to a parquet table, then stop."""
    return (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .option("path", path)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


# -- upsert ----------------------------------------------------------------------


def _each_batch(
    stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, mode: str
) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .outputMode(mode)
        .trigger(availableNow=True)
        .start()
    )


def _begin(result: DataFrame, base: str) -> None:
    """An empty first version, so that a stream without rows leaves a table too."""
    spark = result.sparkSession
    if store.read_version(spark, base) is None:
        store.commit(spark.createDataFrame([], result.schema), base)


def _still_open(batch: DataFrame, number: int, checkpoint: str, until: str | None) -> DataFrame:
    """Rows whose time ``until`` lies behind the watermark are left out.

    It is the watermark by which Spark drops the batch's late rows: that of the batch
    before, which stands in the checkpoint.
    """
    if until is None:
        return batch
    passed = 0  # where Spark's watermark begins
    if number > 0:
        log = batch.sparkSession.read.text(f"{checkpoint}/offsets/{number - 1}", wholetext=True)
        passed = json.loads(log.first()[0].splitlines()[1])["batchWatermarkMs"]
    return batch.filter(F.col(until) > F.timestamp_millis(F.lit(passed)))


def upsert_available(
    stream: DataFrame,
    base: str,
    keys: Sequence[str],
    checkpoint: str,
    order: Sequence[str] | None,
    mode: str = "append",
    *,
    until: str | None = None,
) -> StreamingQuery:
    """Upsert what is available now into a versioned table, one version per batch.

    A batch that is repeated after a failure gives the same table. ``order``
    decides between rows of one batch that share a key. An aggregation in ``update``
    mode brings the groups that changed; those behind the watermark leave the state.
    ``until`` is for groups that hold windows together: a window whose end, in that
    column, is behind the watermark stays as it is in the table.
    """
    _begin(stream, base)

    def apply(batch: DataFrame, number: int) -> None:
        batch = _still_open(batch, number, checkpoint, until)
        batch = pinned(batch, "batch")  # read twice: its state is to be updated once
        current = store.read_version(batch.sparkSession, base)
        store.commit(upsert(current, batch, keys, order=order), base)

    return _each_batch(stream, apply, checkpoint, mode)


def upsert_parts_available(
    stream: DataFrame,
    path: str,
    keys: Sequence[str],
    partition_col: str,
    checkpoint: str,
    order: Sequence[str],
    mode: str = "append",
    *,
    until: str | None = None,
    unique: bool = False,
) -> StreamingQuery:
    """The same into a partitioned table: a batch rewrites the partitions it touches.

    For an aggregation use ``mode="update"`` and a partition column made from its group;
    if ``keys`` are its groups, no two rows of a batch share one, and ``unique`` says so.
    """
    spark = stream.sparkSession
    if not store.table_exists(spark, path):
        first = spark.createDataFrame([], stream.schema)
        store.write_table(first, path, partition_by=[partition_col])

    def apply(batch: DataFrame, number: int) -> None:
        batch = _still_open(batch, number, checkpoint, until)
        if not unique:
            batch = pinned(batch, "batch")
        store.upsert_partitions(
            batch, path, keys, partition_col, order=order, schema=stream.schema, unique=unique
        )

    return _each_batch(stream, apply, checkpoint, mode)


# -- windows over event time --------------------------------------------------------


def _micros(spark: SparkSession, duration: str) -> int:
    """Length of a duration as ``window`` reads it."""
    window = F.window(F.timestamp_micros(F.lit(0)), duration)
    one = spark.sql("select 1").select(window.alias("w"))
    return one.select(F.unix_micros("w.end") - F.unix_micros("w.start")).first()[0]


def stream_velocity(
    stream: DataFrame,
    *,
    account: str = "nameOrig_hashed",
    ts: str = "ts",
    span: str = f"{rules.VELOCITY_STEPS} hours",
    slide: str = "1 hour",
    late: str = "2 hours",
    together: int = 1,
) -> DataFrame:
    """Transactions with an amount per account in sliding windows.

    ``together`` is how many windows that follow each other share a row of the state. With
    as many as overlap, a transaction is counted in two such rows instead of one for each
    window. They leave the state, and come out in append mode, when the last of them is
    behind the watermark; in update mode they all come when one changes, so name
    ``window_end`` to the upsert as ``until``, which keeps late rows out of the earlier ones.
    """
    marked = stream.withWatermark(ts, late)
    if together == 1:
        windows = marked.groupBy(F.window(ts, span, slide), account)
        count = windows.agg(F.count("amount").alias("txns_last_24h"))
        bounds = F.col("window.start"), F.col("window.end")
    else:
        # plain numbers: adding intervals to times takes longer than all the rest
        width, step = (_micros(stream.sparkSession, d) for d in (span, slide))
        length, apart = width + (together - 1) * step, together * step
        block = F.window(ts, f"{length} microseconds", f"{apart} microseconds")
        marked = marked.withColumn("__block", block)
        known = F.col("amount").isNotNull().cast("long")
        at = F.unix_micros(ts) - F.unix_micros("__block.start")
        counts = [
            F.sum(F.when((at >= i * step) & (at < i * step + width), known)).alias(f"__{i}")
            for i in range(together)
        ]
        blocks = marked.groupBy("__block", account).agg(*counts)
        each = F.posexplode(F.array(*[f"__{i}" for i in range(together)]))
        count = blocks.select(
            account, F.unix_micros("__block.start").alias("__at"), each.alias("__i", "txns_last_24h")
        ).filter(F.col("txns_last_24h").isNotNull())  # null: no row of the account
        start = F.col("__at") + F.col("__i") * F.lit(step)
        bounds = F.timestamp_micros(start), F.timestamp_micros(start + width)
    fast = F.col("txns_last_24h") > rules.VELOCITY_LIMIT
    return count.select(
        account,
        bounds[0].alias("window_start"),
        bounds[1].alias("window_end"),
        "txns_last_24h",
        F.when(fast, rules.VELOCITY_HIGH)
        .otherwise(rules.VELOCITY_NORMAL)
        .alias("txn_velocity_level"),
    )


def stream_sessions(
    stream: DataFrame,
    *,
    account: str = "nameOrig_hashed",
    ts: str = "ts",
    gap: str = f"{rules.SESSION_MINUTES} minutes",
    late: str = "2 hours",
) -> DataFrame:
    """Sessions per account; a silence of ``gap`` or longer ends one."""
    sessions = stream.withWatermark(ts, late).groupBy(F.session_window(ts, gap), account)
    return sessions.agg(F.count(F.lit(1)).alias("txn_count")).select(
        account,
        F.col("session_window.start").alias("session_start"),
        F.col("session_window.end").alias("session_end"),
        "txn_count",
    )


def stream_match(
    outgoing: DataFrame,
    incoming: DataFrame,
    *,
    account: str = "account",
    incoming_account: str = "incoming_account",
    ts: str = "ts",
    incoming_ts: str = "incoming_ts",
    within: str = f"{rules.VELOCITY_STEPS} hours",
    late: str = "2 hours",
) -> DataFrame:
    """Each row of ``outgoing`` with the rows of ``incoming`` of its account soon after it.

    Soon: at its time or up to ``within`` later. A row without any comes out once, with
    nulls, as soon as the watermark (``late`` behind the slower side) shows that none can
    follow. Both sides' rows leave the state when they can match nothing that is still
    to come; rows later than the watermark are dropped. Null accounts match nothing.
    Column names of the two sides must differ.
    """
    left = outgoing.withWatermark(ts, late)
    right = incoming.withWatermark(incoming_ts, late)
    soon = (F.col(incoming_ts) >= F.col(ts)) & (
        F.col(incoming_ts) <= F.col(ts) + F.expr(f"interval {within}")
    )
    return left.join(right, (F.col(account) == F.col(incoming_account)) & soon, "left_outer")


def replace_available(result: DataFrame, base: str, checkpoint: str) -> StreamingQuery:
    """Keep the complete result of an aggregation as the newest table version.

    The whole result stays in the state; for aggregations that cannot run in update
    mode (sessions). Others should go through ``upsert_available``.
    """
    _begin(result, base)
    return _each_batch(result, lambda batch, _: store.commit(batch, base), checkpoint, "complete")
