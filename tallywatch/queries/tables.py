"""Sources, sinks and write semantics: write to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallywatch.functions.timeparts import week_day
from tallywatch.operators import tables
from tallywatch.queries.base import big, dbl, register
from tallywatch.queries.rows import normal
from tallywatch.schemas import LANDING, RAW
from tallywatch.session import scratch_dir
from tallywatch.sources import landing, store
from tallywatch.sources.events import transactions
from tallywatch.streaming import streams

RAW_SQL = """select txn_id, step, type, cast(amount as double) as amount, nameOrig as account,
  cast(newbalanceOrig as double) as new_balance from {source}"""


def shown(df):
    return df.select(
        "txn_id",
        "step",
        "type",
        dbl("amount").alias("amount"),
        F.col("nameOrig").alias("account"),
        dbl("newbalanceOrig").alias("new_balance"),
    )


FILE_ROWS = 1_000_000  # rows of a landed file, which one task writes

# -- sources ---------------------------------------------------------------------


def _landed(spark, d, label, files):
    """All transactions as CSV in ``files`` files, or more if they would be too long."""
    path = scratch_dir(spark, label)
    # some types carry blanks, which the CSV writer would trim
    rows = transactions(spark, d).select(*RAW.names)
    rows = rows.repartition(max(files, -(-rows.count() // FILE_ROWS)))
    writer = rows.write.option("header", True)
    writer.options(ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    return path


def _read_back(spark, path):
    return landing.read_landing(spark, path)


@register("src_csv", RAW_SQL.format(source="t"))
def src_csv(spark, d):
    return shown(_read_back(spark, _landed(spark, d, "src_csv", 1)))


@register("src_multi_file", RAW_SQL.format(source="t"))
def src_multi_file(spark, d):
    return shown(_read_back(spark, _landed(spark, d, "src_multi", 5)))


@register("stream_landing", RAW_SQL.format(source="t"))
def stream_landing(spark, d):
    """Landed files as a stream in two runs; the second finds the files of the first read."""
    archive, table, mark = (scratch_dir(spark, f"landing-{x}") for x in ("archive", "bronze", "mark"))
    landed = _landed(spark, d, "stream_landing", 3)
    for _ in range(2):
        stream = streams.landing_stream(spark, landed, archive=archive)
        streams.append_available(stream, table, mark).awaitTermination()
    return shown(spark.read.schema(LANDING).parquet(table))


@register(
    "src_glob",
    "select count(*) as row_count, 'csv' as kinds, true as several_files from t",
)
def src_glob(spark, d):
    path = _landed(spark, d, "src_glob", 3)
    # a file of another kind in the same folder is not read
    transactions(spark, d).select(F.to_json(F.struct("txn_id")).alias("value")).write.mode(
        "append"
    ).text(path)
    read = landing.add_audit_cols(_read_back(spark, path), "run-1", "2025-01-01 00:00:00")
    kind = F.substring_index("source_file", ".", -1)
    return read.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.array_join(F.array_sort(F.collect_set(kind)), ",").alias("kinds"),
        (F.count_distinct("source_file") > 1).alias("several_files"),
    )


@register("src_table", RAW_SQL.format(source="t"))
def src_table(spark, d):
    path = scratch_dir(spark, "src_table")
    store.write_table(transactions(spark, d), path)
    return shown(store.read_table(spark, path))


# -- sinks ------------------------------------------------------------------------


@register("sink_overwrite", "select txn_id, cast(amount as double) as amount, step + 1 as later from n")
def sink_overwrite(spark, d):
    path, df = scratch_dir(spark, "sink_overwrite"), normal(spark, d)
    store.write_table(df, path)
    store.write_table(
        df.select("txn_id", dbl("amount").alias("amount"), (F.col("step") + 1).alias("later")),
        path,
    )
    return store.read_table(spark, path)


@register(
    "sink_append",
    "select txn_id, cast(amount as double) as amount from n union all "
    "select txn_id, cast(amount as double) as amount from n where amount > 0",
)
def sink_append(spark, d):
    path = scratch_dir(spark, "sink_append")
    df = normal(spark, d).select("txn_id", dbl("amount").alias("amount"))
    store.write_table(df, path)
    store.write_table(df.filter(F.col("amount") > 0), path, "append")
    return store.read_table(spark, path)


@register("sink_partitioned", "select type, txn_id, cast(amount as double) as amount from n")
def sink_partitioned(spark, d):
    path = scratch_dir(spark, "sink_partitioned")
    df = normal(spark, d).select("type", "txn_id", dbl("amount").alias("amount"))
    store.write_table(df, path, partition_by=["type"])
    return store.read_table(spark, path)


@register("compact_cluster", RAW_SQL.format(source="t").replace("step, type", "step, upper(trim(type)) as type"))
def compact_cluster(spark, d):
    path = scratch_dir(spark, "compact_cluster")
    laid_out = tables.compact_cluster(normal(spark, d), ["nameOrig", "step", "txn_id"], 4)
    store.write_table(laid_out, path)
    return shown(store.read_table(spark, path))


@register(
    "tag_columns",
    """select txn_id, 'PII: Customer Name' as nameorig_note, 'PII: Recipient Name' as namedest_note
    from t""",
)
def tag_columns(spark, d):
    path = scratch_dir(spark, "tag_columns")
    notes = {"nameOrig": "PII: Customer Name", "nameDest": "PII: Recipient Name"}
    store.write_table(tables.tag_columns(transactions(spark, d), notes), path)
    back = store.read_table(spark, path)
    return back.select(
        "txn_id",
        *[F.lit(back.schema[c].metadata.get("comment")).alias(f"{c.lower()}_note") for c in notes],
    )


# -- upserts -----------------------------------------------------------------------
# Target: steps up to 400, with the amount as it is. Source: steps from 300 on,
# with the amount doubled; steps 300..400 are in both.

TARGET = "select txn_id, step, type, cast(amount as double) as amount from n where step <= 400"
SOURCE = "select txn_id, step, type, cast(amount * 2 as double) as amount from n where step >= 300"


def _pair(spark, d):
    df = normal(spark, d)
    target = df.filter("step <= 400").select("txn_id", "step", "type", dbl("amount").alias("amount"))
    source = df.filter("step >= 300").select(
        "txn_id", "step", "type", dbl(F.col("amount") * 2).alias("amount")
    )
    return target, source


@register(
    "upsert_full",
    f"{SOURCE} union all {TARGET} and step < 300",
)
def upsert_full(spark, d):
    base = scratch_dir(spark, "upsert_full")
    target, source = _pair(spark, d)
    store.commit(target, base)
    store.commit(tables.upsert(store.read_version(spark, base), source, ["txn_id"]), base)
    return store.read_version(spark, base)


@register("upsert_insert_only", f"{TARGET} union all {SOURCE} and step > 400")
def upsert_insert_only(spark, d):
    target, source = _pair(spark, d)
    return tables.insert_missing(target, source, ["txn_id"])


@register(
    "upsert_update_matched",
    """select txn_id, step, case when step >= 300 and type = 'TRANSFER' then 'closed' else type end
        as type,
      cast(case when step >= 300 and type = 'TRANSFER' then amount * 2 else amount end as double)
        as amount
    from n where step <= 400""",
)
def upsert_update_matched(spark, d):
    target, source = _pair(spark, d)
    return tables.update_matched(
        target,
        source,
        ["txn_id"],
        {"amount": F.col("src_amount"), "type": F.lit("closed")},
        when=F.col("type") == "TRANSFER",
    )


@register(
    "upsert_pruned",
    """select txn_id, step, type, cast(case when cast(floor((step - 1) / 24.0) as bigint) % 7 + 1
        in (2, 5) then amount * 2 else amount end as double) as amount,
      cast(cast(floor((step - 1) / 24.0) as bigint) % 7 + 1 as int) as day_of_week from n""",
)
def upsert_pruned(spark, d):
    path = scratch_dir(spark, "upsert_pruned")
    df = normal(spark, d).withColumn("day_of_week", week_day(F.col("step") - 1).cast("int"))
    store.write_table(
        df.select("txn_id", "step", "type", dbl("amount").alias("amount"), "day_of_week"),
        path,
        partition_by=["day_of_week"],
    )
    source = df.filter(F.col("day_of_week").isin(2, 5)).select(
        "txn_id", "step", "type", dbl(F.col("amount") * 2).alias("amount"), "day_of_week"
    )
    store.upsert_partitions(source, path, ["txn_id"], "day_of_week")
    return store.read_table(spark, path)


@register(
    "upsert_widen",
    """select txn_id, step, type, cast(case when step >= 300 then amount * 2 else amount end
        as double) as amount,
      case when step >= 300 then lower(type) end as note from n""",
)
def upsert_widen(spark, d):
    target, source = _pair(spark, d)
    source = source.withColumn("note", F.lower("type"))
    return tables.upsert(target, source, ["txn_id"], allow_new_columns=True)


@register(
    "materialize_counts",
    """select (select count(*) from n where step <= 400) as rows_before,
      (select count(*) from n) as rows_after,
      (select count(*) from n where step > 400) as rows_added, false as is_first_load""",
)
def materialize_counts(spark, d):
    base = scratch_dir(spark, "materialize")
    target, source = _pair(spark, d)
    store.materialize(target, base, ["txn_id"])
    out = store.materialize(source, base, ["txn_id"])
    return out.select(*[big(c).alias(c) for c in out.columns[:3]], "is_first_load")


@register(
    "change_set",
    f"""select case when a.txn_id is null then 'insert' when b.txn_id is null then 'delete'
        else 'update' end as change_type,
      coalesce(b.txn_id, a.txn_id) as txn_id, coalesce(b.step, a.step) as step,
      coalesce(b.type, a.type) as type,
      case when b.txn_id is null then a.amount else b.amount end as amount
    from ({TARGET}) a full outer join ({SOURCE}) b on a.txn_id = b.txn_id
    where a.txn_id is null or b.txn_id is null or a.amount is distinct from b.amount""",
)
def change_set(spark, d):
    before, after = _pair(spark, d)
    return tables.change_set(before, after, ["txn_id"])
