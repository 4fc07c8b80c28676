"""Dimensions, account history (SCD type 2) and the fact table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallywatch import rules
from tallywatch.functions.timeparts import calendar_risk, step_timestamp
from tallywatch.operators.tables import insert_missing, update_matched
from tallywatch.operators.windows import latest

ACCOUNT_KEY = "nameOrig_hashed"
ACCOUNT_ATTRS = ("customer_segment", "account_activity", "account_audit_status")
NEWEST = ("step", "txn_id")


def _at(run_ts: str | dt.datetime) -> Column:
    """The load time of a run: one literal, the same in every table of the run."""
    return F.lit(str(run_ts)).cast("timestamp")


def _end_open() -> Column:
    return F.lit(None).cast("timestamp")


def dim_date(
    spark: SparkSession,
    start: str = rules.CALENDAR_START,
    steps: int = rules.CALENDAR_STEPS,
) -> DataFrame:
    """One row per hour step from 1 on: calendar attributes and time-of-day risk."""
    return _calendar(spark.range(1, steps + 1).withColumnRenamed("id", "step"), start)


def dim_date_of(df: DataFrame, start: str = rules.CALENDAR_START) -> DataFrame:
    """The calendar of the steps that occur in ``df``: no row of it lacks its date."""
    return _calendar(df.select("step").filter("step is not null").distinct(), start)


def _calendar(steps: DataFrame, start: str) -> DataFrame:
    step = F.col("step").cast("int")
    when = step_timestamp(step, start)
    return steps.select(
        F.xxhash64(step).alias("step_sk"),
        step.alias("step"),
        F.to_date(when).alias("calendar_date"),
        F.date_format(when, "EEEE").alias("day_name"),
        F.dayofweek(when).cast("long").alias("day_of_week"),
        F.hour(when).alias("hour_of_day"),
        calendar_risk(F.hour(when)).alias("temporal_risk_bucket"),
    )


def dim_txn_type(df: DataFrame) -> DataFrame:
    """One row per transaction type with its labels; the key hashes the type."""
    return (
        df.select("type", "type_risk_level", "txn_category_risk", "fund_direction")
        .distinct()
        .withColumn("txn_type_sk", F.xxhash64("type"))
    )


def refresh_txn_type(dim: DataFrame, df: DataFrame, run_ts: str | dt.datetime) -> DataFrame:
    """The type dimension with the types that ``df`` adds, loaded at ``run_ts``.

    Insert only: a type that is known keeps its row and its ``last_updated``.
    """
    new = dim_txn_type(df).withColumn("last_updated", _at(run_ts))
    return insert_missing(dim, new.select(*dim.columns), ["txn_type_sk"])


def account_states(df: DataFrame, order: Sequence[str] = NEWEST) -> DataFrame:
    """Latest attributes per account; rows without an account are left out."""
    known = df.filter(F.col(ACCOUNT_KEY).isNotNull())
    newest = latest(known.select(ACCOUNT_KEY, *ACCOUNT_ATTRS, *order), [ACCOUNT_KEY], order)
    return newest.select(ACCOUNT_KEY, *ACCOUNT_ATTRS)


def _open_versions(states: DataFrame, run_ts: str | dt.datetime) -> DataFrame:
    start = _at(run_ts)
    return states.select(
        F.xxhash64(F.col(ACCOUNT_KEY), start).alias("account_sk"),
        ACCOUNT_KEY,
        *ACCOUNT_ATTRS,
        F.lit(True).alias("is_current"),
        start.alias("start_date"),
        _end_open().alias("end_date"),
    )


def dim_account(df: DataFrame, run_ts: str | dt.datetime) -> DataFrame:
    """Initial load: one current row per account, valid from ``run_ts`` on."""
    return _open_versions(account_states(df), run_ts)


def scd2_stage(
    updates: DataFrame,
    current: DataFrame,
    key: str = ACCOUNT_KEY,
    attrs: Sequence[str] = ACCOUNT_ATTRS,
) -> DataFrame:
    """Updates with ``is_existing_account`` and ``attr_changed`` (null-safe).

    ``updates`` and the current rows of ``current`` have one row per key.
    """
    now = current.filter("is_current").select(
        key, F.lit(True).alias("__known"), F.struct(*attrs).alias("__was")
    )
    known = F.col("__known").isNotNull()
    changed = known & ~F.struct(*attrs).eqNullSafe(F.col("__was"))
    joined = updates.select(key, *attrs).join(now, key, "left")
    return joined.select(
        key, *attrs, known.alias("is_existing_account"), changed.alias("attr_changed")
    )


def scd2_apply(dim: DataFrame, staged: DataFrame, run_ts: str | dt.datetime) -> DataFrame:
    """The complete new dimension: changed rows closed, new versions opened.

    Closing and opening are one result, so a single commit can never leave an
    account without a current row.
    """
    closing = staged.filter("attr_changed").select(ACCOUNT_KEY)
    closed = update_matched(
        dim,
        closing,
        [ACCOUNT_KEY],
        {"is_current": F.lit(False), "end_date": _at(run_ts)},
        when=F.col("is_current"),
    )
    opening = staged.filter("attr_changed or not is_existing_account")
    return closed.unionByName(_open_versions(opening, run_ts))


def scd2_update(dim: DataFrame, df: DataFrame, run_ts: str | dt.datetime) -> DataFrame:
    """Bring the dimension up to date with the account states found in ``df``.

    The result of ``scd2_stage`` and ``scd2_apply`` in one join, so the states
    are computed once: a changed account yields its closed row and a new one.
    """
    past, current = dim.filter("not is_current"), dim.filter("is_current")
    states = account_states(df).select(
        F.col(ACCOUNT_KEY).alias("__key"), F.struct(*ACCOUNT_ATTRS).alias("__new")
    )
    met = current.withColumn("__was", F.struct(*ACCOUNT_ATTRS)).join(
        states, F.col(ACCOUNT_KEY) == F.col("__key"), "full_outer"
    )
    known, seen = F.col(ACCOUNT_KEY).isNotNull(), F.col("__key").isNotNull()
    changed = known & seen & ~F.col("__was").eqNullSafe(F.col("__new"))
    start = _at(run_ts)
    row = {c: F.col(c) for c in dim.columns}
    closed = {**row, "is_current": F.lit(False), "end_date": start}
    opened = {
        **row,
        "account_sk": F.xxhash64(F.col("__key"), start),
        ACCOUNT_KEY: F.col("__key"),
        **{a: F.col("__new").getField(a) for a in ACCOUNT_ATTRS},
        "is_current": F.lit(True),
        "start_date": start,
        "end_date": _end_open(),
    }

    def as_struct(columns: dict[str, Column]) -> Column:
        types = {f.name: f.dataType for f in dim.schema.fields}
        return F.struct(*[columns[c].cast(types[c]).alias(c) for c in dim.columns])

    versions = (
        F.when(changed, F.array(as_struct(closed), as_struct(opened)))
        .when(known, F.array(as_struct(row)))
        .otherwise(F.array(as_struct(opened)))
    )
    return past.unionByName(met.select(F.explode(versions).alias("v")).select("v.*"))


def scd2_dedupe_current(
    dim: DataFrame, run_ts: str | dt.datetime, tie: str = "account_sk"
) -> DataFrame:
    """Close all but the newest current row of each account, row by row."""
    by = Window.partitionBy(ACCOUNT_KEY, "is_current").orderBy(
        F.col("start_date").desc(), F.col(tie).desc()
    )
    extra = F.col("is_current") & (F.row_number().over(by) > 1)
    marked = dim.withColumn("__extra", extra)
    return marked.withColumns(
        {
            "is_current": F.col("is_current") & ~F.col("__extra"),
            "end_date": F.when(F.col("__extra"), _at(run_ts)).otherwise(F.col("end_date")),
        }
    ).drop("__extra")


def add_keys(df: DataFrame) -> DataFrame:
    """Hash keys of transaction, type and step."""
    return df.withColumns(
        {
            "transaction_sk": F.xxhash64(ACCOUNT_KEY, "step", "amount", "type"),
            "txn_type_sk": F.xxhash64("type"),
            "step_sk": F.xxhash64("step"),
        }
    )


def lookup_account(df: DataFrame, dim: DataFrame, as_of: str) -> DataFrame:
    """Add the ``account_sk`` valid at ``as_of``; null when there is none.

    An equi-join on the account; validity intervals do not overlap, so each row
    meets at most one version.
    """
    versions = dim.select(
        F.col(ACCOUNT_KEY).alias("__account"), "account_sk", "start_date", "end_date"
    )
    at = F.col(as_of)
    valid = (at >= F.col("start_date")) & (F.col("end_date").isNull() | (at < F.col("end_date")))
    on = (F.col(ACCOUNT_KEY) == F.col("__account")) & valid
    return df.join(versions, on, "left").drop("__account", "start_date", "end_date")


FACT_MEASURES = (
    "amount",
    "oldbalanceOrg",
    "newbalanceOrig",
    "risk_score",
    "day_of_week",
    "balance_drain_ratio",
    "z_score",
)
FACT_FLAGS = (
    "isFraud",
    "is_behavioral_anomaly",
    "is_first_action",
    "is_round_number",
    "is_drain_event",
    "has_logical_error",
    "audit_note",
)


def fact(df: DataFrame, keys: Sequence[str], extra: Sequence[str] = ()) -> DataFrame:
    """Fact projection: keys, measures, flags; ``extra`` for report columns."""
    return df.select(*keys, *FACT_MEASURES, *FACT_FLAGS, *extra)
