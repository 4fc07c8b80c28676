"""The layers end to end: raw rows to silver, silver to gold, and the flagship query."""

from __future__ import annotations

import datetime as dt
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywatch import rules
from tallywatch.functions.exprs import flag
from tallywatch.functions.labels import (
    drain,
    label_dest,
    label_number,
    label_risk,
    label_segment,
    label_type,
    risk_index,
    risk_weights,
)
from tallywatch.functions.ledger import ledger_gaps, quality_tier
from tallywatch.functions.standard import impute, mask, normalize, surrogate_key
from tallywatch.functions.timeparts import late_or_standard, week_day
from tallywatch.operators.dims import (
    ACCOUNT_KEY,
    add_keys,
    dim_account,
    dim_txn_type,
    fact,
    lookup_account,
)
from tallywatch.operators.quality import (
    audit_note,
    logical_errors,
    score_bounds,
    split_sane,
    split_valid,
)
from tallywatch.operators.spread import HOT_ROWS
from tallywatch.operators.stats import zscore
from tallywatch.operators.windows import behavior, velocity


def secure(raw: DataFrame, salt: str) -> DataFrame:
    """Standardised rows with masked identifiers and destination flags; no shuffle."""
    return mask(label_dest(normalize(raw)), salt)


def label(df: DataFrame) -> DataFrame:
    """Every per-row label and ledger column; one projection."""
    df = drain(label_number(label_segment(label_type(label_risk(df)))))
    return quality_tier(ledger_gaps(df)).withColumns(
        {
            "hour_of_day": F.col("step") % 24,
            "temporal_risk_bucket": late_or_standard(F.col("step") % 24),
        }
    )


def silver(raw: DataFrame, salt: str, *, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Raw transactions to the enriched layer: labels, audit, behaviour, z-score.

    Windows come first: what follows is computed after the one exchange instead
    of travelling through it.
    """
    masked = secure(raw, salt)
    df = behavior(masked, hot_rows=hot_rows)
    df = zscore(surrogate_key(label(df)), rows=masked)
    return risk_index(risk_weights(df))


class Gold(NamedTuple):
    fact: DataFrame
    dim_account: DataFrame
    dim_txn_type: DataFrame
    quarantine: DataFrame
    math_failures: DataFrame


def clean_rows(df: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(clean, quarantined, mathematically insane) rows of the silver layer."""
    valid, quarantine = split_valid(df, ["step", "type"])
    checked = score_bounds(audit_note(logical_errors(valid)))
    sane = split_sane(checked)
    return sane.kept, quarantine, sane.rejected


def gold(
    silver_df: DataFrame, run_ts: str | dt.datetime, accounts: DataFrame | None = None
) -> Gold:
    """Star schema of the clean rows.

    ``accounts`` is the account dimension to look keys up in; without one the
    initial load of this run is used. Keys are as of ``run_ts``.
    """
    clean, quarantine, failures = clean_rows(silver_df)
    clean = clean.withColumn("day_of_week", week_day(F.col("step") - 1))
    dim = dim_account(clean, run_ts) if accounts is None else accounts
    keyed = lookup_account(
        add_keys(clean).withColumn("start_date_of_load", F.lit(str(run_ts)).cast("timestamp")),
        dim,
        "start_date_of_load",
    )
    facts = fact(
        keyed.withColumn("transaction_sk", F.col("transaction_sk").cast("string")),
        ["transaction_sk", ACCOUNT_KEY, "account_sk", "txn_type_sk", "step_sk"],
        extra=["txn_id", "step", "type", "type_risk_level", "txns_last_24h"],
    )
    return Gold(facts, dim, dim_txn_type(clean), quarantine, failures)


FEATURES = (
    "amount",
    "z_score",
    "behavioral_spike_ratio",
    "txns_last_24h",
    "balance_drain_ratio",
    "avg_last_10_txns",
    "is_first_action",
)


def feature_table(
    silver_df: DataFrame, key: str = "transaction_sk", label_col: str = "isFraud"
) -> DataFrame:
    """Features of the valid rows for model training; nulls get their defaults."""
    valid = split_valid(silver_df, ["step", "type"]).kept
    high = flag(F.col("type_risk_level") == rules.TYPE_HIGH).alias("is_high_risk_type")
    return impute(valid.select(key, *FEATURES, label_col, high))


def abnormal_outbound(
    raw: DataFrame, salt: str, *, z_limit: float = 2.0, hot_rows: int | None = HOT_ROWS
) -> DataFrame:
    """Accounts with abnormal outbound behaviour (the flagship query).

    Per account: transactions, total amount, largest z-score, highest velocity,
    high-risk rows with a z-score above ``z_limit`` and fraud rows; accounts
    without such a high-risk row are left out.
    """
    columns = ["txn_id", "step", "type", "amount", "nameOrig", "isFraud"]
    masked = mask(normalize(raw.select(*columns)), salt, ["nameOrig"])
    valid = label_type(split_valid(masked).kept)
    scored = zscore(velocity(valid, hot_rows=hot_rows), rows=valid)
    alarming = (F.col("type_risk_level") == rules.TYPE_HIGH) & (F.col("z_score") > z_limit)
    return (
        scored.groupBy(ACCOUNT_KEY)
        .agg(
            F.count(F.lit(1)).alias("txn_count"),
            F.sum("amount").alias("total_amount"),
            F.max("z_score").alias("max_z_score"),
            F.max("txns_last_24h").alias("max_velocity"),
            F.count_if(alarming).alias("alarming_rows"),
            F.count_if("isFraud").alias("fraud_rows"),
        )
        .filter(F.col("alarming_rows") > 0)
    )
