"""Ledger arithmetic: gaps between stated and computed balances, on exact decimals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywatch import rules
from tallywatch.functions.exprs import flag, holds, mean


def _exact(gap: Column) -> Column:
    return gap < F.lit(rules.EXACT_GAP).cast("decimal(4,2)")


def sender_gap() -> Column:
    return F.abs(F.col("oldbalanceOrg") - F.col("amount") - F.col("newbalanceOrig"))


def math_correct() -> Column:
    """1 where the sender's balances agree with the amount, else 0."""
    return flag(_exact(sender_gap()))


def ledger_gaps(df: DataFrame) -> DataFrame:
    """Sender and receiver gap, balance flags and the gap relative to the amount."""
    amount = F.col("amount")
    receiver = F.abs(F.col("oldbalanceDest") + amount - F.col("newbalanceDest"))
    relative = F.round(F.try_divide(F.col("origin_gap"), amount)).cast("double")
    return df.withColumns({"origin_gap": sender_gap(), "dest_gap": receiver}).withColumns(
        {
            "is_ledger_balanced": holds(_exact(F.col("origin_gap")) & _exact(F.col("dest_gap"))),
            "relative_origin_error": F.when(amount != 0, relative).otherwise(0.0),
            "is_math_correct": math_correct(),
            "is_balance_consistent": holds(_exact(F.col("origin_gap"))),
        }
    )


def quality_tier(df: DataFrame) -> DataFrame:
    """Tier by the sender gap. A gap that cannot be computed is an anomaly too."""
    gap = F.col("origin_gap")
    return df.withColumn(
        "quality_tier",
        F.when(_exact(gap), rules.TIER_EXACT)
        .when(gap < F.lit(rules.ROUNDING_GAP).cast("decimal(4,2)"), rules.TIER_ROUNDING)
        .when(gap == F.col("amount"), rules.TIER_GHOST)
        .otherwise(rules.TIER_OTHER),
    )


def audit_report(df: DataFrame) -> DataFrame:
    """Rows, average amount and largest gap per tier, in tier order."""
    return (
        df.groupBy("quality_tier")
        .agg(
            F.count(F.lit(1)).alias("record_count"),
            mean(F.sum("amount"), F.count("amount")).alias("average_transfer_val"),
            F.max("origin_gap").alias("max_discrepancy"),
        )
        .orderBy("quality_tier")
    )


def summary(df: DataFrame) -> DataFrame:
    """One row: mean amount (2 dp), drain events, high-risk transactions."""
    return df.agg(
        F.round(mean(F.sum("amount"), F.count("amount")), 2).alias("avg_txn_amount"),
        F.coalesce(F.sum("is_drain_event"), F.lit(0)).alias("total_drain_events"),
        F.count_if(F.col("risk_score") == rules.HIGH_RISK).alias("high_risk_count"),
    )
