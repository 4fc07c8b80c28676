"""Rule labels: per-row columns from type, amount and balances."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywatch import rules
from tallywatch.functions.exprs import above, below, flag, holds, ratio


def _is_emptied(limit: float = rules.EMPTIED_LIMIT) -> Column:
    return (F.col("amount") > limit) & (F.col("newbalanceOrig") == 0)


def label_risk(
    df: DataFrame,
    *,
    transfer_high: float = rules.TRANSFER_HIGH_LIMIT,
    medium: float = rules.MEDIUM_LIMIT,
    emptied: float = rules.EMPTIED_LIMIT,
) -> DataFrame:
    """Risk level, emptied account, overdraft and negative-transfer flags.

    Expects ``normalize`` to have run: labels read the cleaned type and amount,
    so ``material_risk_level`` and ``risk_score`` are one value.
    """
    amount, is_transfer = F.col("amount"), F.col("type") == "TRANSFER"
    level = (
        F.when(is_transfer & (amount > transfer_high), rules.HIGH_RISK)
        .when(amount > medium, rules.MEDIUM_RISK)
        .otherwise(rules.LOW_RISK)
    )
    emptied_account = _is_emptied(emptied)
    return df.withColumns(
        {
            "risk_score": level,
            "material_risk_level": level,
            "fraud_pattern": F.when(emptied_account, rules.EMPTIED).otherwise(rules.NOT_EMPTIED),
            "is_account_emptied": flag(emptied_account),
            "is_overdraft": amount > F.col("oldbalanceOrg"),
            "is_suspicious_flag": flag((amount < 0) & is_transfer),
        }
    )


def label_dest(df: DataFrame) -> DataFrame:
    """Destination flags; reads the raw ``nameDest``, so run it before ``mask``."""
    untracked = (F.col("oldbalanceDest") == 0) & (F.col("newbalanceDest") == 0)
    return df.withColumns(
        {
            "is_merchant_dest": F.col("nameDest").startswith(rules.MERCHANT_PREFIX),
            "is_new_destination": untracked & (F.col("amount") > 0),
            "is_untracked_destination": untracked,
        }
    )


def label_type(df: DataFrame) -> DataFrame:
    """Risk category, risk level and direction of funds by type."""
    kind = F.col("type")
    risky = kind.isin(*rules.HIGH_RISK_TYPES)
    return df.withColumns(
        {
            "txn_category_risk": F.when(risky, rules.CATEGORY_HIGH).otherwise(rules.CATEGORY_LOW),
            "type_risk_level": F.when(risky, rules.TYPE_HIGH).otherwise(rules.TYPE_LOW),
            "fund_direction": F.when(kind.isin(*rules.OUTBOUND_TYPES), rules.OUTBOUND)
            .when(kind.isin(*rules.INBOUND_TYPES), rules.INBOUND)
            .otherwise(rules.INTERNAL),
        }
    )


def label_segment(
    df: DataFrame, customer_bands=rules.CUSTOMER_BANDS, segment_bands=rules.SEGMENT_BANDS
) -> DataFrame:
    """Customer segment (three-way) and client segment (four-way) by amount."""
    amount = F.col("amount")
    return df.withColumns(
        {
            "customer_segment": above(amount, customer_bands, rules.CUSTOMER_DEFAULT),
            "segment": below(amount, segment_bands, rules.SEGMENT_DEFAULT),
        }
    )


def label_number(df: DataFrame) -> DataFrame:
    """Round-hundred flag and first digit (null when the text starts with ``-``)."""
    amount = F.col("amount")
    return df.withColumns(
        {
            "is_round_number": flag(amount % 100 == 0),
            "first_digit": F.substring(amount.cast("string"), 1, 1).try_cast("int"),
        }
    )


def drain(df: DataFrame, percent: float = rules.DRAIN_PERCENT) -> DataFrame:
    """Share of the old balance that leaves, in percent, and the drain flag.

    The flag compares exact decimals, so a share of exactly ``percent`` is not
    a drain whatever the rounding of the ratio.
    """
    amount, old = F.col("amount"), F.col("oldbalanceOrg")
    return df.withColumns(
        {
            "balance_drain_ratio": F.when(old > 0, ratio(amount, old) * 100).otherwise(0.0),
            "is_drain_event": flag((old > 0) & (amount * 100 > old * percent)),
        }
    )


def risk_weights(df: DataFrame) -> DataFrame:
    """``total_risk_score`` (0..100) from emptied, anomaly, high-risk and round flags."""
    weight = rules.TOTAL_WEIGHTS
    score = (
        flag(_is_emptied()) * weight["emptied"]
        + F.col("is_behavioral_anomaly") * weight["anomaly"]
        + flag(F.col("risk_score") == rules.HIGH_RISK) * weight["high_risk"]
        + F.col("is_round_number") * weight["round"]
    )
    return df.withColumn("total_risk_score", score)


def risk_index(df: DataFrame) -> DataFrame:
    """``cumulative_risk_index`` from spending spike, new account and emptied flags."""
    weight = rules.INDEX_WEIGHTS
    score = (
        F.col("is_spending_spike") * weight["spike"]
        + flag(F.col("account_activity") == rules.NEW_ACCOUNT) * weight["new_account"]
        + flag(_is_emptied()) * weight["emptied"]
    )
    return df.withColumn("cumulative_risk_index", score)
