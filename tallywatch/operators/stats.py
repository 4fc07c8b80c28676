"""Group statistics, z-scores and what follows from them.

Statistics are aggregated first (partial sums per task) and joined back, never
computed as a window over a handful of large groups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywatch import rules
from tallywatch.functions.exprs import flag, mean, ratio
from tallywatch.operators.spread import SMALL_ROWS, attach


def type_stats(df: DataFrame, by: str = "type") -> DataFrame:
    """Mean and sample standard deviation of the amount per group."""
    return df.groupBy(by).agg(
        mean(F.sum("amount"), F.count("amount")).alias("avg_amount"),
        F.stddev("amount").alias("stddev_amount"),
    )


def zscore(
    df: DataFrame,
    by: str = "type",
    *,
    outlier: float = rules.OUTLIER_Z,
    max_rows: int = SMALL_ROWS,
    keep_stats: bool = False,
    rows: DataFrame | None = None,
) -> DataFrame:
    """z-score of the amount in its group, outlier flag, ratio to the group mean.

    Null without a group or where the group has no variance (one row, or equal
    amounts). ``rows`` are those to take the statistics from, if others than ``df``:
    the same rows before windows were added to them.
    """
    source = df if rows is None else rows
    stats = type_stats(source.filter(F.col(by).isNotNull()), by)
    out = attach(df, stats, [by], max_rows)
    amount, average = F.col("amount"), F.col("avg_amount")
    score = F.try_divide(amount.cast("double") - average, F.col("stddev_amount"))
    out = out.withColumns(
        {"z_score": score, "relative_volume_index": F.round(ratio(amount, average), 2)}
    ).withColumn("is_statistical_outlier", flag(F.abs("z_score") > outlier))
    return out if keep_stats else out.drop("avg_amount", "stddev_amount")


def top_outliers(df: DataFrame, k: int, tie: str = "txn_id") -> DataFrame:
    """The ``k`` rows with the largest z-score; ties by ``tie``."""
    scored = df.filter(F.col("z_score").isNotNull())
    return scored.orderBy(F.col("z_score").desc(), F.col(tie)).limit(k)
