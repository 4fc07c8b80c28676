"""The queries behind the fraud report: measures, cards, charts, mart.

``fact`` carries ``amount``, ``isFraud`` (0/1), ``type_risk_level``, ``step``
and the keys. A report filter on ``type_risk_level`` is passed as ``levels``,
because the total volume ignores it; any other filter is applied to the fact
before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywatch import rules
from tallywatch.functions.exprs import ratio
from tallywatch.operators.spread import attach

MEASURES = (
    "total_volume",
    "fraud_volume",
    "fraud_rate",
    "high_risk_count",
    "fraud_count",
    "non_fraud_count",
)


def _is_fraud() -> Column:
    return F.col("isFraud").cast("int") == 1


def measures(
    fact: DataFrame, by: Sequence[str] = (), levels: Sequence[str] | None = None
) -> DataFrame:
    """All six measures in one aggregate, for the whole fact or per group.

    A filter on levels is a condition inside the aggregates, so the total
    volume sees every row.
    """
    chosen = F.lit(True) if levels is None else F.col("type_risk_level").isin(*levels)
    fraud = chosen & _is_fraud()
    high = F.upper("type_risk_level").isin(*rules.REPORT_HIGH_LEVELS)
    none = F.lit(0).cast("decimal(18,2)")
    out = fact.groupBy(*by).agg(
        F.sum("amount").alias("total_volume"),
        F.coalesce(F.sum(F.when(fraud, F.col("amount"))), none).alias("fraud_volume"),
        F.count_if(chosen & high).alias("high_risk_count"),
        F.count_if(fraud).alias("fraud_count"),
        F.count_if(chosen & ~_is_fraud()).alias("non_fraud_count"),
    )
    rate = F.coalesce(ratio(F.col("fraud_volume"), F.col("total_volume")), F.lit(0.0))
    return out.withColumn("fraud_rate", rate).select(*by, *MEASURES)


def formatted_amount(col: str = "amount") -> Column:
    """Currency text when the group holds exactly one amount, else empty.

    Smallest equal to largest says the same as a distinct count of one, without
    its shuffle.
    """
    single = (F.min(col) == F.max(col)) & (F.count(col) == F.count(F.lit(1)))
    text = F.concat(F.lit("$"), F.format_number(F.min(col), 2))
    return F.when(single, text).otherwise("")


def fraud_volume_by(fact: DataFrame, *by: str) -> DataFrame:
    """Fraud volume per group, largest first (line, donut and bar charts)."""
    volume = measures(fact, by).select(*by, "fraud_volume")
    return volume.orderBy(F.col("fraud_volume").desc(), *by)


def by_step(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Fraud volume and date per step; a step outside the calendar has no date.

    The fact is summed per step first, so the join sees one row per step.
    """
    per_step = measures(fact, ["step"]).select("step", "fraud_volume")
    joined = per_step.join(dim_date.select("step", "calendar_date"), "step", "left")
    return joined.orderBy(F.col("fraud_volume").desc(), "step")


def by_type_level(fact: DataFrame, dim_type: DataFrame, key: str = "type") -> DataFrame:
    """Fraud volume per risk level of the type dimension."""
    per_type = measures(fact, [key]).select(key, "fraud_volume")
    joined = per_type.join(dim_type.select(key, "type_risk_level"), key, "inner")
    out = joined.groupBy("type_risk_level").agg(F.sum("fraud_volume").alias("fraud_volume"))
    return out.orderBy(F.col("fraud_volume").desc(), "type_risk_level")


def detail(fact: DataFrame, levels: Sequence[str] = (rules.TYPE_LOW, rules.TYPE_HIGH)) -> DataFrame:
    """Detail table: one row per account, level, z-score and velocity, z ascending."""
    by = ["nameOrig_hashed", "type_risk_level", "z_score", "txns_last_24h"]
    rows = fact.filter(F.col("type_risk_level").isin(*levels))
    out = rows.groupBy(*by).agg(formatted_amount().alias("formatted_amount"))
    return out.orderBy("z_score", "nameOrig_hashed", "type_risk_level", "txns_last_24h")


def in_dates(fact: DataFrame, dim_date: DataFrame, start: str, end: str) -> DataFrame:
    """Fact rows whose calendar date lies in [start, end)."""
    date = F.col("calendar_date")
    days = dim_date.filter((date >= F.lit(start).cast("date")) & (date < F.lit(end).cast("date")))
    inside = days.select("step", F.lit(True).alias("__inside"))
    return attach(fact, inside, ["step"]).filter("__inside").drop("__inside")


def daily_fraud(fact: DataFrame, dim_date: DataFrame, dim_type: DataFrame) -> DataFrame:
    """Mart: amount and fraud count per calendar weekday and type risk level.

    The fact is reduced to one row per (step, type) before it meets the
    dimensions, so what is joined does not grow with the fact. A step outside the
    calendar has no weekday, a type without a row no level; both still count.
    """
    cells = fact.groupBy("step", "type").agg(
        F.sum("amount").alias("amount"), F.count_if(_is_fraud()).alias("frauds")
    )
    return (
        cells.join(dim_date.select("step", "day_of_week"), "step", "left")
        .join(dim_type.select("type", "type_risk_level"), "type", "left")
        .groupBy("day_of_week", "type_risk_level")
        .agg(F.sum("amount").alias("total_amount"), F.sum("frauds").alias("fraud_count"))
    )
