"""Hour, weekday and time-of-day buckets from the hour counter or a timestamp.

Three notions of the hour of a step exist and each keeps its own name:
``hour_of_day`` and ``day_of_week`` take the counter itself modulo 24; ``sim_*``
count from step 1 = hour 0; ``cal_*`` follow the calendar of ``dim_date``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywatch import rules


def late_or_standard(hour: Column) -> Column:
    late = (hour >= 23) | (hour <= 4)
    return F.when(late, rules.LATE_NIGHT).otherwise(rules.STANDARD_HOURS)


def calendar_risk(hour: Column) -> Column:
    return F.when((hour >= 22) | (hour <= 6), rules.HIGH_RISK).otherwise(rules.LOW_RISK)


def week_day(step: Column) -> Column:
    """1..7, a new day every 24 steps."""
    return (F.floor(step / 24) % 7 + 1).cast("long")


def step_timestamp(step: Column, start: str = rules.CALENDAR_START) -> Column:
    """Calendar time of a step; step 1 is the first hour of ``start``."""
    return F.to_timestamp(F.lit(start)) + F.make_dt_interval(hours=step.cast("int") - 1)


def time_parts(df: DataFrame, start: str = rules.CALENDAR_START) -> DataFrame:
    """All time columns that derive from ``step``."""
    step, when = F.col("step"), step_timestamp(F.col("step"), start)
    return df.withColumns(
        {
            "hour_of_day": step % 24,
            "day_of_week": week_day(step),
            "temporal_risk_bucket": late_or_standard(step % 24),
            "sim_hour": (step - 1) % 24,
            "sim_day": week_day(step - 1),
            "sim_risk_bucket": late_or_standard((step - 1) % 24),
            "cal_hour": F.hour(when),
            "cal_dow": F.dayofweek(when).cast("long"),
            "cal_risk_bucket": calendar_risk(F.hour(when)),
        }
    )


def time_bucket4(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Late night / morning / afternoon / evening from a timestamp."""
    hour = F.hour(ts)
    bucket = (
        F.when((hour >= 23) | (hour <= 4), rules.LATE_NIGHT)
        .when(hour <= 11, rules.MORNING)
        .when(hour <= 17, rules.AFTERNOON)
        .otherwise(rules.EVENING)
    )
    return df.withColumns({"transaction_hour": hour, "time_bucket": bucket})
