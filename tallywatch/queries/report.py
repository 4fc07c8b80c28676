"""Report measures, cards, charts and the daily mart, over the clean fact rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallywatch.operators import dims
from tallywatch.plans import report
from tallywatch.queries.base import dbl, register, rnd, sql_rnd
from tallywatch.queries.gold import SILVER, clean

FRAUD = "coalesce(sum(case when isFraud = 1 then amount end), 0)"
WHEN = "timestamp '2025-01-01 00:00:00' + (step - 1) * interval 1 hour"


def _card(name, columns, sql):
    @register(name, SILVER + sql)
    def query(spark, d):
        out = report.measures(clean(spark, d))
        return out.select(*[_shown(c) for c in columns])


def _shown(column):
    if column.endswith("volume"):
        return dbl(column).alias(column)
    if column == "fraud_rate":
        return rnd(column, 6).alias(column)
    return F.col(column)


VOLUME_SQL = "cast(sum(amount) as double) as total_volume"
FRAUD_SQL = f"cast({FRAUD} as double) as fraud_volume"
RATE_SQL = f"""{sql_rnd(f"coalesce(cast({FRAUD} as double) / nullif(cast(sum(amount) as double), 0), 0)", 6)}
      as fraud_rate"""
COUNTS_SQL = """count(case when isFraud = 1 then 1 end) as fraud_count,
      count(case when isFraud = 0 then 1 end) as non_fraud_count,
      count(case when upper(type_risk_level) in ('HIGH', 'CRITICAL') then 1 end)
        as high_risk_count"""

_card("m_total_volume", ["total_volume"], f"select {VOLUME_SQL} from c")
_card("m_fraud_volume", ["fraud_volume"], f"select {FRAUD_SQL} from c")
_card("m_fraud_rate", ["fraud_rate"], f"select {RATE_SQL} from c")
_card(
    "m_counts",
    ["fraud_count", "non_fraud_count", "high_risk_count"],
    f"select {COUNTS_SQL} from c",
)
_card(
    "v_cards",
    list(report.MEASURES),
    f"select {VOLUME_SQL}, {FRAUD_SQL}, {RATE_SQL}, {COUNTS_SQL} from c",
)


@register(
    "m_formatted_amount",
    SILVER + """select acct as account_hash, case when count(distinct amount) = 1
        then '$' || format('{:,.2f}', cast(min(amount) as double)) else '' end as formatted_amount
    from c group by acct, step""",
)
def m_formatted_amount(spark, d):
    out = clean(spark, d).groupBy("nameOrig_hashed", "step")
    return out.agg(report.formatted_amount().alias("formatted_amount")).select(
        F.col("nameOrig_hashed").alias("account_hash"), "formatted_amount"
    )


@register(
    "v_fraud_by_step",
    SILVER + f"select step, {FRAUD_SQL} from c group by step",
)
def v_fraud_by_step(spark, d):
    facts = clean(spark, d)
    out = report.by_step(facts, dims.dim_date_of(facts))
    return out.select("step", _shown("fraud_volume"))


@register(
    "v_fraud_by_risk_dim",
    SILVER + f"select type_risk_level, {FRAUD_SQL} from c group by type_risk_level",
)
def v_fraud_by_risk_dim(spark, d):
    facts = clean(spark, d)
    out = report.by_type_level(facts, dims.dim_txn_type(facts))
    return out.select("type_risk_level", _shown("fraud_volume"))


@register(
    "v_fraud_by_risk_fact",
    SILVER + f"select type_risk_level, {FRAUD_SQL} from c group by type_risk_level",
)
def v_fraud_by_risk_fact(spark, d):
    out = report.fraud_volume_by(clean(spark, d), "type_risk_level")
    return out.select("type_risk_level", _shown("fraud_volume"))


@register(
    "v_detail",
    SILVER + f"""select acct as account_hash, type_risk_level, {sql_rnd("z_score")} as z_score,
      txns_last_24h, case when count(distinct amount) = 1
        then '$' || format('{{:,.2f}}', cast(min(amount) as double)) else '' end
        as formatted_amount
    from c where type_risk_level in ('Low', 'High')
    group by acct, type_risk_level, c.z_score, txns_last_24h""",
)
def v_detail(spark, d):
    return report.detail(clean(spark, d)).select(
        F.col("nameOrig_hashed").alias("account_hash"),
        "type_risk_level",
        rnd("z_score").alias("z_score"),
        "txns_last_24h",
        "formatted_amount",
    )


@register(
    "v_slice_risk",
    SILVER + f"""select {VOLUME_SQL},
      cast(coalesce(sum(case when isFraud = 1 and type_risk_level = 'Low' then amount end), 0)
        as double) as fraud_volume,
      count(case when isFraud = 1 and type_risk_level = 'Low' then 1 end) as fraud_count,
      count(case when isFraud = 0 and type_risk_level = 'Low' then 1 end) as non_fraud_count,
      cast(0 as bigint) as high_risk_count from c""",
)
def v_slice_risk(spark, d):
    out = report.measures(clean(spark, d), levels=["Low"])
    return out.select(
        _shown("total_volume"),
        _shown("fraud_volume"),
        "fraud_count",
        "non_fraud_count",
        "high_risk_count",
    )


@register(
    "v_slice_date",
    SILVER + f"""select {VOLUME_SQL}, {FRAUD_SQL}, {COUNTS_SQL} from c
    where {WHEN} >= timestamp '2025-01-10 00:00:00' and {WHEN} < timestamp '2025-01-20 00:00:00'""",
)
def v_slice_date(spark, d):
    facts = clean(spark, d)
    inside = report.in_dates(facts, dims.dim_date_of(facts), "2025-01-10", "2025-01-20")
    out = report.measures(inside)
    return out.select(
        _shown("total_volume"),
        _shown("fraud_volume"),
        "fraud_count",
        "non_fraud_count",
        "high_risk_count",
    )


@register(
    "agg_daily_fraud",
    SILVER + f"""select cast(dayofweek({WHEN}) + 1 as bigint) as day_of_week, type_risk_level,
      cast(sum(amount) as double) as total_amount,
      count(case when isFraud = 1 then 1 end) as fraud_count
    from c group by 1, 2""",
)
def agg_daily_fraud(spark, d):
    facts = clean(spark, d)
    out = report.daily_fraud(facts, dims.dim_date_of(facts), dims.dim_txn_type(facts))
    return out.select(
        "day_of_week", "type_risk_level", dbl("total_amount").alias("total_amount"), "fraud_count"
    )
