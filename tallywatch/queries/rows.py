"""Per-row operators, gates and statistics."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallywatch.functions import labels, ledger, standard, timeparts
from tallywatch.operators import quality, stats
from tallywatch.plans.monitor import label, secure
from tallywatch.queries.base import SALT, big, dbl, register, rnd, sql_rnd
from tallywatch.sources import landing
from tallywatch.sources.events import read_events, transactions


def normal(spark, d):
    return standard.normalize(transactions(spark, d))


def masked(spark, d):
    return standard.mask(normal(spark, d), SALT)


def labelled(spark, d):
    return label(secure(transactions(spark, d), SALT))


# -- standardise and mask ------------------------------------------------------


@register(
    "std_types",
    """select txn_id, step, type, cast(amount as double) as amount,
      cast(oldbalanceOrg as double) as old_orig, cast(newbalanceDest as double) as new_dest,
      isFraud = 1 as is_fraud, isFlaggedFraud = 1 as is_flagged from n""",
)
def std_types(spark, d):
    return normal(spark, d).select(
        "txn_id",
        "step",
        "type",
        dbl("amount").alias("amount"),
        dbl("oldbalanceOrg").alias("old_orig"),
        dbl("newbalanceDest").alias("new_dest"),
        F.col("isFraud").alias("is_fraud"),
        F.col("isFlaggedFraud").alias("is_flagged"),
    )


@register("mask_sha256", "select txn_id, acct as account_hash, dest as dest_hash from n")
def mask_sha256(spark, d):
    return masked(spark, d).select(
        "txn_id",
        F.col("nameOrig_hashed").alias("account_hash"),
        F.col("nameDest_hashed").alias("dest_hash"),
    )


@register(
    "mask_sha256_plain",
    "select txn_id, sha256(nameOrig) as account_hash, sha256(nameDest) as dest_hash from t",
)
def mask_sha256_plain(spark, d):
    out = standard.mask(transactions(spark, d), "", clean=False)
    return out.select(
        "txn_id",
        F.col("nameOrig_hashed").alias("account_hash"),
        F.col("nameDest_hashed").alias("dest_hash"),
    )


@register(
    "key_xxhash64",
    """select txn_id, min(txn_id) over (partition by step, acct, amount) as first_with_key,
      true as key_as_text from n""",
)
def key_xxhash64(spark, d):
    # the hash itself is Spark's own: what SQL can tell is which rows share it
    keyed = standard.surrogate_key(masked(spark, d))
    same = Window.partitionBy("transaction_sk")
    text = F.col("transaction_sk").cast("string")
    return keyed.select(
        "txn_id",
        F.min("txn_id").over(same).alias("first_with_key"),
        (text.cast("long") == F.col("transaction_sk")).alias("key_as_text"),
    )


@register(
    "row_fingerprint",
    """select txn_id, sha256(concat_ws('||', cast(txn_id as varchar), nameOrig,
      cast(amount as varchar))) as row_fingerprint from t""",
)
def row_fingerprint(spark, d):
    raw = transactions(spark, d)
    return standard.fingerprint(raw, ["txn_id", "nameOrig", "amount"]).select(
        "txn_id", "row_fingerprint"
    )


@register("exec_lineage", "select txn_id, true as has_job, true as has_partition from t")
def exec_lineage(spark, d):
    traced = standard.add_exec_cols(transactions(spark, d))
    return traced.select(
        "txn_id",
        F.col("spark_job_id").isNotNull().alias("has_job"),
        (F.col("partition_id") >= 0).alias("has_partition"),
    )


@register(
    "ingest_audit_cols",
    """with t as (select event_id from events)
    select event_id, '2025-01-01 00:00:00' as ingestion_timestamp, true as from_table,
      'New' as status, true as is_pii_flag, 'run-1' as job_run_id from t""",
)
def ingest_audit_cols(spark, d):
    raw = landing.add_audit_cols(read_events(spark, d), "run-1", "2025-01-01 00:00:00")
    return raw.select(
        "event_id",
        F.date_format("ingestion_timestamp", "yyyy-MM-dd HH:mm:ss").alias("ingestion_timestamp"),
        # the table is one file or a folder of them
        F.col("source_file").contains("/events.parquet").alias("from_table"),
        "status",
        "is_pii_flag",
        "job_run_id",
    )


# -- labels ---------------------------------------------------------------------

RISK_SQL = """case when type = 'TRANSFER' and amount > 200000 then 'High Risk'
      when amount > 100000 then 'Medium Risk' else 'Low Risk' end"""
EMPTIED_SQL = "case when amount > 100000 and newbalanceOrig = 0 then 1 else 0 end"


@register(
    "label_risk",
    f"""select txn_id, {RISK_SQL} as risk_score, {RISK_SQL} as material_risk_level,
      case when amount > 100000 and newbalanceOrig = 0 then 'Critical - Account Emptied'
        else 'Normal' end as fraud_pattern,
      amount > oldbalanceOrg as is_overdraft,
      case when amount < 0 and type = 'TRANSFER' then 1 else 0 end as is_suspicious_flag
    from n""",
)
def label_risk(spark, d):
    return labels.label_risk(normal(spark, d)).select(
        "txn_id",
        "risk_score",
        "material_risk_level",
        "fraud_pattern",
        "is_overdraft",
        "is_suspicious_flag",
    )


@register(
    "label_dest",
    """select txn_id, nameDest like 'M%' as is_merchant_dest,
      oldbalanceDest = 0 and newbalanceDest = 0 and amount > 0 as is_new_destination,
      oldbalanceDest = 0 and newbalanceDest = 0 as is_untracked_destination from n""",
)
def label_dest(spark, d):
    return labels.label_dest(normal(spark, d)).select(
        "txn_id", "is_merchant_dest", "is_new_destination", "is_untracked_destination"
    )


TYPE_SQL = """case when type in ('TRANSFER', 'CASH_OUT') then 'HIGH_RISK' else 'LOW_RISK' end
        as txn_category_risk,
      case when type in ('TRANSFER', 'CASH_OUT') then 'High' else 'Low' end as type_risk_level,
      case when type in ('CASH_OUT', 'TRANSFER', 'DEBIT') then 'Outbound'
        when type in ('CASH_IN', 'PAYMENT') then 'Inbound' else 'Internal' end as fund_direction"""


@register("label_type", f"select txn_id, type, {TYPE_SQL} from n")
def label_type(spark, d):
    return labels.label_type(normal(spark, d)).select(
        "txn_id", "type", "txn_category_risk", "type_risk_level", "fund_direction"
    )


SEGMENT_SQL = """case when amount > 500000 then 'Platinum' when amount > 100000 then 'Gold'
      else 'Standard' end"""


@register(
    "label_segment",
    f"""select txn_id, {SEGMENT_SQL} as customer_segment,
      case when amount < 1000 then 'Retail' when amount < 50000 then 'Professional'
        when amount < 500000 then 'Institutional' else 'Ultra High Net Worth' end as segment
    from n""",
)
def label_segment(spark, d):
    return labels.label_segment(normal(spark, d)).select("txn_id", "customer_segment", "segment")


@register(
    "label_number",
    """select txn_id, case when amount % 100 = 0 then 1 else 0 end as is_round_number,
      try_cast(substring(cast(amount as varchar), 1, 1) as int) as first_digit from n""",
)
def label_number(spark, d):
    return labels.label_number(normal(spark, d)).select("txn_id", "is_round_number", "first_digit")


DRAIN_SQL = """case when oldbalanceOrg > 0 and amount * 100 > 90 * oldbalanceOrg
      then 1 else 0 end"""
RATIO_SQL = """case when oldbalanceOrg > 0
      then cast(amount as double) / cast(oldbalanceOrg as double) * 100 else 0 end"""


@register(
    "drain",
    f"""select txn_id, {sql_rnd(RATIO_SQL)} as balance_drain_ratio,
      {DRAIN_SQL} as is_drain_event from n""",
)
def drain(spark, d):
    return labels.drain(normal(spark, d)).select(
        "txn_id", rnd("balance_drain_ratio").alias("balance_drain_ratio"), "is_drain_event"
    )


# -- ledger ---------------------------------------------------------------------


@register(
    "ledger_gaps",
    """select txn_id, cast(gap as double) as origin_gap,
      cast(abs(oldbalanceDest + amount - newbalanceDest) as double) as dest_gap,
      coalesce(gap < 0.01 and abs(oldbalanceDest + amount - newbalanceDest) < 0.01, false)
        as is_ledger_balanced,
      case when amount <> 0
        then round(cast(gap * 100 as double) / cast(amount * 100 as double)) else 0 end
        as relative_origin_error,
      math_ok as is_math_correct, math_ok = 1 as is_balance_consistent from n""",
)
def ledger_gaps(spark, d):
    return ledger.ledger_gaps(normal(spark, d)).select(
        "txn_id",
        dbl("origin_gap").alias("origin_gap"),
        dbl("dest_gap").alias("dest_gap"),
        "is_ledger_balanced",
        "relative_origin_error",
        "is_math_correct",
        "is_balance_consistent",
    )


TIER_SQL = """case when gap < 0.01 then 'A_PERFECT_LEDGER' when gap < 1.00 then 'B_ROUNDING_ERROR'
      when gap = amount then 'C_GHOST_TRANSFER' else 'D_SYSTEM_ANOMALY' end"""


@register("ledger_tier", f"select txn_id, {TIER_SQL} as quality_tier from n")
def ledger_tier(spark, d):
    out = ledger.quality_tier(ledger.ledger_gaps(normal(spark, d)))
    return out.select("txn_id", "quality_tier")


@register(
    "ledger_report",
    f"""select {TIER_SQL} as quality_tier, count(*) as record_count,
      {sql_rnd("cast(sum(amount) as double) / nullif(count(amount), 0)")} as average_transfer_val,
      cast(max(gap) as double) as max_discrepancy from n group by 1 order by 1""",
)
def ledger_report(spark, d):
    tiers = ledger.quality_tier(ledger.ledger_gaps(normal(spark, d)))
    return ledger.audit_report(tiers).select(
        "quality_tier",
        "record_count",
        rnd("average_transfer_val").alias("average_transfer_val"),
        dbl("max_discrepancy").alias("max_discrepancy"),
    )


@register(
    "dq_summary",
    f"""select {sql_rnd("cast(sum(amount) as double) / nullif(count(amount), 0)", 2)}
        as avg_txn_amount,
      cast(sum({DRAIN_SQL}) as bigint) as total_drain_events,
      count(case when type = 'TRANSFER' and amount > 200000 then 1 end) as high_risk_count
    from n""",
)
def dq_summary(spark, d):
    return ledger.summary(labels.drain(labels.label_risk(normal(spark, d))))


# -- gates ------------------------------------------------------------------------


@register(
    "dq_gate",
    """select count(*) as row_count,
      count(case when amount is null or type is null then 1 end) as null_count,
      count(case when amount is null or type is null then 1 end) / cast(count(*) as double)
        as null_ratio,
      count(*) = 0 as is_empty,
      count(case when amount is null or type is null then 1 end)
        / cast(count(*) as double) <= 0.1 as passes from n""",
)
def dq_gate(spark, d):
    return quality.gate(normal(spark, d))


@register("dq_negative", "select count(case when amount < 0 then 1 end) as invalid_count from n")
def dq_negative(spark, d):
    return quality.count_invalid(normal(spark, d))


@register(
    "dq_null_profile",
    """select count(case when txn_id is null then 1 end) / cast(count(*) as double) as txn_id,
      count(case when acct is null then 1 end) / cast(count(*) as double) as account_hash,
      count(case when amount is null then 1 end) / cast(count(*) as double) as amount from n""",
)
def dq_null_profile(spark, d):
    renamed = masked(spark, d).withColumnRenamed("nameOrig_hashed", "account_hash")
    return quality.null_profile(renamed, ["txn_id", "account_hash", "amount"])


VALID_SQL = "step is not null and type is not null and amount > 0 and acct is not null"


@register(
    "dq_valid",
    f"select txn_id, acct as account_hash, cast(amount as double) as amount from n "
    f"where {VALID_SQL}",
)
def dq_valid(spark, d):
    kept = quality.split_valid(masked(spark, d), ["step", "type"]).kept
    return kept.select(
        "txn_id", F.col("nameOrig_hashed").alias("account_hash"), dbl("amount").alias("amount")
    )


@register(
    "dq_quarantine",
    f"""select txn_id, case when step is null or type is null then 'Missing Surrogate Key'
        when amount is null then 'Missing Amount'
        when amount <= 0 then 'Negative or Zero Amount'
        else 'Missing Originator Identity' end as quarantine_reason
    from n where not coalesce({VALID_SQL}, false)""",
)
def dq_quarantine(spark, d):
    rejected = quality.split_valid(masked(spark, d), ["step", "type"]).rejected
    return rejected.select("txn_id", "quarantine_reason")


ROSE_SQL = "(type = 'TRANSFER' and newbalanceOrig > oldbalanceOrg)"


@register(
    "dq_logical_error",
    f"""select txn_id, case when {ROSE_SQL} or step < 1 or step > 1000 then 1 else 0 end
      as has_logical_error from n""",
)
def dq_logical_error(spark, d):
    return quality.logical_errors(normal(spark, d)).select("txn_id", "has_logical_error")


@register(
    "dq_audit_note",
    f"""select txn_id, concat_ws(' | ',
        case when {ROSE_SQL} then 'WARN: Balance increased during Transfer' end,
        case when step < 100 or step > 500
          then 'WARN: Step value outside simulation bounds' end) as audit_note from n""",
)
def dq_audit_note(spark, d):
    # narrower step bounds than the default, so that both notes occur
    return quality.audit_note(normal(spark, d), 100, 500).select("txn_id", "audit_note")


# -- statistics ---------------------------------------------------------------------


@register(
    "agg_type_stats",
    f"""select type, {sql_rnd("mu")} as avg_amount, {sql_rnd("sd")} as stddev_amount from st""",
)
def agg_type_stats(spark, d):
    return stats.type_stats(normal(spark, d)).select(
        "type", rnd("avg_amount").alias("avg_amount"), rnd("stddev_amount").alias("stddev_amount")
    )


def scored(spark, d):
    return stats.zscore(normal(spark, d), keep_stats=True)


@register("stat_zscore", f"select txn_id, {sql_rnd('z_score')} as z_score from z")
def stat_zscore(spark, d):
    return scored(spark, d).select("txn_id", rnd("z_score").alias("z_score"))


@register(
    "stat_outlier",
    """select txn_id, case when abs(z_score) > 3 then 1 else 0 end as is_statistical_outlier
    from z""",
)
def stat_outlier(spark, d):
    return scored(spark, d).select("txn_id", "is_statistical_outlier")


@register(
    "stat_relative_volume",
    f"""select txn_id, {sql_rnd("cast(amount as double) / mu", 2)} as relative_volume_index
    from z""",
)
def stat_relative_volume(spark, d):
    return scored(spark, d).select("txn_id", "relative_volume_index")


@register(
    "stat_zscore_by_step",
    f"""select txn_id, {sql_rnd("z")} as z_score from (
      select n.txn_id, case when s.sd > 0 then (cast(n.amount as double) - s.mu) / s.sd end as z
      from n left join (select step, stddev_samp(cast(amount as double)) as sd,
          cast(sum(amount) as double) / nullif(count(amount), 0) as mu from n group by step) s
        on n.step = s.step) q""",
)
def stat_zscore_by_step(spark, d):
    # the limit forces the join that is used when statistics are too many to copy
    by_step = stats.zscore(normal(spark, d), "step", max_rows=100)
    return by_step.select("txn_id", rnd("z_score").alias("z_score"))


@register(
    "topk_outliers",
    f"""select txn_id, type, {sql_rnd('z_score')} as z_score from z where z_score is not null
    order by z.z_score desc, txn_id limit 16""",
)
def topk_outliers(spark, d):
    return stats.top_outliers(scored(spark, d), 16).select(
        "txn_id", "type", rnd("z_score").alias("z_score")
    )


@register(
    "dq_math_sane",
    """select txn_id, case when coalesce(abs(z_score) <= 3, false) then 1 else 0 end
        as is_mathematically_sane,
      case when z_score is null then 'no variance' when abs(z_score) > 3
        then 'z-score out of bounds' else 'sane' end as audit_reason
    from z""",
)
def dq_math_sane(spark, d):
    # a narrow bound, so that both sides have rows
    kept, rejected = quality.split_sane(scored(spark, d), 3)
    out = kept.withColumn("audit_reason", F.lit("sane")).unionByName(rejected)
    return out.select("txn_id", "is_mathematically_sane", "audit_reason")


# -- time -----------------------------------------------------------------------------


@register(
    "time_parts",
    """select txn_id, step % 24 as hour_of_day,
      cast(floor(step / 24.0) as bigint) % 7 + 1 as day_of_week,
      case when step % 24 <= 4 or step % 24 >= 23 then 'Late Night' else 'Standard Hours' end
        as temporal_risk_bucket,
      (step - 1) % 24 as sim_hour, cast(floor((step - 1) / 24.0) as bigint) % 7 + 1 as sim_day,
      case when (step - 1) % 24 <= 4 or (step - 1) % 24 >= 23 then 'Late Night'
        else 'Standard Hours' end as sim_risk_bucket,
      cast(hour(w) as int) as cal_hour, dayofweek(w) + 1 as cal_dow,
      case when hour(w) <= 6 or hour(w) >= 22 then 'High Risk' else 'Low Risk' end
        as cal_risk_bucket
    from (select txn_id, step,
        timestamp '2025-01-01 00:00:00' + (step - 1) * interval 1 hour as w from n) q""",
)
def time_parts(spark, d):
    return timeparts.time_parts(normal(spark, d)).select(
        "txn_id",
        "hour_of_day",
        "day_of_week",
        "temporal_risk_bucket",
        "sim_hour",
        "sim_day",
        "sim_risk_bucket",
        "cal_hour",
        "cal_dow",
        "cal_risk_bucket",
    )


@register(
    "time_bucket4",
    """select event_id as txn_id, cast(extract(hour from ts) as int) as transaction_hour,
      case when extract(hour from ts) >= 23 or extract(hour from ts) <= 4 then 'Late Night'
        when extract(hour from ts) between 5 and 11 then 'Morning'
        when extract(hour from ts) between 12 and 17 then 'Afternoon'
        else 'Evening' end as time_bucket from events""",
)
def time_bucket4(spark, d):
    out = timeparts.time_bucket4(read_events(spark, d))
    return out.select(F.col("event_id").alias("txn_id"), "transaction_hour", "time_bucket")


# -- keys and layers -------------------------------------------------------------------


@register(
    "dedupe_key",
    """select step, account, cast(amount as double) as amount, txn_id from (
      select step, nameOrig as account, amount, txn_id,
        row_number() over (partition by step, nameOrig order by txn_id) as rn from t) q
    where rn = 1""",
)
def dedupe_key(spark, d):
    out = quality.dedupe(transactions(spark, d), ["step", "nameOrig"], ["txn_id"])
    return out.select(
        "step", F.col("nameOrig").alias("account"), dbl("amount").alias("amount"), "txn_id"
    )


@register(
    "dq_duplicate_keys",
    """select step, nameOrig as account, count(*) as n from t group by step, nameOrig
    having count(*) > 1""",
)
def dq_duplicate_keys(spark, d):
    out = quality.duplicate_keys(transactions(spark, d), ["step", "nameOrig"])
    return out.withColumnRenamed("nameOrig", "account").withColumn("n", big("n"))
