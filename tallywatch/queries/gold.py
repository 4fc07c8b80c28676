"""Dimensional model, reconciliation, feature table, flagship."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallywatch.operators import dims, quality
from tallywatch.plans import monitor
from tallywatch.queries.base import (
    BASE,
    FIRST_RUN,
    SALT,
    SECOND_RUN,
    SPLIT_STEP,
    big,
    dbl,
    register,
    rnd,
    sql_rnd,
)
from tallywatch.queries.rows import DRAIN_SQL, RATIO_SQL, ROSE_SQL, SEGMENT_SQL, TYPE_SQL, normal
from tallywatch.queries.windows import FEATURE_SQL
from tallywatch.session import scratch_dir
from tallywatch.sources import store
from tallywatch.sources.events import timed_transactions, transactions

# Silver with the columns the gold queries use; ``v`` valid, ``c`` valid and sane.
SILVER = BASE + f""", s as (
  select z.*, {TYPE_SQL}, {SEGMENT_SQL} as customer_segment,
    {FEATURE_SQL["account_activity"]} as account_activity,
    {FEATURE_SQL["account_audit_status"]} as account_audit_status,
    {FEATURE_SQL["is_first_action"]} as is_first_action,
    {FEATURE_SQL["is_behavioral_anomaly"]} as is_behavioral_anomaly,
    {FEATURE_SQL["behavioral_spike_ratio"]} as behavioral_spike_ratio,
    {FEATURE_SQL["avg_last_10_txns"]} as avg_last_10_txns,
    {FEATURE_SQL["txns_last_24h"]} as txns_last_24h
  from z),
v as (select * from s
  where step is not null and type is not null and amount > 0 and acct is not null),
c as (select * from v where abs(z_score) <= 50)
"""
ATTRS = "customer_segment, account_activity, account_audit_status"


def _states(source: str, where: str = "true") -> str:
    return f"""select acct, {ATTRS} from (select *, row_number() over (
        partition by acct order by step desc, txn_id desc) as rn
      from {source} where acct is not null and {where}) q where rn = 1"""


def silver(spark, d):
    return monitor.silver(transactions(spark, d), SALT)


def clean(spark, d):
    return monitor.clean_rows(silver(spark, d))[0]


def account_rows(df):
    """Dimension rows without the hash key; times as text."""
    return df.select(
        F.col("nameOrig_hashed").alias("account_hash"),
        *dims.ACCOUNT_ATTRS,
        "is_current",
        F.col("start_date").cast("string").alias("start_date"),
        F.col("end_date").cast("string").alias("end_date"),
    )


# -- dimensions -------------------------------------------------------------------


@register(
    "dim_date",
    """select txn_id, step, cast(w as date) as calendar_date, dayname(w) as day_name,
      cast(dayofweek(w) + 1 as bigint) as day_of_week, cast(hour(w) as int) as hour_of_day,
      case when hour(w) <= 6 or hour(w) >= 22 then 'High Risk' else 'Low Risk' end
        as temporal_risk_bucket
    from (select txn_id, step, timestamp '2025-01-01 00:00:00' + (step - 1) * interval 1 hour as w
      from n) q""",
)
def dim_date(spark, d):
    rows = normal(spark, d).select("txn_id", "step")
    return rows.join(dims.dim_date_of(rows).drop("step_sk"), "step")


@register("dim_txn_type", f"select distinct type, {TYPE_SQL} from n")
def dim_txn_type(spark, d):
    return dims.dim_txn_type(monitor.label(monitor.secure(transactions(spark, d), SALT))).drop(
        "txn_type_sk"
    )


@register(
    "dim_txn_type_refresh",
    f"""select type, {TYPE_SQL}, case when min(step) <= {SPLIT_STEP} then '{FIRST_RUN}'
        else '{SECOND_RUN}' end as last_updated
    from n where type <> 'DEBIT' or step > {SPLIT_STEP} group by type""",
)
def dim_txn_type_refresh(spark, d):
    # the first load lacks a type that the second one brings
    df = monitor.label(monitor.secure(transactions(spark, d), SALT))
    first = df.filter((F.col("step") <= SPLIT_STEP) & (F.col("type") != "DEBIT"))
    dim = dims.dim_txn_type(first).withColumn("last_updated", F.lit(FIRST_RUN).cast("timestamp"))
    out = dims.refresh_txn_type(dim, df.filter(F.col("step") > SPLIT_STEP), SECOND_RUN)
    when = F.date_format("last_updated", "yyyy-MM-dd HH:mm:ss").alias("last_updated")
    return out.select("type", "type_risk_level", "txn_category_risk", "fund_direction", when)


@register(
    "dim_account_initial",
    SILVER + f"""select acct as account_hash, {ATTRS}, true as is_current,
      '{FIRST_RUN}' as start_date, cast(null as varchar) as end_date from ({_states("c")}) q""",
)
def dim_account_initial(spark, d):
    return account_rows(dims.dim_account(clean(spark, d), FIRST_RUN))


# -- account history ----------------------------------------------------------------

HISTORY = SILVER + f""", d1 as ({_states("s", f"step <= {SPLIT_STEP}")}),
u as ({_states("s", f"step > {SPLIT_STEP}")}),
g as (select u.*, d1.acct is not null as known,
    d1.acct is not null and (u.customer_segment <> d1.customer_segment
      or u.account_activity <> d1.account_activity
      or u.account_audit_status <> d1.account_audit_status) as changed
  from u left join d1 on u.acct = d1.acct)
"""


def _batches(spark, d):
    df = silver(spark, d)
    return df.filter(F.col("step") <= SPLIT_STEP), df.filter(F.col("step") > SPLIT_STEP)


@register(
    "scd2_stage",
    HISTORY + f"""select acct as account_hash, {ATTRS}, known as is_existing_account,
      changed as attr_changed from g""",
)
def scd2_stage(spark, d):
    first, second = _batches(spark, d)
    staged = dims.scd2_stage(dims.account_states(second), dims.dim_account(first, FIRST_RUN))
    return staged.withColumnRenamed("nameOrig_hashed", "account_hash")


APPLIED = HISTORY + f"""select d1.acct as account_hash, d1.customer_segment, d1.account_activity,
      d1.account_audit_status, not coalesce(g.changed, false) as is_current,
      '{FIRST_RUN}' as start_date,
      case when coalesce(g.changed, false) then '{SECOND_RUN}' end as end_date
    from d1 left join g on d1.acct = g.acct
    union all
    select acct, {ATTRS}, true, '{SECOND_RUN}', null from g where changed or not known"""


@register("scd2_apply", APPLIED)
def scd2_apply(spark, d):
    first, second = _batches(spark, d)
    dim = dims.dim_account(first, FIRST_RUN)
    staged = dims.scd2_stage(dims.account_states(second), dim)
    return account_rows(dims.scd2_apply(dim, staged, SECOND_RUN))


@register("scd2_update", APPLIED)
def scd2_update(spark, d):
    first, second = _batches(spark, d)
    return account_rows(dims.scd2_update(dims.dim_account(first, FIRST_RUN), second, SECOND_RUN))


@register(
    "scd2_dedupe_current",
    HISTORY + f"""select account_hash, {ATTRS}, rn = 1 as is_current, start_date,
      case when rn > 1 then '{SECOND_RUN}' end as end_date
    from (select *, row_number() over (partition by account_hash order by start_date desc) as rn
      from (select acct as account_hash, {ATTRS}, '{FIRST_RUN}' as start_date from d1
        union all select acct, {ATTRS}, '{SECOND_RUN}' from u) a) b""",
)
def scd2_dedupe_current(spark, d):
    # two initial loads into one table leave accounts with two current rows
    first, second = _batches(spark, d)
    both = dims.dim_account(first, FIRST_RUN).unionByName(dims.dim_account(second, SECOND_RUN))
    return account_rows(dims.scd2_dedupe_current(both, SECOND_RUN))


@register(
    "key_lookup",
    HISTORY + f""", dim as ({APPLIED[len(HISTORY):]}),
    m as (select s.*, dim.start_date from s left join dim on s.acct = dim.account_hash
      and dim.start_date <= case when s.step > {SPLIT_STEP} then '{SECOND_RUN}'
        else '{FIRST_RUN}' end
      and (dim.end_date is null or dim.end_date > case when s.step > {SPLIT_STEP}
        then '{SECOND_RUN}' else '{FIRST_RUN}' end))
    select txn_id, min(txn_id) over (partition by acct, step, amount, type) as first_transaction,
      case when start_date is not null then min(txn_id) over (partition by acct, start_date) end
        as first_account,
      min(txn_id) over (partition by type) as first_type,
      min(txn_id) over (partition by step) as first_step from m""",
)
def key_lookup(spark, d):
    first, second = _batches(spark, d)
    dim = dims.scd2_update(dims.dim_account(first, FIRST_RUN), second, SECOND_RUN)
    rows = dims.add_keys(silver(spark, d)).withColumn(
        "at", F.when(F.col("step") > SPLIT_STEP, SECOND_RUN).otherwise(FIRST_RUN).cast("timestamp")
    )
    keyed = dims.lookup_account(rows, dim, "at")

    # the hashes are Spark's own: what SQL can tell is which rows share a key
    def first(key):
        return F.when(F.col(key).isNotNull(), F.min("txn_id").over(Window.partitionBy(key)))

    return keyed.select(
        "txn_id",
        first("transaction_sk").alias("first_transaction"),
        first("account_sk").alias("first_account"),
        first("txn_type_sk").alias("first_type"),
        first("step_sk").alias("first_step"),
    )


@register(
    "key_lookup_versions",
    HISTORY + f""", dim as ({APPLIED[len(HISTORY):]})
    select s.txn_id, dim.start_date as version_start, dim.is_current as version_is_current
    from s left join dim on s.acct = dim.account_hash
      and dim.start_date <= case when s.step > {SPLIT_STEP} then '{SECOND_RUN}'
        else '{FIRST_RUN}' end
      and (dim.end_date is null or dim.end_date > case when s.step > {SPLIT_STEP}
        then '{SECOND_RUN}' else '{FIRST_RUN}' end)""",
)
def key_lookup_versions(spark, d):
    # which version each row was given, told by its attributes instead of its hash
    first, second = _batches(spark, d)
    dim = dims.scd2_update(dims.dim_account(first, FIRST_RUN), second, SECOND_RUN)
    at = F.when(F.col("step") > SPLIT_STEP, SECOND_RUN).otherwise(FIRST_RUN).cast("timestamp")
    rows = silver(spark, d).select("txn_id", "nameOrig_hashed", at.alias("at"))
    found = dims.lookup_account(rows, dim, "at").select("txn_id", "account_sk")
    versions = dim.select(
        "account_sk",
        F.col("start_date").cast("string").alias("version_start"),
        F.col("is_current").alias("version_is_current"),
    )
    return found.join(versions, "account_sk", "left").drop("account_sk")


# -- fact, features -------------------------------------------------------------------


@register(
    "fact_transactions",
    SILVER + f"""select txn_id, acct as account_hash, cast(amount as double) as amount,
      cast(oldbalanceOrg as double) as old_balance, cast(newbalanceOrig as double) as new_balance,
      case when type = 'TRANSFER' and amount > 200000 then 'High Risk'
        when amount > 100000 then 'Medium Risk' else 'Low Risk' end as risk_score,
      cast(floor((step - 1) / 24.0) as bigint) % 7 + 1 as day_of_week,
      {sql_rnd(RATIO_SQL)} as balance_drain_ratio, {sql_rnd("z_score")} as z_score,
      isFraud as is_fraud, is_behavioral_anomaly, is_first_action,
      case when amount % 100 = 0 then 1 else 0 end as is_round_number,
      {DRAIN_SQL} as is_drain_event,
      case when {ROSE_SQL} or step < 1 or step > 1000 then 1 else 0 end as has_logical_error,
      case when {ROSE_SQL} then 'WARN: Balance increased during Transfer' else '' end as audit_note
    from c""",
)
def fact_transactions(spark, d):
    facts = monitor.gold(silver(spark, d), FIRST_RUN).fact
    return facts.select(
        "txn_id",
        F.col("nameOrig_hashed").alias("account_hash"),
        dbl("amount").alias("amount"),
        dbl("oldbalanceOrg").alias("old_balance"),
        dbl("newbalanceOrig").alias("new_balance"),
        "risk_score",
        "day_of_week",
        rnd("balance_drain_ratio").alias("balance_drain_ratio"),
        rnd("z_score").alias("z_score"),
        F.col("isFraud").cast("int").alias("is_fraud"),
        "is_behavioral_anomaly",
        "is_first_action",
        "is_round_number",
        "is_drain_event",
        "has_logical_error",
        "audit_note",
    )


@register(
    "feature_table",
    SILVER + f"""select txn_id, cast(amount as double) as amount,
      coalesce({sql_rnd("z_score")}, 0) as z_score,
      coalesce(behavioral_spike_ratio, 1) as behavioral_spike_ratio,
      coalesce(txns_last_24h, 0) as txns_last_24h,
      coalesce({sql_rnd(RATIO_SQL)}, 0) as balance_drain_ratio,
      coalesce(avg_last_10_txns, 0) as avg_last_10_txns, is_first_action, isFraud as is_fraud,
      case when type_risk_level = 'High' then 1 else 0 end as is_high_risk_type from v""",
)
def feature_table(spark, d):
    table = monitor.feature_table(silver(spark, d), key="txn_id")
    return table.select(
        "txn_id",
        dbl("amount").alias("amount"),
        rnd("z_score").alias("z_score"),
        rnd("behavioral_spike_ratio").alias("behavioral_spike_ratio"),
        "txns_last_24h",
        rnd("balance_drain_ratio").alias("balance_drain_ratio"),
        rnd("avg_last_10_txns").alias("avg_last_10_txns"),
        "is_first_action",
        F.col("isFraud").cast("int").alias("is_fraud"),
        "is_high_risk_type",
    )


# -- reconciliation --------------------------------------------------------------------
# The dimension is the first batch's, so accounts first seen later are orphans.

RECON = SILVER + f""", d1 as ({_states("c", f"step <= {SPLIT_STEP}")}),
r as (select (select count(*) from n) as silver_rows, (select count(*) from c) as fact_rows,
  (select cast(coalesce(sum(amount), 0) as double) from n) as silver_amount,
  (select cast(coalesce(sum(amount), 0) as double) from c) as fact_amount,
  (select count(*) from c where acct not in (select acct from d1)) as orphan_rows,
  (select count(*) from n) - (select count(*) from c) as filtered_rows,
  (select cast(abs(coalesce(sum(amount), 0) - (select coalesce(sum(amount), 0) from c)) as double)
    from n) as amount_diff)
"""


def _report(spark, d):
    df = silver(spark, d)
    facts = monitor.clean_rows(df)[0]
    dim = dims.dim_account(facts.filter(F.col("step") <= SPLIT_STEP), FIRST_RUN)
    return quality.reconcile(df, facts, dim)


@register("dq_reconcile", RECON + "select * from r")
def dq_reconcile(spark, d):
    return _report(spark, d).select(
        *[big(c).alias(c) for c in ("silver_rows", "fact_rows", "orphan_rows", "filtered_rows")],
        *[dbl(c).alias(c) for c in ("silver_amount", "fact_amount", "amount_diff")],
    )


@register(
    "dq_diverted",
    SILVER + """select (select count(*) from n) as silver_rows, (select count(*) from c) as fact_rows,
      (select count(*) from n) - (select count(*) from v) as quarantined_rows,
      (select count(*) from v) - (select count(*) from c) as failed_rows, true as explained""",
)
def dq_diverted(spark, d):
    # what is put aside is stored, and counted from there
    df = silver(spark, d)
    kept, quarantine, failures = monitor.clean_rows(df)
    stored = []
    for name, rows in (("quarantine", quarantine), ("math-failures", failures)):
        path = scratch_dir(spark, name)
        store.write_table(rows, path)
        stored.append(store.read_table(spark, path))
    return quality.diverted(df, kept, *stored)


@register("dq_enforce", RECON + "select orphan_rows = 0 and fact_rows <= silver_rows as passes from r")
def dq_enforce(spark, d):
    return _report(spark, d).select("passes")


@register("dq_missing_rows", SILVER + "select txn_id from n where txn_id not in (select txn_id from c)")
def dq_missing_rows(spark, d):
    df = silver(spark, d)
    return quality.missing_rows(df, monitor.clean_rows(df)[0], ["txn_id"]).select("txn_id")


@register("dq_orphans", RECON + "select txn_id from c where acct not in (select acct from d1)")
def dq_orphans(spark, d):
    facts = clean(spark, d)
    dim = dims.dim_account(facts.filter(F.col("step") <= SPLIT_STEP), FIRST_RUN)
    return quality.missing_rows(facts, dim, ["nameOrig_hashed"]).select("txn_id")


# -- flagship ---------------------------------------------------------------------------


@register(
    "flagship",
    BASE + f""", k as (select z2.*, count(amount) over (partition by acct order by step
        range between 23 preceding and current row) as velocity
      from (select v.*, case when s.sd > 0 then (cast(v.amount as double) - s.mu) / s.sd end as zs
        from (select * from n where step is not null and amount > 0 and acct is not null) v
        left join (select type, stddev_samp(cast(amount as double)) as sd,
            cast(sum(amount) as double) / count(amount) as mu
          from n where step is not null and amount > 0 and acct is not null group by type) s
        on v.type = s.type) z2)
    select acct as account_hash, count(*) as txn_count, cast(sum(amount) as double) as total_amount,
      {sql_rnd("max(zs)")} as max_z_score, max(velocity) as max_velocity,
      count(case when type in ('TRANSFER', 'CASH_OUT') and zs > 2 then 1 end) as alarming_rows,
      count(case when isFraud = 1 then 1 end) as fraud_rows
    from k group by acct
    having count(case when type in ('TRANSFER', 'CASH_OUT') and zs > 2 then 1 end) > 0""",
)
def flagship(spark, d):
    out = monitor.abnormal_outbound(transactions(spark, d), SALT)
    return out.select(
        F.col("nameOrig_hashed").alias("account_hash"),
        "txn_count",
        dbl("total_amount").alias("total_amount"),
        rnd("max_z_score").alias("max_z_score"),
        "max_velocity",
        "alarming_rows",
        "fraud_rows",
    )
