"""Window operators: per account, per destination, per type.

The ``*_split`` queries run the same operators with a limit so low that most
accounts take the lane for hot keys; they answer to the same SQL.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tallywatch.functions import labels
from tallywatch.functions.standard import mask
from tallywatch.operators import quality
from tallywatch.operators import windows as w
from tallywatch.queries.base import ACCT, BASE, SALT, big, dbl, register, rnd, sql_rnd
from tallywatch.queries.rows import masked, normal
from tallywatch.sources.events import timed_transactions

SPLIT_ROWS = 40  # at sf0.01 an account has about 70 rows

ROWS = "partition by acct order by step, txn_id"
STEPS = "partition by acct order by step range between unbounded preceding and current row"
SO_FAR = f"{ROWS} rows between unbounded preceding and current row"
TEN = f"{ROWS} rows between 10 preceding and 1 preceding"
THIRTY = f"{ROWS} rows between 30 preceding and 1 preceding"
AMOUNT = "cast(amount as double)"


def _avg(over: str) -> str:
    return f"cast(sum(amount) over ({over}) as double) / nullif(count(amount) over ({over}), 0)"


# One SQL column per feature; queries pick from these.
FEATURE_SQL = {
    "prev_step": f"lag(step) over ({ROWS})",
    "prev_amount": f"cast(lag(amount) over ({ROWS}) as double)",
    "hours_since_last_txn": f"step - lag(step) over ({ROWS})",
    "time_since_last_txn": f"step - lag(step) over ({ROWS})",
    "amount_diff": f"cast(coalesce(amount - coalesce(lag(amount) over ({ROWS}), 0), 0) as double)",
    "txns_last_24h": "count(amount) over (partition by acct order by step "
    "range between 23 preceding and current row)",
    "txn_velocity_level": "case when count(amount) over (partition by acct order by step range "
    "between 23 preceding and current row) > 3 then 'High Velocity' else 'Normal' end",
    "running_total_outflow": f"cast(sum(amount) over ({STEPS}) as double)",
    "cumulative_outflow": f"cast(sum(amount) over ({SO_FAR}) as double)",
    "drainage_ratio": sql_rnd(
        f"{AMOUNT} / nullif(cast(sum(amount) over ({STEPS}) as double), 0) * 100", 2
    ),
    "pct_of_total_outflow": sql_rnd(
        f"{AMOUNT} / nullif(cast(sum(amount) over ({SO_FAR}) as double), 0) * 100"
    ),
    "historical_avg_amount": sql_rnd(_avg(SO_FAR)),
    "avg_historical_amount": sql_rnd(_avg(STEPS)),
    "avg_last_10_txns": sql_rnd(_avg(TEN)),
    "behavioral_spike_ratio": sql_rnd(
        f"case when {_avg(SO_FAR)} > 0 then {AMOUNT} / ({_avg(SO_FAR)}) else 1 end"
    ),
    "behavioral_anomaly": f"case when {_avg(SO_FAR)} > 0 and {AMOUNT} / ({_avg(SO_FAR)}) > 5 "
    "then 'Abnormal' else 'Normal' end",
    "is_behavioral_anomaly": f"case when {_avg(SO_FAR)} > 0 and {AMOUNT} / ({_avg(SO_FAR)}) > 5 "
    "then 1 else 0 end",
    "is_spending_spike": f"case when {AMOUNT} > ({_avg(TEN)}) * 3 then 1 else 0 end",
    "historical_stddev": sql_rnd(f"stddev_samp({AMOUNT}) over ({THIRTY})"),
    "is_volatility_spike": f"case when {AMOUNT} > stddev_samp({AMOUNT}) over ({THIRTY}) * 3 "
    "then 1 else 0 end",
    "transaction_rank_history": f"row_number() over ({ROWS})",
    "action_rank": f"row_number() over ({ROWS})",
    "is_first_action": f"case when row_number() over ({ROWS}) = 1 then 1 else 0 end",
    "account_activity": f"case when row_number() over ({ROWS}) <= 5 then 'New Account' "
    "else 'Established Account' end",
    "cumulative_integrity_passes": f"cast(sum(math_ok) over ({STEPS}) as bigint)",
    "cumulative_integrity_failures": f"cast(sum(1 - math_ok) over ({STEPS}) as bigint)",
    "account_audit_status": f"case when sum(1 - math_ok) over ({STEPS}) > 2 "
    "then 'Flagged for Audit' else 'Clean' end",
}
MONEY = ("prev_amount", "amount_diff", "running_total_outflow", "cumulative_outflow")
ROUNDED = (
    "pct_of_total_outflow",
    "historical_avg_amount",
    "avg_historical_amount",
    "avg_last_10_txns",
    "behavioral_spike_ratio",
    "historical_stddev",
)
COUNTS = ("transaction_rank_history", "action_rank", "txns_last_24h")


def feature_sql(names) -> str:
    return "select txn_id, " + ", ".join(f"{FEATURE_SQL[c]} as {c}" for c in names) + " from n"


def shown(names):
    """The columns as they go out."""
    out = []
    for c in names:
        if c in MONEY:
            out.append(dbl(c).alias(c))
        elif c in ROUNDED:
            out.append(rnd(c).alias(c))
        elif c in COUNTS:
            out.append(big(c).alias(c))
        else:
            out.append(F.col(c))
    return out


def _behavior_query(name: str, groups: list[str], columns: list[str], **options) -> None:
    @register(name, feature_sql(columns))
    def query(spark, d):
        return w.behavior(masked(spark, d), groups, **options).select("txn_id", *shown(columns))


_behavior_query(
    "win_lag",
    ["history"],
    ["prev_step", "prev_amount", "hours_since_last_txn", "time_since_last_txn"],
)
_behavior_query("win_amount_diff", ["history"], ["amount_diff"])
_behavior_query("win_velocity", ["velocity"], ["txns_last_24h", "txn_velocity_level"])
_behavior_query("win_running_total", ["outflow"], ["running_total_outflow"])
_behavior_query("win_cumulative", ["outflow"], ["cumulative_outflow"])
_behavior_query("win_outflow_pct", ["outflow"], ["drainage_ratio", "pct_of_total_outflow"])
_behavior_query(
    "win_hist_avg", ["average"], ["historical_avg_amount", "avg_historical_amount"]
)
_behavior_query("win_avg_last10", ["recent"], ["avg_last_10_txns"])
_behavior_query(
    "win_spike",
    ["average"],
    ["behavioral_spike_ratio", "behavioral_anomaly", "is_behavioral_anomaly"],
)
_behavior_query("win_spending_spike", ["recent"], ["avg_last_10_txns", "is_spending_spike"])
_behavior_query("win_volatility", ["volatility"], ["historical_stddev", "is_volatility_spike"])
_behavior_query(
    "win_sequence",
    ["sequence"],
    ["transaction_rank_history", "action_rank", "is_first_action", "account_activity"],
)
_behavior_query(
    "win_integrity",
    ["integrity"],
    ["cumulative_integrity_passes", "cumulative_integrity_failures", "account_audit_status"],
)
_behavior_query("win_behavior", list(w.FEATURES), list(FEATURE_SQL))
_behavior_query("win_behavior_split", list(w.FEATURES), list(FEATURE_SQL), hot_rows=SPLIT_ROWS)


@register(
    "win_rank_type",
    """select txn_id, type, rank() over (partition by type order by amount desc nulls last)
      as rank_in_type from n""",
)
def win_rank_type(spark, d):
    return w.rank_in_type(normal(spark, d)).select(
        "txn_id", "type", big("rank_in_type").alias("rank_in_type")
    )


PAIR = "row_number() over (partition by acct, dest order by step, txn_id)"


@register(
    "win_dest_pair",
    f"""select txn_id, {PAIR} as dest_appearance_rank,
      case when {PAIR} = 1 then 1 else 0 end as is_new_destination_for_sender from n""",
)
def win_dest_pair(spark, d):
    return w.dest_novelty(masked(spark, d)).select(
        "txn_id",
        big("dest_appearance_rank").alias("dest_appearance_rank"),
        "is_new_destination_for_sender",
    )


FIRST = "row_number() over (partition by dest order by step, txn_id)"


def _dest_first(name: str, **options) -> None:
    @register(
        name,
        f"""select txn_id, {FIRST} as destination_rank,
          case when {FIRST} = 1 then 1 else 0 end as is_first_seen_destination from n""",
    )
    def query(spark, d):
        return w.dest_novelty(masked(spark, d), **options).select(
            "txn_id", big("destination_rank").alias("destination_rank"), "is_first_seen_destination"
        )


_dest_first("win_dest_first")
_dest_first("win_dest_first_split", hot_rows=SPLIT_ROWS)

# -- by timestamp -------------------------------------------------------------------

TIMED = BASE + f""", ts as (select t.txn_id, {ACCT} as acct, e.ts
    from t join events e on e.event_id = t.txn_id)
"""
BY_TS = "partition by acct order by ts, txn_id"


def timed(spark, d):
    return mask(timed_transactions(spark, d).select("txn_id", "nameOrig", "ts"), SALT, ["nameOrig"])


@register(
    "win_account_age",
    TIMED + """select txn_id, cast(date_diff('day', cast(f as date), cast(ts as date)) as int)
        as account_age_days,
      case when date_diff('day', cast(f as date), cast(ts as date)) <= 14 then 1 else 0 end
        as is_infant_account_risk
    from (select txn_id, ts, min(ts) over (partition by acct) as f from ts) q""",
)
def win_account_age(spark, d):
    return w.account_age(timed(spark, d)).select(
        "txn_id", "account_age_days", "is_infant_account_risk"
    )


@register(
    "win_day_gap",
    TIMED + """select txn_id, cast(date_diff('day', cast(p as date), cast(ts as date)) as int)
        as days_since_last_txn,
      case when date_diff('day', cast(p as date), cast(ts as date)) = 0 then 'High Velocity'
        else 'Normal' end as velocity_flag
    from (select txn_id, ts, lag(ts) over (""" + BY_TS + """) as p from ts) q""",
)
def win_day_gap(spark, d):
    return w.day_gap(timed(spark, d)).select("txn_id", "days_since_last_txn", "velocity_flag")


def _sessions(name: str, **options) -> None:
    @register(
        name,
        TIMED + f""", g as (
          select txn_id, acct, ts,
            date_diff('microsecond', lag(ts) over ({BY_TS}), ts) / 60000000.0 as gap from ts)
        select txn_id, case when gap > 60 then 1 else 0 end as new_session_flag,
          cast(sum(case when gap > 60 then 1 else 0 end)
            over ({BY_TS} rows between unbounded preceding and current row) as bigint)
            as session_id from g""",
    )
    def query(spark, d):
        return w.sessionize(timed(spark, d), **options).select(
            "txn_id", "new_session_flag", "session_id"
        )


_sessions("win_sessions")
_sessions("win_sessions_split", hot_rows=SPLIT_ROWS)


@register(
    "win_latest",
    """select acct as account_hash, txn_id, step, cast(amount as double) as amount from (
      select *, row_number() over (partition by acct order by step desc, txn_id desc) as rn
      from n where acct is not null) q where rn = 1""",
)
def win_latest(spark, d):
    known = masked(spark, d).filter(F.col("nameOrig_hashed").isNotNull())
    return w.latest(known, ["nameOrig_hashed"], ["step", "txn_id"]).select(
        F.col("nameOrig_hashed").alias("account_hash"),
        "txn_id",
        "step",
        dbl("amount").alias("amount"),
    )


# -- scores ------------------------------------------------------------------------

EMPTIED = "case when amount > 100000 and newbalanceOrig = 0 then 1 else 0 end"


@register(
    "risk_total",
    f"""select txn_id, {EMPTIED} * 40 + anomaly * 30
        + case when type = 'TRANSFER' and amount > 200000 then 20 else 0 end
        + case when amount % 100 = 0 then 10 else 0 end as total_risk_score
    from (select *, {FEATURE_SQL["is_behavioral_anomaly"]} as anomaly from n) q""",
)
def risk_total(spark, d):
    df = w.behavior(masked(spark, d), ["average"])
    df = labels.label_number(labels.label_risk(df))
    return labels.risk_weights(df).select("txn_id", "total_risk_score")


@register(
    "risk_cumulative",
    f"""select txn_id, spike * 30 + case when rn <= 5 then 20 else 0 end + {EMPTIED} * 50
        as cumulative_risk_index
    from (select *, {FEATURE_SQL["is_spending_spike"]} as spike,
      row_number() over ({ROWS}) as rn from n) q""",
)
def risk_cumulative(spark, d):
    df = w.behavior(masked(spark, d), ["recent", "sequence"])
    return labels.risk_index(df).select("txn_id", "cumulative_risk_index")


@register(
    "dq_score_bounds",
    f"""select txn_id, case when score > 50 then 1 else 0 end as risk_score_out_of_bounds from (
      select txn_id, {EMPTIED} * 40 + anomaly * 30
        + case when type = 'TRANSFER' and amount > 200000 then 20 else 0 end
        + case when amount % 100 = 0 then 10 else 0 end as score
      from (select *, {FEATURE_SQL["is_behavioral_anomaly"]} as anomaly from n) q) r""",
)
def dq_score_bounds(spark, d):
    df = w.behavior(masked(spark, d), ["average"])
    df = labels.risk_weights(labels.label_number(labels.label_risk(df)))
    # no score exceeds 100, so a lower bound shows the flag at work
    return quality.score_bounds(df, hi=50).select("txn_id", "risk_score_out_of_bounds")
