"""Behavioural features per account.

``behavior`` computes any set of feature groups in one pass: they share the
partitioning by account and the sort by (step, unique id), so the plan has one
exchange however many groups are asked for. The named functions are the same
call with one group. See ``spread`` for accounts of any size.

Rows without an account form a group of their own, as in SQL.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywatch import rules
from tallywatch.functions.exprs import flag, mean, ratio
from tallywatch.functions.ledger import math_correct
from tallywatch.operators.spread import HOT_ROWS, Frames, framed, hot_keys, position, rank_within
from tallywatch.session import pinned

ACCOUNT, STEP, TIE = "nameOrig_hashed", "step", "txn_id"


def _rows_back(value: Callable[[], Column], first: int) -> Callable:
    return lambda w: value().over(w.rowsBetween(-first, -1))


def _has_amount() -> Column:
    return F.col("amount").isNotNull().cast("int")


# What each feature group needs from the window pass.
_LOOKBACK = {
    "history": {
        "prev_step": lambda w: F.lag("step").over(w),
        "prev_amount": lambda w: F.lag("amount").over(w),
    },
    "recent": {
        "__recent_sum": _rows_back(lambda: F.sum("amount"), rules.RECENT_ROWS),
        "__recent_n": _rows_back(lambda: F.count("amount"), rules.RECENT_ROWS),
    },
    "volatility": {
        "historical_stddev": _rows_back(lambda: F.stddev("amount"), rules.VOLATILITY_ROWS),
    },
}
_REACH = {"history": 1, "recent": rules.RECENT_ROWS, "volatility": rules.VOLATILITY_ROWS}
_RUNNING = {
    "outflow": {"cumulative_outflow": lambda: F.col("amount")},
    "average": {
        "cumulative_outflow": lambda: F.col("amount"),
        "__seen": _has_amount,
    },
}
_RANGED = {
    "velocity": {"txns_last_24h": (_has_amount, rules.VELOCITY_STEPS - 1)},
    "outflow": {"running_total_outflow": (lambda: F.col("amount"), None)},
    "average": {
        "running_total_outflow": (lambda: F.col("amount"), None),
        "__seen_by_step": (_has_amount, None),
    },
    "integrity": {
        "cumulative_integrity_passes": (math_correct, None),
        "cumulative_integrity_failures": (lambda: 1 - math_correct(), None),
    },
}


def _history(df: DataFrame) -> DataFrame:
    gap = F.col("step") - F.col("prev_step")
    change = F.col("amount") - F.coalesce("prev_amount", F.lit(0))
    return df.withColumns(
        {
            "hours_since_last_txn": gap,
            "time_since_last_txn": gap,
            "amount_diff": F.coalesce(change, F.lit(0)),
        }
    )


def _velocity(df: DataFrame) -> DataFrame:
    fast = F.col("txns_last_24h") > rules.VELOCITY_LIMIT
    level = F.when(fast, rules.VELOCITY_HIGH).otherwise(rules.VELOCITY_NORMAL)
    return df.withColumn("txn_velocity_level", level)


def _outflow(df: DataFrame) -> DataFrame:
    def percent(total: str) -> Column:
        return ratio(F.col("amount"), F.col(total)) * 100

    return df.withColumns(
        {
            "drainage_ratio": F.round(percent("running_total_outflow"), 2),
            "pct_of_total_outflow": percent("cumulative_outflow"),
        }
    )


def _average(df: DataFrame) -> DataFrame:
    """Averages so far by rows and by step, and the ratio of the amount to the former."""
    by_rows = mean(F.col("cumulative_outflow"), F.col("__seen"))
    by_step = mean(F.col("running_total_outflow"), F.col("__seen_by_step"))
    df = df.withColumns({"historical_avg_amount": by_rows, "avg_historical_amount": by_step})
    usual = F.col("historical_avg_amount")
    df = df.withColumn(
        "behavioral_spike_ratio",
        F.when(usual > 0, ratio(F.col("amount"), usual)).otherwise(1.0),
    )
    odd = F.col("behavioral_spike_ratio") > rules.ANOMALY_FACTOR
    return df.withColumns(
        {
            "behavioral_anomaly": F.when(odd, rules.ANOMALY).otherwise(rules.NO_ANOMALY),
            "is_behavioral_anomaly": flag(odd),
        }
    )


def _recent(df: DataFrame) -> DataFrame:
    average = mean(F.col("__recent_sum"), F.col("__recent_n"))
    spike = F.col("amount") > F.col("avg_last_10_txns") * rules.SPIKE_FACTOR
    return df.withColumn("avg_last_10_txns", average).withColumn("is_spending_spike", flag(spike))


def _volatility(df: DataFrame) -> DataFrame:
    limit = F.col("historical_stddev") * rules.VOLATILITY_FACTOR
    return df.withColumn("is_volatility_spike", flag(F.col("amount") > limit))


def _sequence(df: DataFrame) -> DataFrame:
    rank = F.col("transaction_rank_history")
    young = rank <= rules.NEW_ACCOUNT_ROWS
    return df.withColumns(
        {
            "action_rank": rank,
            "is_first_action": flag(rank == 1),
            "account_activity": F.when(young, rules.NEW_ACCOUNT).otherwise(rules.OLD_ACCOUNT),
        }
    )


def _integrity(df: DataFrame) -> DataFrame:
    flagged = F.col("cumulative_integrity_failures") > rules.AUDIT_LIMIT
    status = F.when(flagged, rules.AUDIT_FLAGGED).otherwise(rules.AUDIT_CLEAN)
    return df.withColumn("account_audit_status", status)


_DERIVED = {
    "history": _history,
    "velocity": _velocity,
    "outflow": _outflow,
    "average": _average,
    "recent": _recent,
    "volatility": _volatility,
    "sequence": _sequence,
    "integrity": _integrity,
}
FEATURES = tuple(_DERIVED)


def behavior(
    df: DataFrame,
    features: Sequence[str] = FEATURES,
    *,
    account: str = ACCOUNT,
    order: str = STEP,
    tie: str = TIE,
    hours: int = rules.VELOCITY_STEPS,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Add the columns of the given feature groups.

    ``tie`` must be unique: it decides the order of rows on the same step in
    every row-based frame. Only amount, balances, step and keys are read, so call
    it before adding labels: the exchange then carries fewer columns.
    """
    unknown = set(features) - set(FEATURES)
    if unknown:
        raise ValueError(f"unknown features: {sorted(unknown)}")
    frames = Frames(
        lookback={n: f for g in features for n, f in _LOOKBACK.get(g, {}).items()},
        reach=max((_REACH.get(g, 0) for g in features), default=0),
        running={n: v() for g in features for n, v in _RUNNING.get(g, {}).items()},
        ranged={n: (v(), b) for g in features for n, (v, b) in _RANGED.get(g, {}).items()},
        position="transaction_rank_history" if "sequence" in features else None,
    )
    if "txns_last_24h" in frames.ranged:
        frames.ranged["txns_last_24h"] = (_has_amount(), hours - 1)
    out = framed(df, [account], order, tie, frames, hot_rows)
    for group in features:
        out = _DERIVED[group](out)
    return out.drop("__recent_sum", "__recent_n", "__seen", "__seen_by_step")


def history(df: DataFrame, **options) -> DataFrame:
    """Previous step and amount, step gap, change of amount."""
    return behavior(df, ["history"], **options)


def velocity(df: DataFrame, **options) -> DataFrame:
    """Transactions with an amount in the last ``hours`` steps, and the level."""
    return behavior(df, ["velocity"], **options)


def outflow(df: DataFrame, **options) -> DataFrame:
    """Running and cumulative outflow and the share of this transaction."""
    return behavior(df, ["outflow"], **options)


def history_avg(df: DataFrame, **options) -> DataFrame:
    """Average so far (by rows and by step) and of the previous ten rows."""
    return behavior(df, ["average", "recent"], **options)


def spike(df: DataFrame, **options) -> DataFrame:
    """Ratio to the average so far, anomaly flag, spending spike."""
    return behavior(df, ["average", "recent"], **options)


def volatility(df: DataFrame, **options) -> DataFrame:
    """Standard deviation of the previous thirty rows and the volatility spike."""
    return behavior(df, ["volatility"], **options)


def sequence(df: DataFrame, **options) -> DataFrame:
    """Row number per account, first action, new or established account."""
    return behavior(df, ["sequence"], **options)


def integrity_history(df: DataFrame, **options) -> DataFrame:
    """Running count of ledger passes and failures and the audit status.

    The status follows the failures.
    """
    return behavior(df, ["integrity"], **options)


def rank_in_type(df: DataFrame, by: str = "type", pieces: int | None = None) -> DataFrame:
    """Rank of the amount within its type, largest first, gaps after ties."""
    return rank_within(df, by, "amount", "rank_in_type", pieces)


def dest_novelty(
    df: DataFrame,
    *,
    account: str = ACCOUNT,
    dest: str = "nameDest_hashed",
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """First time a sender pays a destination, and first time it is paid at all."""
    # a pair has at most as many rows as its destination: count pairs only if needed
    pair = [account, dest]
    some_hot = hot_rows is not None and hot_keys(df, [dest], TIE, hot_rows) is not None
    pairs_hot = some_hot and hot_keys(df, pair, TIE, hot_rows) is not None
    columns = [*df.columns, "dest_appearance_rank", "destination_rank"]
    # destinations first: pairs are seldom hot, and what comes first is computed from plain rows
    df = position(df, [dest], STEP, TIE, "destination_rank", hot_rows if some_hot else None)
    if pairs_hot:
        df = pinned(df, "destinations")
    df = position(df, pair, STEP, TIE, "dest_appearance_rank", hot_rows if pairs_hot else None)
    df = df.select(*columns)
    return df.withColumns(
        {
            "is_new_destination_for_sender": flag(F.col("dest_appearance_rank") == 1),
            "is_first_seen_destination": flag(F.col("destination_rank") == 1),
        }
    )


def account_age(
    df: DataFrame, *, account: str = ACCOUNT, ts: str = "ts", hot_rows: int | None = HOT_ROWS
) -> DataFrame:
    """Days since the account's first activity and the infant-account flag."""
    frames = Frames(whole={"first_account_activity": F.min(ts)})
    out = framed(df, [account], ts, TIE, frames, hot_rows)
    age = F.datediff(F.to_date(ts), F.to_date("first_account_activity"))
    return out.withColumn("account_age_days", age).withColumn(
        "is_infant_account_risk", flag(F.col("account_age_days") <= rules.INFANT_DAYS)
    )


def day_gap(
    df: DataFrame, *, account: str = ACCOUNT, ts: str = "ts", hot_rows: int | None = HOT_ROWS
) -> DataFrame:
    """Days since the account's previous transaction and the same-day flag."""
    frames = Frames(lookback={"prev_ts": lambda w: F.lag(ts).over(w)}, reach=1)
    out = framed(df, [account], ts, TIE, frames, hot_rows)
    days = F.datediff(F.to_date(ts), F.to_date("prev_ts"))
    same_day = F.col("days_since_last_txn") == 0
    return out.withColumn("days_since_last_txn", days).withColumn(
        "velocity_flag", F.when(same_day, rules.VELOCITY_HIGH).otherwise(rules.VELOCITY_NORMAL)
    )


def sessionize(
    df: DataFrame,
    *,
    account: str = ACCOUNT,
    ts: str = "ts",
    gap_min: int = rules.SESSION_MINUTES,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Session number per account; a gap of more than ``gap_min`` starts the next."""
    gap = F.timestamp_diff("MICROSECOND", F.col("__prev_ts"), F.col(ts)) / 60_000_000
    frames = Frames(
        lookback={"__prev_ts": lambda w: F.lag(ts).over(w)},
        reach=1,
        running_after={"session_id": flag(gap > gap_min)},
    )
    out = framed(df, [account], ts, TIE, frames, hot_rows)
    return out.withColumns(
        {"time_diff_minutes": gap, "new_session_flag": flag(gap > gap_min)}
    ).drop("__prev_ts")


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the largest ``order`` values per key (nulls smallest).

    End ``order`` in a unique column. Spark keeps one row per key and task
    before the shuffle, so a hot key sends one row per task.
    """
    by = [F.col(c).desc_nulls_last() for c in order]
    newest = F.row_number().over(Window.partitionBy(*keys).orderBy(*by))
    return df.withColumn("__rn", newest).filter(F.col("__rn") == 1).drop("__rn")
