"""Interval and as-of joins, sequence patterns, grouping sets.

The ``*_split`` queries run the same operators with a limit so low that most accounts
are hot; they answer to the same SQL.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tallywatch.operators import cubes, intervals, patterns
from tallywatch.operators.spread import HOT_ROWS, Frames, framed
from tallywatch.queries.base import BASE, ORACLES, big, dbl, register
from tallywatch.queries.rows import masked

SPLIT_ROWS = 20
WITHIN = 24  # steps

# a transfer opens a watch on its account: a day, ten days for a large one, for good if fraud
WATCHES = """
w as (
  select txn_id as watch_id, acct, step + 1 as opens,
    case when isFraud = 1 then null when amount > 400000 then step + 1 + 240 else step + 1 + 24 end as closes
  from n where type = 'TRANSFER')
"""


def _watches(df):
    closes = F.when(F.col("isFraud"), None)
    closes = closes.when(F.col("amount") > 400000, F.col("step") + 1 + 240).otherwise(F.col("step") + 1 + 24)
    return df.filter("type = 'TRANSFER'").select(
        F.col("txn_id").alias("watch_id"),
        "nameOrig_hashed",
        (F.col("step") + 1).alias("opens"),
        closes.cast("int").alias("closes"),
    )


def _interval_query(name: str, hot_rows: int) -> None:
    @register(
        name,
        f""", {WATCHES} select n.txn_id, w.watch_id from n left join w
          on n.acct = w.acct and n.step >= w.opens and (w.closes is null or n.step < w.closes)""",
    )
    def query(spark, d):
        df = masked(spark, d)
        points = df.select("txn_id", "nameOrig_hashed", "step")
        found = intervals.interval_join(
            points,
            _watches(df),
            "step",
            "opens",
            "closes",
            ["nameOrig_hashed"],
            how="left",
            tie="txn_id",
            hot_rows=hot_rows,
        )
        return found.select("txn_id", "watch_id")


_interval_query("join_interval", HOT_ROWS)
_interval_query("join_interval_split", SPLIT_ROWS)


@register(
    "join_interval_open",
    f""", {WATCHES}, p as (select distinct step from n)
      select p.step, count(*) as open_watches from p join w
      on p.step >= w.opens and (w.closes is null or p.step < w.closes) group by p.step""",
)
def join_interval_open(spark, d):
    df = masked(spark, d)
    steps = df.select("step").distinct()
    watches = _watches(df).drop("nameOrig_hashed")
    found = intervals.interval_join(steps, watches, "step", "opens", "closes")
    return found.groupBy("step").agg(F.count("*").alias("open_watches"))


def _asof_query(name: str, hot_rows: int) -> None:
    @register(
        name,
        f""", c as (select * from n where type = 'CASH_OUT'), r as (select * from n where type = 'TRANSFER'),
        b as (
          select c.txn_id, c.step, r.txn_id as transfer_id, r.step as transfer_step
          from c left join r on c.acct = r.acct and r.step <= c.step
          qualify row_number() over (partition by c.txn_id order by r.step desc nulls last, r.txn_id desc) = 1)
        select txn_id, case when step - transfer_step <= {WITHIN} then transfer_id end as transfer_id,
          case when step - transfer_step <= {WITHIN} then transfer_step end as transfer_step from b""",
    )
    def query(spark, d):
        df = masked(spark, d).select("txn_id", "nameOrig_hashed", "step", "type")
        found = intervals.asof_join(
            df.filter("type = 'CASH_OUT'"),
            df.filter("type = 'TRANSFER'").select(
                "nameOrig_hashed", F.col("txn_id").alias("transfer_id"), F.col("step").alias("transfer_step")
            ),
            "step",
            "transfer_step",
            "txn_id",
            "transfer_id",
            ["nameOrig_hashed"],
            tolerance=WITHIN,
            hot_rows=hot_rows,
        )
        return found.select("txn_id", "transfer_id", "transfer_step")


_asof_query("join_asof", HOT_ROWS)
_asof_query("join_asof_split", SPLIT_ROWS)


# -- transfer, then cash-out within a day, twice ----------------------------------------------

_PATTERN_SQL = (
    BASE.replace("with t as", "with recursive t as", 1)
    + f""", o as (
      select txn_id, acct, step, type, last_value(case when type = 'TRANSFER' then step end ignore nulls)
        over (partition by acct order by step, txn_id rows unbounded preceding) as since
      from n where acct is not null),
    y as (
      select *, row_number() over (partition by acct order by step, txn_id) as k,
        case when type = 'TRANSFER' then 0 when type = 'CASH_OUT' and step - since <= {WITHIN} then 1 end as symbol
      from o where type = 'TRANSFER' or (type = 'CASH_OUT' and step - since <= {WITHIN})),
    r as (
      select acct, cast(0 as bigint) as k, 0 as state, cast(null as bigint) as txn_id, cast(null as int) as step
      from (select distinct acct from y)
      union all
      select y.acct, y.k, case when symbol = r.state % 2 then r.state % 4 + 1 else r.state % 4 end, y.txn_id, y.step
      from r join y on y.acct = r.acct and y.k = r.k + 1)
    select txn_id, step from r where state = 4"""
)


def _pattern_query(name: str, hot_rows: int) -> None:
    def query(spark, d):
        df = masked(spark, d).select("txn_id", "nameOrig_hashed", "step", "type")
        transfer = F.col("type") == "TRANSFER"
        since = Frames(carried={"since": F.when(transfer, F.col("step"))})
        df = framed(df, ["nameOrig_hashed"], "step", "txn_id", since, hot_rows)
        soon = (F.col("type") == "CASH_OUT") & (F.col("step") - F.col("since") <= WITHIN)
        symbol = F.when(transfer, 0).when(soon, 1)
        twice = patterns.in_sequence([0, 1, 0, 1], 2)
        ends = patterns.match_ends(df, ["nameOrig_hashed"], "step", "txn_id", symbol, twice, hot_rows)
        return ends.select("txn_id", "step")

    register(name)(query)
    ORACLES[name] = _PATTERN_SQL


_pattern_query("pattern_match", HOT_ROWS)
_pattern_query("pattern_match_split", SPLIT_ROWS)


# -- the daily fraud mart at every level ---------------------------------------------------------

_DAY = "(step - 1) // 24"


@register(
    "agg_cube",
    f""" select day, type, is_fraud, grouping_id(day, type, is_fraud) as grouping_id,
      cast(sum(amount) as double) as total_amount, count(amount) as amounts,
      cast(max(amount) as double) as largest,
      cast(sum(amount) as double) / nullif(count(amount), 0) as mean_amount
    from (select {_DAY} as day, type, isFraud as is_fraud, amount from n)
    group by cube (day, type, is_fraud)""",
)
def agg_cube(spark, d):
    return _by_day(spark, d, None)


@register(
    "agg_rollup",
    f""" select day, type, is_fraud, grouping_id(day, type, is_fraud) as grouping_id,
      cast(sum(amount) as double) as total_amount, count(amount) as amounts,
      cast(max(amount) as double) as largest,
      cast(sum(amount) as double) / nullif(count(amount), 0) as mean_amount
    from (select {_DAY} as day, type, isFraud as is_fraud, amount from n)
    group by rollup (day, type, is_fraud)""",
)
def agg_rollup(spark, d):
    return _by_day(spark, d, cubes.rollup_sets(["day", "type", "is_fraud"]))


def _by_day(spark, d, sets):
    df = masked(spark, d).select(
        F.floor((F.col("step") - 1) / 24).cast("int").alias("day"),
        "type",
        F.col("isFraud").cast("int").alias("is_fraud"),
        "amount",
    )
    measures = {
        "total_amount": ("sum", F.col("amount")),
        "amounts": ("count", F.col("amount")),
        "largest": ("max", F.col("amount")),
        "mean_amount": ("avg", F.col("amount")),
    }
    out = cubes.grouping_sets(df, ["day", "type", "is_fraud"], measures, sets)
    return out.select(
        "day",
        "type",
        "is_fraud",
        big("grouping_id").alias("grouping_id"),
        dbl("total_amount").alias("total_amount"),
        big("amounts").alias("amounts"),
        dbl("largest").alias("largest"),
        "mean_amount",
    )


@register(
    "v_pivot",
    " select type, "
    + ", ".join(f"cast(sum(amount) filter (where {_DAY} % 7 = {k}) as double) as day_{k}" for k in range(7))
    + ", cast(null as double) as missing from n group by type",
)
def v_pivot(spark, d):
    """Volume by type and day of the week."""
    df = masked(spark, d)
    day = F.concat(F.lit("day_"), (F.floor((F.col("step") - 1) / 24) % 7).cast("string"))
    out = cubes.pivoted(df.withColumn("weekday", day), ["type"], "weekday", F.col("amount"))
    return out.select("type", *(dbl(c).alias(c) for c in out.columns[1:]))
