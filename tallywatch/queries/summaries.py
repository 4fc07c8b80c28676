"""Stored sketches: quantiles and distinct counts of any range of days."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallywatch.operators import summaries
from tallywatch.queries.base import SPLIT_STEP, big, register
from tallywatch.queries.rows import masked
from tallywatch.session import scratch_dir
from tallywatch.sources import store

SHARES = (0.05, 0.25, 0.5, 0.75, 0.95)


def _stored(spark, df, label):
    path = scratch_dir(spark, label)
    store.write_table(df, path)
    return store.read_table(spark, path)


def _with_day(spark, d):
    return masked(spark, d).withColumn("day", F.floor((F.col("step") - 1) / 24).cast("int"))


@register(
    "agg_quantiles",
    f""" select type, share, count(amount) as amounts, true as within_bound
    from n, (select unnest([{", ".join(map(str, SHARES))}]::double[]) as share)
    where amount is not null group by type, share""",
)
def agg_quantiles(spark, d):
    """Quantiles from sketches by type and day, and whether their ranks keep the bound."""
    df = _with_day(spark, d)
    sketches = summaries.quantile_sketches(df, ["type", "day"], F.col("amount"))
    found = summaries.merged_quantiles(_stored(spark, sketches, "quantiles"), ["type"], SHARES)
    amount = F.col("amount").cast("double")
    ranked = df.filter("amount is not null").join(F.broadcast(found), "type")  # types by shares
    ranks = ranked.groupBy("type", "share").agg(
        F.count("*").alias("amounts"),
        F.avg((amount < F.col("value")).cast("int")).alias("below"),
        F.avg((amount <= F.col("value")).cast("int")).alias("upto"),
    )
    bound = F.lit(summaries.RANK_ERROR)
    within = (F.col("below") <= F.col("share") + bound) & (F.col("upto") >= F.col("share") - bound)
    return ranks.select("type", "share", big("amounts").alias("amounts"), within.alias("within_bound"))


_EARLY, _LATE = f"step <= {SPLIT_STEP}", f"step > {SPLIT_STEP}"


@register(
    "agg_distinct_dest",
    f""" , a as (select acct, dest, bool_or({_EARLY}) as early, bool_or({_LATE}) as late
      from n where dest is not null group by acct, dest)
    select acct as account, count(*) filter (where early) as in_first, count(*) filter (where late) as in_second,
      count(*) filter (where early and late) as in_both, count(*) as in_either,
      count(*) filter (where early and not late) as only_first
    from a group by acct""",
)
def agg_distinct_dest(spark, d):
    """Destinations of each account in the first and second half, from daily sketches."""
    daily = summaries.distinct_sketches(_with_day(spark, d), ["nameOrig_hashed", "day"], "nameDest_hashed")
    stored = _stored(spark, daily, "destinations")
    first = F.col("day") * 24 < SPLIT_STEP
    out = summaries.compared_sets(stored, ["nameOrig_hashed"], first, ~first)
    return out.withColumnRenamed("nameOrig_hashed", "account")
