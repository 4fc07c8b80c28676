"""Sketches kept as columns of a table, merged for any range when asked.

``quantile_sketches``: one per group, from which quantiles of any union of groups follow
with a bounded error in rank. ``distinct_sketches``: sets per group, whose unions,
intersections and differences can be counted; exact as long as a set has fewer members
than the sketch keeps. Both are plain columns, so they are stored, read and merged by
map-side aggregation like any sum, and rows are read once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

K = 400  # size of a quantile sketch: some 10 KB
RANK_ERROR = 0.02  # of a quantile's rank in its group, of any merged groups; K keeps well below
LG_ENTRIES = 12  # a distinct sketch keeps 4,096 members


def quantile_sketches(df: DataFrame, groups: Sequence[str], value: Column, k: int = K) -> DataFrame:
    """``groups``, ``quantiles``: the sketch of ``value`` (as double) in each group.

    Null values are left out; a group of nulls only has an empty sketch or null.
    """
    return df.groupBy(*groups).agg(F.kll_sketch_agg_double(value.cast("double"), k).alias("quantiles"))


def merged_quantiles(stored: DataFrame, groups: Sequence[str], shares: Sequence[float]) -> DataFrame:
    """``groups``, ``share``, ``value``: quantiles over all stored rows of each group.

    The rank of ``value`` in the group differs from ``share`` by ``RANK_ERROR`` at most,
    whatever the order of merging; ends of the range (0 and 1) are exact. Groups without
    a value are left out.
    """
    merged = stored.filter("quantiles is not null").groupBy(*groups)
    merged = merged.agg(F.kll_merge_agg_double("quantiles").alias("__all"))
    merged = merged.filter(F.kll_sketch_get_n_double("__all") > 0)
    at = [
        F.struct(F.lit(float(s)).alias("share"), F.kll_sketch_get_quantile_double("__all", F.lit(float(s))).alias("value"))
        for s in shares
    ]
    return merged.select(*groups, F.inline(F.array(*at)))


def distinct_sketches(
    df: DataFrame, groups: Sequence[str], member: str, lg_entries: int = LG_ENTRIES
) -> DataFrame:
    """``groups``, ``members``: the sketch of the distinct ``member`` of each group; nulls are no members."""
    return df.groupBy(*groups).agg(F.theta_sketch_agg(member, lg_entries).alias("members"))


def compared_sets(
    stored: DataFrame, groups: Sequence[str], first: Column, second: Column, lg_entries: int = LG_ENTRIES
) -> DataFrame:
    """Distinct members of two ranges of stored rows, and how they overlap.

    ``first`` and ``second`` say which rows belong to each range. Returns ``groups``,
    ``in_first``, ``in_second``, ``in_both``, ``in_either`` and ``only_first``. Counts are
    exact below ``2 ** lg_entries`` members, else estimates. A group with rows in neither
    range has zeros.
    """

    def united(which: Column) -> Column:
        return F.theta_union_agg(F.when(which, F.col("members")), lg_entries)

    both = stored.groupBy(*groups).agg(united(first).alias("__a"), united(second).alias("__b"))
    counted = {
        "in_first": F.col("__a"),
        "in_second": F.col("__b"),
        "in_both": F.theta_intersection("__a", "__b"),
        "in_either": F.theta_union("__a", "__b", lg_entries),
        "only_first": F.theta_difference("__a", "__b"),
    }
    sizes = (F.theta_sketch_estimate(c).cast("long").alias(n) for n, c in counted.items())
    return both.select(*groups, *sizes)
