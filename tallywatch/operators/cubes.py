"""Grouping sets from one pass: the finest level is aggregated once, the others from it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("sum", "count", "min", "max", "avg")


def cube_sets(dims: Sequence[str]) -> list[tuple[str, ...]]:
    """All subsets."""
    return [c for n in range(len(dims), -1, -1) for c in combinations(dims, n)]


def rollup_sets(dims: Sequence[str]) -> list[tuple[str, ...]]:
    """The leading columns: all, all but the last, ... none."""
    return [tuple(dims[:n]) for n in range(len(dims), -1, -1)]


def grouping_sets(
    df: DataFrame,
    dims: Sequence[str],
    measures: Mapping[str, tuple[str, Column]],
    sets: Sequence[Sequence[str]] | None = None,
    level: str = "grouping_id",
) -> DataFrame:
    """``dims``, ``level`` and ``measures`` for every set of columns in ``sets``.

    ``measures``: name -> (kind, value), kind one of sum, count (of values that are not
    null), min, max and avg. ``sets`` is all subsets unless given (``rollup_sets`` gives
    the leading ones). A column left out of a set is null; as it may be null itself,
    ``level`` tells them apart: one bit a column, the first highest, 1 for left out.

    Rows of ``df`` are read and shuffled once, for the finest level. Coarser levels add
    up its partial results; an average is its sum over its count there too. An empty
    table has no groups, so it gives no rows, not even for the empty set.
    """
    dims = list(dims)
    sets = cube_sets(dims) if sets is None else [tuple(s) for s in sets]
    unknown = {kind for kind, _ in measures.values()} - set(KINDS)
    if unknown:
        raise ValueError(f"measures are of {KINDS}, not {sorted(unknown)}")
    if stray := {c for s in sets for c in s} - set(dims):
        raise ValueError(f"sets name columns that are no dims: {sorted(stray)}")
    first: dict[str, Column] = {}
    again: dict[str, Column] = {}
    out: list[Column] = []
    for name, (kind, value) in measures.items():
        if kind in ("sum", "avg"):
            first[f"{name}__sum"] = F.sum(value)
            again[f"{name}__sum"] = F.sum(f"{name}__sum")
        if kind in ("count", "avg"):
            first[f"{name}__n"] = F.count(value)
            again[f"{name}__n"] = F.coalesce(F.sum(f"{name}__n"), F.lit(0))
        if kind in ("min", "max"):
            first[f"{name}__{kind}"] = getattr(F, kind)(value)
            again[f"{name}__{kind}"] = getattr(F, kind)(f"{name}__{kind}")
        if kind == "avg":
            total = F.col(f"{name}__sum").cast("double")
            out.append((total / F.nullif(F.col(f"{name}__n"), F.lit(0))).alias(name))
        else:
            out.append(F.col(f"{name}__{'n' if kind == 'count' else kind}").alias(name))
    finest = df.groupBy(*dims).agg(*(c.alias(n) for n, c in first.items()))
    by_set = finest.groupingSets([[F.col(c) for c in s] for s in sets], *dims)
    every = by_set.agg(F.grouping_id().cast("int").alias(level), *(c.alias(n) for n, c in again.items()))
    return every.select(*dims, level, *out)


OTHER, MISSING = "other", "missing"


def pivoted(
    df: DataFrame, rows: Sequence[str], column: str, value: Column, most: int = 100
) -> DataFrame:
    """The sum of ``value`` with a row for each ``rows`` and a column for each ``column``.

    Columns are named by the values as text, in order. Of more than ``most`` values the
    most frequent have columns of their own (of equally frequent ones the first); all
    others add up under "other". Null values of ``column`` are "missing". Cells without a
    value are null. Only the values of ``column`` that get a column reach the driver, and
    only cells, not rows, are shuffled. A value whose text is "other" or "missing", or the
    name of one of ``rows``, is an error when it would name a column twice.
    """
    cell = F.col(column).cast("string")
    counts = df.groupBy(cell.alias("__value")).agg(F.count(F.lit(1)).alias("__n"))
    found = counts.filter("__value is not null").orderBy(F.col("__n").desc(), "__value").limit(most + 1).collect()
    names = sorted(r["__value"] for r in found[:most])
    if clash := {OTHER, MISSING, *rows} & set(names):
        raise ValueError(f"values that would name a column twice: {sorted(clash)}")
    named = F.when(cell.isNull(), MISSING).when(cell.isin(names), cell).otherwise(OTHER)
    cells = df.groupBy(*rows, named.alias("__value")).agg(F.sum(value).alias("__sum"))
    every = [*names, *([OTHER] if len(found) > most else []), MISSING]
    out = cells.groupBy(*rows).agg(
        *(F.sum(F.when(F.col("__value") == n, F.col("__sum"))).alias(n) for n in every)
    )
    return out
