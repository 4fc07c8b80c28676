"""Joins over time: points in intervals, and the latest row before each row.

``interval_join`` turns "start <= at < end" into equality. Time is cut into bins of
several widths, each four times the one before, beginning with a width measured from the
intervals. An interval goes into the one or two bins it touches at the first width that
is not shorter than it; a point looks into its bin at every width in use. So a pair can
meet in one bin only, and a long interval costs no more rows than a short one.

``asof_join`` puts both sides under each other, sorts them once by key and time and
carries the last row of the right side forward, over chunk borders where a key is hot.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywatch.operators.spread import (
    HOT_ROWS,
    MAX_HOT_KEYS,
    Frames,
    _ordinal,
    framed,
    match,
)
from tallywatch.session import pinned

STEP = 4  # how many times wider the bins of the next level are
FINEST = 2.0**-40  # width of the narrowest bins, at least, as a share of the points' range
TIE_SPAN = 10**20  # more than the ids of one side span


def _no_clash(left: Sequence[str], right: Sequence[str]) -> None:
    both = sorted(set(left) & set(right))
    if both:
        raise ValueError(f"both sides have the columns {both}: rename them first")


# -- points in intervals ---------------------------------------------------------------


def _levels(intervals: DataFrame, least: float) -> tuple[DataFrame, list[tuple[int, float]]]:
    """``intervals`` with ``__level``, and the levels in use with the width of their bins."""
    length = F.col("__hi") - F.col("__lo")
    base = intervals.filter(length > 0).agg(F.percentile_approx(length, 0.25)).first()[0]
    base = max(float(base or 1.0), least)
    level = F.greatest(F.ceil(F.log(length / base) / F.log(F.lit(float(STEP)))), F.lit(0)).cast("int")
    intervals = intervals.withColumn("__level", F.coalesce(level, F.lit(0)))
    used = sorted(r[0] for r in intervals.select("__level").distinct().collect())  # some dozens at most
    return intervals, [(n, base * float(STEP) ** n) for n in used]


def _bin(value: str, widths: list[tuple[int, float]]) -> Column:
    """The bin of ``value`` among those of the row's ``__level``."""
    width = F.element_at(F.create_map(*(F.lit(x) for pair in widths for x in pair)), F.col("__level"))
    return F.floor(F.col(value) / width)


def _pieces(df: DataFrame, cell: list[str], name: str, hot_rows: int) -> DataFrame | None:
    """Cells of more than ``hot_rows`` rows and the pieces they are cut into."""
    counts = df.groupBy(*cell).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > hot_rows)
    counts = pinned(counts.select(*cell, F.ceil(F.col("__n") / hot_rows).cast("int").alias(name)), "cells")
    return None if counts.isEmpty() else counts


def _spread_cells(
    points: DataFrame, intervals: DataFrame, cell: list[str], hot_rows: int
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides with the numbers of the pieces of their cell: each pair of pieces meets once."""
    found = [_pieces(points, cell, "__a", hot_rows), _pieces(intervals, cell, "__b", hot_rows)]
    if not any(found):
        return points, intervals, []
    sides = [points, intervals]
    for name, cells in zip(("__a", "__b"), found):
        for i, side in enumerate(sides):
            if cells is None:
                sides[i] = side.withColumn(name, F.lit(1))
                continue
            small = cells.count() <= MAX_HOT_KEYS
            side = match(side, F.broadcast(cells) if small else cells, cell)
            sides[i] = side.withColumn(name, F.coalesce(name, F.lit(1)))
    own = [c for c in points.columns if not c.startswith("__")]
    dealt = lambda df, cols, n: F.pmod(F.xxhash64(*cols), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    points = sides[0].withColumn("__a", dealt(sides[0], own, "__a")).withColumn("__b", every("__b"))
    own = [c for c in intervals.columns if not c.startswith("__")] + ["__lo", "__hi"]
    intervals = sides[1].withColumn("__b", dealt(sides[1], own, "__b")).withColumn("__a", every("__a"))
    return points, intervals, ["__a", "__b"]


def interval_join(
    points: DataFrame,
    intervals: DataFrame,
    at: str,
    start: str,
    end: str,
    keys: Sequence[str] = (),
    how: str = "inner",
    tie: str | None = None,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Each row of ``points`` with every interval that holds it: ``start <= at < end``.

    Intervals may overlap and be of any lengths; a null ``end`` is open. ``keys``, if
    any, must be equal as well. Both sides' columns come out, the keys once. ``how``
    is "inner" or "left"; a left join keeps points that nothing holds and needs ``tie``,
    a column that is unique in ``points``.

    Null points, keys and starts, and intervals that end before they begin, meet
    nothing. Repeated rows meet each. Cells (a bin of a key) of more than ``hot_rows``
    rows of either side are dealt out in pieces, ``None`` skips counting them. An empty
    side gives no pairs.
    """
    keys = list(keys)
    if how not in ("inner", "left"):
        raise ValueError(f"how is 'inner' or 'left', not {how!r}")
    if how == "left" and tie is None:
        raise ValueError("a left join needs tie, a unique column of the points")
    brought = [c for c in intervals.columns if c not in keys]
    _no_clash(points.columns, brought)
    known = points.withColumn("__at", _ordinal(points, at)).filter("__at is not null")
    lowest, highest = known.agg(F.min("__at"), F.max("__at")).first()
    found = intervals.withColumn("__lo", _ordinal(intervals, start)).withColumn("__hi", _ordinal(intervals, end))
    sane = F.col(start).isNotNull() & (F.col(end).isNull() | (F.col(start) < F.col(end)))
    found = found.filter(sane).filter(
        (F.col("__lo") <= F.lit(highest)) & (F.col("__hi").isNull() | (F.col("__hi") >= F.lit(lowest)))
    )
    # nothing beyond the points needs a bin
    found = found.withColumns(
        {
            "__lo": F.greatest("__lo", F.lit(lowest)),
            "__hi": F.least(F.coalesce("__hi", F.lit(highest)), F.lit(highest)),
        }
    )
    found, widths = _levels(found, FINEST * ((highest or 0.0) - (lowest or 0.0)))
    if not widths:
        found = found.withColumn("__bin", F.lit(0).cast("long"))
        known = known.withColumn("__level", F.lit(0)).withColumn("__bin", F.lit(0).cast("long"))
    else:
        touched = F.sequence(_bin("__lo", widths), _bin("__hi", widths))
        found = found.withColumn("__bin", F.explode(touched))
        known = known.withColumn("__level", F.explode(F.array(*(F.lit(n) for n, _ in widths))))
        known = known.withColumn("__bin", _bin("__at", widths))
    cell = [*keys, "__level", "__bin"]
    pieces: list[str] = []
    if hot_rows is not None:
        known, found, pieces = _spread_cells(known, found, cell, hot_rows)
    pairs = known.join(found.drop("__lo", "__hi"), [*cell, *pieces])
    inside = (F.col(at) >= F.col(start)) & (F.col(end).isNull() | (F.col(at) < F.col(end)))
    pairs = pairs.filter(inside).select(*points.columns, *brought)
    if how == "inner":
        return pairs
    pairs = pinned(pairs, "pairs")
    alone = points.join(pairs.select(tie).distinct(), tie, "left_anti")
    return pairs.unionByName(alone, allowMissingColumns=True)


# -- the latest row before ----------------------------------------------------------------


def _apart(df: DataFrame, later: str, earlier: str, tolerance: float | timedelta) -> Column:
    if isinstance(tolerance, timedelta):
        tolerance = tolerance / timedelta(microseconds=1)
    return _ordinal(df, later) - _ordinal(df, earlier) > F.lit(float(tolerance))


def asof_join(
    left: DataFrame,
    right: DataFrame,
    at: str,
    right_at: str,
    tie: str,
    right_tie: str,
    keys: Sequence[str],
    exact: bool = True,
    tolerance: float | timedelta | None = None,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Each row of ``left`` with the latest row of ``right`` at or before it.

    The right side's columns come out null where there is none, or none within
    ``tolerance`` (a number in the unit of ``at``; a ``timedelta`` for timestamps).
    ``exact=False`` looks for earlier rows only. Of right rows at the same time the one
    with the largest ``right_tie`` counts. ``tie`` and ``right_tie`` are whole numbers,
    unique in their side, and ``at`` and ``right_at`` of one type.

    Rows whose key or time is null find nothing and are not found; left rows always stay.
    Keys of more than ``hot_rows`` rows of both sides are cut into chunks. There is one
    exchange and no product of rows and versions.
    """
    keys = list(keys)
    brought = [c for c in right.columns if c not in keys]
    _no_clash(left.columns, brought)
    first, second = (1, 0) if exact else (0, 1)  # what comes first at the same time

    def place(id_: str, side: int) -> Column:
        # what comes second lies beyond all ids of what comes first
        return F.col(id_).cast("decimal(20,0)") + F.lit(str(side * TIE_SPAN)).cast("decimal(22,0)")

    known = right.dropna(subset=[*keys, right_at])
    below = known.select(
        *keys,
        F.col(right_at).alias("__at"),
        place(right_tie, second).alias("__tie"),
        F.struct(*brought).alias("__found"),
    )
    above = left.withColumns(
        {"__at": F.col(at), "__tie": place(tie, first), "__left": F.lit(True)}
    )
    both = above.unionByName(below, allowMissingColumns=True)
    carried = framed(both, keys, "__at", "__tie", Frames(carried={"__last": F.col("__found")}), hot_rows)
    out = carried.filter("__left")
    nothing = F.col(at).isNull()
    for key in keys:
        nothing = nothing | F.col(key).isNull()
    out = out.select(*left.columns, F.when(~nothing, F.col("__last")).alias("__last"))
    out = out.select(*left.columns, *(F.col("__last")[c].alias(c) for c in brought))
    if tolerance is None:
        return out
    far = _apart(out, at, right_at, tolerance)
    return out.withColumns({c: F.when(~far, F.col(c)) for c in brought})
