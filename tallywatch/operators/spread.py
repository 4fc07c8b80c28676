"""Windows and joins that keep working when one key holds much of the data.

A window function puts every row of a key into one task. ``framed`` therefore
counts rows per key first (one pass over the key columns, combined map-side):

* no key above ``hot_rows``: plain window functions, one exchange for all of
  them - the usual case;
* otherwise the keys above the limit take a second lane. Their rows are cut
  into consecutive chunks of about ``hot_rows`` rows, the windows run inside
  each chunk after one exchange by (key, chunk), and what earlier chunks
  contribute is added from small per-chunk totals. Frames that look back a fixed
  number of rows get copies of the rows just before the chunk; frames over the
  order column's *values* are computed on one row per (key, value) and joined
  back.

Both lanes give the same result for every row; the tests force the second one
with a tiny ``hot_rows`` and compare.
"""

from __future__ import annotations

import math
import warnings
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywatch.session import pinned

HOT_ROWS = 2_000_000  # rows of one key that one task may sort
MAX_HOT_KEYS = 100_000  # keys the broadcast list of hot keys may hold
MAX_PIECES = 10_000  # chunks one key is cut into
SLICES = 8  # slices per chunk; a chunk looks back on whole slices
MANY_CUTS = 256  # cut points of a key that each of its rows may meet at once
SMALL_ROWS = 10_000  # rows of a join side that is copied to every task


# -- joins whose broadcast side is proven small ------------------------------


def small_copy(df: DataFrame, max_rows: int = SMALL_ROWS) -> DataFrame | None:
    """``df`` as a literal table when it has at most ``max_rows`` rows, else None.

    At most ``max_rows + 1`` rows reach the driver, whatever the size of ``df``;
    the copy saves computing an aggregate twice.
    """
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        return None
    return df.sparkSession.createDataFrame(rows, df.schema)


def match(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join on ``keys`` where null equals null; the key columns of ``right`` go."""
    renamed = {k: f"__right_{k}" for k in keys}
    right = right.withColumnsRenamed(renamed)
    on = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(r)) for k, r in renamed.items()])
    return left.join(right, on, how).drop(*renamed.values())


def attach(
    df: DataFrame, side: DataFrame, keys: Sequence[str], max_rows: int = SMALL_ROWS
) -> DataFrame:
    """Left-join one row per key to ``df``.

    The side is broadcast when it has at most ``max_rows`` rows. Beyond that it
    is a shuffle join without a hint, in which adaptive execution splits skewed
    partitions of ``df``.
    """
    local = small_copy(side, max_rows)
    return match(df, side if local is None else F.broadcast(local), keys)


# -- finding hot keys ---------------------------------------------------------


@dataclass(frozen=True)
class HotKeys:
    table: DataFrame  # keys, __rows, __lo, __hi, __skip, __first
    small: bool  # at most MAX_HOT_KEYS of them
    hot_rows: int  # rows per chunk
    most: int  # rows of the largest key
    pieces: int  # chunks over all hot keys, at most


def _tie_number(df: DataFrame, tie: str | Column, skip: Column, kind: T.DataType) -> Column:
    """A number that grows with the tie, or stays: for text its next six bytes."""
    tie = F.col(tie) if isinstance(tie, str) else tie
    if not isinstance(kind, T.StringType):
        return tie.cast("double")
    bytes_ = F.hex(F.substr(tie, skip + 1, F.lit(6)).cast("binary"))
    return F.conv(F.rpad(F.substr(bytes_, F.lit(1), F.lit(12)), 12, "0"), 16, 10).cast("double")


def _shared_start(a: Column, b: Column) -> Column:
    """How many characters two texts begin with alike."""
    alike = F.transform(
        F.sequence(F.lit(1), F.greatest(F.length(a), F.lit(1))),
        lambda i: F.substr(a, i, F.lit(1)) == F.substr(b, i, F.lit(1)),
    )
    differ = F.array_position(alike, F.lit(False)).cast("int")
    return F.when(differ > 0, differ - 1).otherwise(F.length(a))


def hot_keys(
    df: DataFrame,
    keys: Sequence[str],
    tie: str,
    hot_rows: int = HOT_ROWS,
    order: str | None = None,
) -> HotKeys | None:
    """Keys with more than ``hot_rows`` rows and the range of ``tie`` in each.

    More keys than a broadcast should hold stay a table, which is then joined
    without being copied to every task. A key is cut into ``MAX_PIECES`` chunks at
    most; one that would need more gets longer ones, with a warning.
    """
    kind = df.schema[tie].dataType
    text = isinstance(kind, T.StringType)
    skip = _shared_start(F.col("__min"), F.col("__max")) if text else F.lit(0)
    first = F.min(_ordinal(df, order)) if order else F.lit(0.0)
    counts = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__rows"),
        F.min(tie).alias("__min"),
        F.max(tie).alias("__max"),
        F.coalesce(first, F.lit(0.0)).alias("__first"),
    )
    counts = counts.filter(F.col("__rows") > hot_rows).withColumn("__skip", skip)
    counts = counts.select(
        *keys,
        "__rows",
        _tie_number(df, "__min", F.col("__skip"), kind).alias("__lo"),
        _tie_number(df, "__max", F.col("__skip"), kind).alias("__hi"),
        "__skip",
        "__first",
    )
    found = counts.limit(MAX_HOT_KEYS + 1).collect()
    if not found:
        return None
    small = len(found) <= MAX_HOT_KEYS
    table = df.sparkSession.createDataFrame(found, counts.schema) if small else pinned(counts, "hot")
    most = max(r["__rows"] for r in found) if small else table.agg(F.max("__rows")).first()[0]
    if most > hot_rows * MAX_PIECES:
        hot_rows = math.ceil(most / MAX_PIECES)
        warnings.warn(f"a key of {most} rows is cut into chunks of {hot_rows}", stacklevel=2)
    chunks = F.sum(F.ceil(F.col("__rows") / hot_rows) + 1)
    if small:
        pieces = sum(math.ceil(r["__rows"] / hot_rows) + 1 for r in found)
    else:
        pieces = table.agg(chunks).first()[0]
    return HotKeys(table, small, hot_rows, most, pieces)


def _maybe_broadcast(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= 4 * MAX_HOT_KEYS else df


# -- slices of a hot key -------------------------------------------------------


def _ordinal(df: DataFrame, order: str) -> Column:
    """The order column as a double that grows with it."""
    kind = df.schema[order].dataType
    if isinstance(kind, T.TimestampNTZType):
        value = F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{order}`)")
    elif isinstance(kind, T.TimestampType):
        value = F.unix_micros(order)
    elif isinstance(kind, T.DateType):
        value = F.unix_date(order)
    else:
        value = F.col(order)
    return value.cast("double")


def _passed(cuts: str, most: int, at: Column) -> Column:
    """How many of the ascending ``cuts``, ``most`` of them at most, are not above ``at``."""
    steps = F.array(*(F.lit(1 << bit) for bit in reversed(range(most.bit_length()))))

    def further(n: Column, step: Column) -> Column:
        return F.when(F.get(cuts, n + step - 1) <= at, n + step).otherwise(n)

    return F.aggregate(steps, F.lit(0), further)


def _sliced(
    warm: DataFrame, keys: Sequence[str], order: str, tie: str, hot: HotKeys
) -> DataFrame:
    """Add ``__slice``: consecutive, about equally long stretches of each key.

    Cut points are approximate percentiles of (order, tie) packed into one
    growing number. They decide only how even the slices are, not the result, as
    long as every use of them sees the same ones: so they are written down.
    """
    width = F.col("__hi") - F.col("__lo") + 1
    number = _tie_number(warm, tie, F.col("__skip"), warm.schema[tie].dataType)
    share = F.coalesce((number - F.col("__lo")) / width, F.lit(0.0))
    # null sorts first; close enough to the rest for a double to hold the share
    at = F.coalesce(_ordinal(warm, order), F.col("__first") - 2)
    warm = warm.withColumn("__packed", at + share)
    most = math.ceil(hot.most / hot.hot_rows) * SLICES
    shares = [i / most for i in range(1, most)]
    wanted = (F.ceil(F.col("__rows") / hot.hot_rows) * SLICES).cast("int")
    # a smaller hot key uses every n-th cut only
    nth = F.transform(
        F.sequence(F.lit(1), wanted - 1),
        lambda i: F.element_at("__all", F.greatest((i * most / wanted).cast("int"), F.lit(1))),
    )
    cuts = (
        warm.groupBy(*keys)
        .agg(
            F.percentile_approx("__packed", shares, max(10_000, 10 * most)).alias("__all"),
            F.first("__rows").alias("__rows"),
        )
        .select(*keys, nth.alias("__cuts"))
    )
    at = F.col("__packed")
    if most <= MANY_CUTS:
        cuts = _maybe_broadcast(pinned(cuts, "cuts"), hot.pieces)
        out = match(warm, cuts, keys, "inner").withColumn("__slice", _passed("__cuts", most, at))
    else:
        # no row is to meet all cuts of its key: first the block of them, then those of the block
        leap = math.isqrt(most)
        blocks = F.sequence(F.lit(0), F.floor((F.size("__cuts") - 1) / leap).cast("int"))
        cuts = cuts.withColumn("__block", F.explode(blocks))
        cuts = cuts.withColumn("__cuts", F.slice("__cuts", F.col("__block") * leap + 1, F.lit(leap)))
        cuts = pinned(cuts, "cuts")
        heads = F.sort_array(F.collect_list(F.when(F.col("__block") > 0, F.get("__cuts", F.lit(0)))))
        heads = cuts.groupBy(*keys).agg(heads.alias("__heads"))
        out = match(warm, _maybe_broadcast(heads, hot.pieces * SLICES // leap), keys, "inner")
        out = out.withColumn("__block", _passed("__heads", most // leap + 1, at)).drop("__heads")
        out = match(out, _maybe_broadcast(cuts, hot.pieces * SLICES), [*keys, "__block"], "inner")
        passed = F.col("__block") * leap + _passed("__cuts", leap, at)
        out = out.withColumn("__slice", passed).drop("__block")
    return out.drop("__cuts", "__packed", "__rows", "__lo", "__hi", "__skip", "__first")


def _before(totals: DataFrame, keys: Sequence[str], at: str, cols: Sequence[str]) -> DataFrame:
    """Per slice, the sums over the earlier slices of its key (few rows per key)."""
    earlier = Window.partitionBy(*keys).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(*keys, at, *[F.sum(c).over(earlier).alias(f"{c}_before") for c in cols])


def _slice_plan(totals: DataFrame, keys: Sequence[str], reach: int) -> DataFrame:
    """Per slice, the chunks that need its rows: its own, and later ones that look back to it.

    ``totals`` has one row per slice with its exact row count ``__n``, so the
    rows a chunk gets from before its start are at least ``reach``, or all.
    """
    own = F.floor(F.col("__slice") / SLICES)
    so_far = Window.partitionBy(*keys).orderBy("__slice")
    slices = totals.select(
        *keys,
        "__slice",
        own.alias("__own"),
        (F.sum("__n").over(so_far) - F.col("__n")).alias("__start"),
        F.sum("__n").over(so_far).alias("__end"),
    )
    if not reach:
        return slices.select(*keys, "__slice", "__own", F.array("__own").alias("__chunks"))
    # every chunk has a row, so none further than `reach` chunks can look back here
    next_ones = Window.partitionBy(*keys).orderBy("__own").rowsBetween(1, reach + 1)
    starts = slices.groupBy(*keys, "__own").agg(F.min("__start").alias("__at"))
    starts = starts.select(
        *keys, "__own", F.collect_list(F.struct("__own", "__at")).over(next_ones).alias("__later")
    )
    planned = match(slices, starts, [*keys, "__own"], "inner")
    needing = F.filter("__later", lambda s: s["__at"] < F.col("__end") + reach)
    others = F.transform(needing, lambda s: s["__own"])
    return planned.select(
        *keys, "__slice", "__own", F.concat(F.array("__own"), others).alias("__chunks")
    )


# -- windows -----------------------------------------------------------------


@dataclass
class Frames:
    """Window columns over one key, ordered by an order column and a unique tie.

    ``lookback``: functions of a window spec that need at most ``reach`` rows
    before the current one. ``running``: values summed over the rows so far;
    ``running_after``: the same for values made from lookback columns. ``carried``: the
    last value so far that is not null. ``ranged``: (value, n) summed over rows whose order
    value lies in [current - n, current], n None for all earlier ones; rows with
    the same order value share the result. ``whole``: aggregates over the key.
    ``position``: name of the row number.
    """

    lookback: Mapping[str, Callable[[WindowSpec], Column]] = field(default_factory=dict)
    reach: int = 0
    running: Mapping[str, Column] = field(default_factory=dict)
    running_after: Mapping[str, Column] = field(default_factory=dict)
    carried: Mapping[str, Column] = field(default_factory=dict)
    ranged: Mapping[str, tuple[Column, int | None]] = field(default_factory=dict)
    whole: Mapping[str, Column] = field(default_factory=dict)
    position: str | None = None

    def names(self) -> list[str]:
        first = [*self.lookback, *([self.position] if self.position else [])]
        return [*first, *self.running, *self.running_after, *self.carried, *self.ranged, *self.whole]


def framed(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    tie: str,
    frames: Frames,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """``df`` with the columns of ``frames``; exact for every size of key.

    ``hot_rows=None`` skips the count when no key can be hot.
    """
    keys = list(keys)
    hot = None if hot_rows is None else hot_keys(df, keys, tie, hot_rows, order)
    if hot is None:
        return _plain(df, keys, order, tie, frames)
    listed = F.broadcast(hot.table) if hot.small else hot.table
    cool = match(df, listed.select(*keys), keys, "left_anti")
    warm = match(df, listed, keys, "inner")
    columns = [*df.columns, *frames.names()]
    return (
        _plain(cool, keys, order, tie, frames)
        .select(*columns)
        .unionByName(_chunked(warm, keys, order, tie, frames, hot).select(*columns))
    )


def _range_frame(keys: Sequence[str], order: str, back: int | None) -> WindowSpec:
    start = Window.unboundedPreceding if back is None else -back
    return Window.partitionBy(*keys).orderBy(order).rangeBetween(start, Window.currentRow)


def _plain(
    df: DataFrame, keys: Sequence[str], order: str, tie: str, frames: Frames
) -> DataFrame:
    by_row = Window.partitionBy(*keys).orderBy(order, tie)
    so_far = by_row.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first = {name: make(by_row) for name, make in frames.lookback.items()}
    if frames.position:
        first[frames.position] = F.row_number().over(by_row)
    sums = {**frames.running, **frames.running_after}
    rest = {name: F.sum(value).over(so_far) for name, value in sums.items()}
    for name, value in frames.carried.items():
        rest[name] = F.last(value, ignorenulls=True).over(so_far)
    for name, (value, back) in frames.ranged.items():
        rest[name] = F.sum(value).over(_range_frame(keys, order, back))
    for name, value in frames.whole.items():
        rest[name] = value.over(Window.partitionBy(*keys))
    if first:
        df = df.withColumns(first)
    return df.withColumns(rest) if rest else df


def _chunked(
    warm: DataFrame, keys: Sequence[str], order: str, tie: str, frames: Frames, hot: HotKeys
) -> DataFrame:
    out = warm
    if frames.lookback or frames.running or frames.running_after or frames.carried or frames.position:
        out = _by_chunk(out, keys, order, tie, frames, hot)
    if frames.ranged:
        # one row per (key, order value), so hot values cost a single row here
        cells = warm.groupBy(*keys, order).agg(
            *[F.sum(value).alias(name) for name, (value, _) in frames.ranged.items()]
        )
        cells = cells.select(
            *keys,
            order,
            *[
                F.sum(name).over(_range_frame(keys, order, back)).alias(name)
                for name, (_, back) in frames.ranged.items()
            ],
        )
        out = attach(out, cells, [*keys, order])
    if frames.whole:
        totals = warm.groupBy(*keys).agg(*[v.alias(n) for n, v in frames.whole.items()])
        out = match(out, _maybe_broadcast(totals, hot.pieces), keys)
    return out


def _copied(
    sliced: DataFrame, keys: Sequence[str], summed: Mapping[str, Column], reach: int, hot: HotKeys
) -> DataFrame:
    """Rows with their ``__chunk``, and copies for the chunks that look back to them."""
    totals = sliced.groupBy(*keys, "__slice").agg(
        F.count(F.lit(1)).alias("__n"), *[F.sum(v).alias(n) for n, v in summed.items()]
    )
    plan = _slice_plan(totals, keys, reach)
    if summed:
        own = F.floor(F.col("__slice") / SLICES).alias("__own")
        chunks = totals.groupBy(*keys, own).agg(*[F.sum(n).alias(n) for n in summed])
        plan = match(plan, _before(chunks, keys, "__own", list(summed)), [*keys, "__own"])
    plan = _maybe_broadcast(plan, hot.pieces * SLICES)
    rows = match(sliced, plan, [*keys, "__slice"], "inner")
    # copies of earlier rows are there to look back on and count nowhere
    rows = rows.withColumn("__chunk", F.explode("__chunks"))
    return rows.withColumn("__mine", F.col("__chunk") == F.col("__own"))


def _by_chunk(
    warm: DataFrame, keys: Sequence[str], order: str, tie: str, frames: Frames, hot: HotKeys
) -> DataFrame:
    """Row-based columns: one exchange by (key, chunk), totals of earlier chunks added."""
    summed = dict(frames.running)
    if frames.position:
        summed["__pos"] = F.lit(1)
    sliced = _sliced(warm, keys, order, tie, hot)
    if frames.carried or frames.running_after:  # these read the rows twice more
        sliced = pinned(sliced, "sliced")
    if frames.reach:
        rows = _copied(sliced, keys, summed, frames.reach, hot)
    else:
        rows = sliced.withColumn("__chunk", F.floor(F.col("__slice") / SLICES))
        if summed:
            chunks = rows.groupBy(*keys, "__chunk").agg(*[F.sum(v).alias(n) for n, v in summed.items()])
            before = _before(chunks, keys, "__chunk", list(summed))
            rows = match(rows, _maybe_broadcast(before, hot.pieces), [*keys, "__chunk"], "inner")
        rows = rows.withColumn("__mine", F.lit(True))

    cells = [*keys, "__chunk"]
    by_row = Window.partitionBy(*cells).orderBy(order, tie)
    so_far = by_row.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    if frames.lookback:
        rows = rows.withColumns({name: make(by_row) for name, make in frames.lookback.items()})
    late = dict(frames.running_after)
    out = rows.withColumns(
        {
            n: F.sum(F.when(F.col("__mine"), v)).over(so_far)
            for n, v in {**summed, **late}.items()
        }
    )
    if frames.carried:
        mine = {n: F.when(F.col("__mine"), v) for n, v in frames.carried.items()}
        out = out.withColumns({n: F.last(v, ignorenulls=True).over(so_far) for n, v in mine.items()})
        # what the chunks before leave behind: one row each
        at = F.struct(order, tie)
        ends = rows.filter("__mine").groupBy(*cells)
        ends = ends.agg(
            *[F.max_by(v, F.when(v.isNotNull(), at)).alias(n) for n, v in frames.carried.items()]
        )
        earlier = Window.partitionBy(*keys).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
        left = {n: F.last(n, ignorenulls=True).over(earlier).alias(f"{n}_left") for n in frames.carried}
        ends = _maybe_broadcast(ends.select(*cells, *left.values()), hot.pieces)
        out = match(out, ends, cells)
        out = out.withColumns({n: F.coalesce(n, f"{n}_left") for n in frames.carried})
    if late:
        chunks = rows.filter("__mine").groupBy(*cells)
        chunks = chunks.agg(*[F.sum(v).alias(n) for n, v in late.items()])
        carried = _maybe_broadcast(_before(chunks, keys, "__chunk", list(late)), hot.pieces)
        out = match(out, carried, cells)
    types = {n: out.schema[n].dataType for n in [*summed, *late]}
    out = out.filter("__mine").withColumns(
        {
            n: F.coalesce(F.col(n) + F.col(f"{n}_before"), n, f"{n}_before").cast(kind)
            for n, kind in types.items()
        }
    )
    if frames.position:
        out = out.withColumn(frames.position, F.col("__pos").cast("int"))
    return out


# -- positions and ranks on their own --------------------------------------------


def position(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    tie: str,
    name: str,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Exact row number by (order, tie) within ``keys``."""
    return framed(df, keys, order, tie, Frames(position=name), hot_rows)


def rank_within(
    df: DataFrame, group: str, value: str, name: str, pieces: int | None = None
) -> DataFrame:
    """SQL ``rank()`` of ``value``, descending, within few large groups.

    The rank of a value is one plus the number of rows above it. So rows are
    counted per distinct value first (map-side), the distinct values are sliced
    by approximate percentiles, and ranks come from slice totals plus a running
    count inside each slice. Neither a large group nor a frequent value ends up
    in one task. Nulls rank last.
    """
    spark = df.sparkSession
    pieces = pieces or max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    shares = [i / pieces for i in range(1, pieces)] or [0.5]
    distinct = df.groupBy(group, value).agg(F.count(F.lit(1)).alias("__n"))
    distinct = pinned(distinct, "distinct")  # used three times below
    number = F.col(value).cast("double")
    cuts = distinct.groupBy(group).agg(
        F.percentile_approx(number, shares, max(10_000, 10 * pieces)).alias("__cuts")
    )
    sliced = attach(distinct, pinned(cuts, "cuts"), [group])
    higher = F.size(F.filter("__cuts", lambda c: c > number))
    last = len(shares) + 1
    sliced = sliced.withColumn(
        "__slice", F.when(F.col(value).isNull(), last).otherwise(higher)
    ).drop("__cuts")
    totals = sliced.groupBy(group, "__slice").agg(F.sum("__n").alias("__n"))
    offsets = _before(totals, [group], "__slice", ["__n"])
    above = (
        Window.partitionBy(group, "__slice")
        .orderBy(F.col(value).desc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    ranked = match(
        sliced.withColumn("__above", F.sum("__n").over(above)), offsets, [group, "__slice"]
    )
    rank = 1 + F.coalesce("__above", F.lit(0)) + F.coalesce("__n_before", F.lit(0))
    return match(df, ranked.select(group, value, rank.alias(name)), [group, value])
