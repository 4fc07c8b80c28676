"""Write semantics: upserts, change sets and layout, as DataFrame operators.

The operators return the complete new table; ``sources.store`` commits it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywatch.operators.quality import IntegrityError, dedupe, has_duplicates
from tallywatch.operators.spread import match


def unique_source(
    source: DataFrame, keys: Sequence[str], order: Sequence[str] | None, strict: bool
) -> DataFrame:
    """The source with one row per key, which an upsert needs.

    With ``order`` the first row by it wins. Without, two rows with one key are an
    error when the rows are computed; ``strict`` looks for it at once. A key with a
    null matches nothing, so such rows may repeat.
    """
    if strict and has_duplicates(source, keys):
        raise IntegrityError(f"several source rows share a key in {list(keys)}")
    if order is not None:
        return dedupe(source, keys, order)
    several = F.count(F.lit(1)).over(Window.partitionBy(*keys)) > 1
    for key in keys:
        several = several & F.col(key).isNotNull()
    error = F.raise_error(f"several source rows share a key in {list(keys)}").cast("boolean")
    checked = source.withColumn("__several", several)
    return checked.filter(F.when(F.col("__several"), error).otherwise(True)).drop("__several")


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    *,
    order: Sequence[str] | None = None,
    strict: bool = False,
    allow_new_columns: bool = False,
) -> DataFrame:
    """Target rows without a source row, plus all source rows.

    Columns are matched by name. ``allow_new_columns`` widens the table: the
    side that lacks a column gets null.
    """
    source = unique_source(source, keys, order, strict)
    kept = target.join(source.select(*keys), list(keys), "left_anti")
    return kept.unionByName(source, allowMissingColumns=allow_new_columns)


def insert_missing(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    *,
    order: Sequence[str] | None = None,
) -> DataFrame:
    """Target plus the source rows whose key it lacks; existing rows stay as they are."""
    new = unique_source(source, keys, order, False)
    new = new.join(target.select(*keys), list(keys), "left_anti")
    return target.unionByName(new)


def update_matched(
    target: DataFrame,
    source: DataFrame,
    on: Sequence[str],
    values: Mapping[str, Column],
    when: Column | None = None,
    *,
    order: Sequence[str] | None = None,
) -> DataFrame:
    """Set columns of target rows that have a source row and satisfy ``when``.

    ``values`` and ``when`` may use target columns and, as ``src_<name>``, those
    of the source, which must have one row per key, see ``unique_source``.
    """
    source = unique_source(source, on, order, False)
    marked = source.withColumnsRenamed(
        {c: f"src_{c}" for c in source.columns if c not in on}
    ).withColumn("__hit", F.lit(True))
    joined = target.join(marked, list(on), "left")
    hit = F.coalesce(F.col("__hit"), F.lit(False))
    if when is not None:
        hit = hit & F.coalesce(when, F.lit(False))
    return joined.select(
        *[
            F.when(hit, values[c]).otherwise(F.col(c)).alias(c) if c in values else F.col(c)
            for c in target.columns
        ]
    )


def change_set(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows to insert, update or delete to turn ``before`` into ``after``.

    ``change_type`` says which; the columns hold the new row, or the deleted
    one. Keys must be unique on each side. Null equals null, and a column that
    one side lacks is null there.
    """
    attrs = [c for c in after.columns if c not in keys]
    attrs += [c for c in before.columns if c not in keys and c not in attrs]
    kinds = {c: df.schema[c].dataType for df in (after, before) for c in df.columns}

    def row_of(df: DataFrame) -> Column:
        have = [F.col(c) if c in df.columns else F.lit(None).cast(kinds[c]) for c in attrs]
        return F.struct(*(c.alias(name) for c, name in zip(have, attrs)))

    old = before.select(*keys, row_of(before).alias("__old"))
    new = after.select(*keys, row_of(after).alias("__new"))
    both = old.withColumn("__in_old", F.lit(True)).join(
        new.withColumn("__in_new", F.lit(True)), list(keys), "full_outer"
    )
    kind = (
        F.when(F.col("__in_old").isNull(), "insert")
        .when(F.col("__in_new").isNull(), "delete")
        .when(~F.col("__old").eqNullSafe(F.col("__new")), "update")
    )
    row = F.coalesce("__new", "__old")
    changed = both.withColumn("change_type", kind).filter(F.col("change_type").isNotNull())
    return changed.select(
        "change_type", *keys, *[row.getField(a).alias(a) for a in attrs]
    )


def apply_changes(before: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The table after a ``change_set``."""
    kept = before.join(changes.select(*keys), list(keys), "left_anti")
    added = changes.filter(F.col("change_type") != "delete").drop("change_type")
    return kept.unionByName(added)


def compact_cluster(df: DataFrame, cols: Sequence[str], files: int) -> DataFrame:
    """Lay rows out in ``files`` sorted ranges of ``cols`` before a write.

    Parquet statistics then skip most row groups for a filter on the leading
    columns. End ``cols`` in a unique column so that a frequent value can span
    several files.
    """
    return df.repartitionByRange(files, *cols).sortWithinPartitions(*cols)


def tag_columns(df: DataFrame, comments: Mapping[str, str]) -> DataFrame:
    """Attach a comment (such as a PII note) to columns; parquet keeps it."""
    for name, comment in comments.items():
        df = df.withMetadata(name, {"comment": comment})
    return df
