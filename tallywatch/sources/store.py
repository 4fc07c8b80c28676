"""Tables on a shared path, without a table format.

Plain tables are parquet folders. A table that is read and replaced in the same
job is kept as numbered versions of such a folder: a new version is written
next to the current one, and readers take the highest version whose job
committed (Spark leaves ``_SUCCESS`` last). A job that dies leaves the current
version untouched. One writer per table.
"""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywatch.operators.spread import SMALL_ROWS
from tallywatch.operators.tables import unique_source, upsert

_VERSION = "version="


def write_table(
    df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()
) -> None:
    """Overwrite (schema included) or append.

    A partitioned write is balanced first: small partitions share a task and a
    large one is split over several, so a frequent value is not one file.
    """
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


# -- versioned tables ---------------------------------------------------------


def versions(spark: SparkSession, base: str) -> list[int]:
    """Committed versions, ascending."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(base)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    marks = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/{_VERSION}*/_SUCCESS")
    found = fs.globStatus(marks) or []
    return sorted(int(m.getPath().getParent().getName()[len(_VERSION) :]) for m in found)


def read_version(spark: SparkSession, base: str, version: int | None = None) -> DataFrame | None:
    """The current version of a table, or the given one; None before the first."""
    known = versions(spark, base)
    if not known:
        return None
    return spark.read.parquet(f"{base}/{_VERSION}{known[-1] if version is None else version}")


def commit(df: DataFrame, base: str, partition_by: Sequence[str] = ()) -> int:
    """Write the next version and return its number. ``df`` may read the current one."""
    known = versions(df.sparkSession, base)
    number = known[-1] + 1 if known else 0
    write_table(df, f"{base}/{_VERSION}{number}", "overwrite", partition_by)
    return number


def materialize(
    df: DataFrame,
    base: str,
    keys: Sequence[str],
    *,
    order: Sequence[str] | None = None,
    allow_new_columns: bool = False,
) -> DataFrame:
    """First load or upsert by ``keys``; one row with the counts before and after."""
    spark = df.sparkSession
    current = read_version(spark, base)
    new = (
        df
        if current is None
        else upsert(current, df, keys, order=order, allow_new_columns=allow_new_columns)
    )
    commit(new, base)
    after = read_version(spark, base).agg(F.count(F.lit(1)).alias("rows_after"))
    if current is None:
        before = F.lit(0).cast("long")
    else:
        before = F.lit(current.count())
    return after.select(
        before.alias("rows_before"),
        "rows_after",
        (F.col("rows_after") - before).alias("rows_added"),
        F.lit(current is None).alias("is_first_load"),
    )


# -- upsert that rewrites only the partitions it touches -----------------------


def upsert_partitions(
    source: DataFrame,
    path: str,
    keys: Sequence[str],
    partition_col: str,
    *,
    order: Sequence[str] | None = None,
    schema: T.StructType | None = None,
    unique: bool = False,
) -> None:
    """Upsert into a partitioned table, rewriting only partitions in ``source``.

    A key belongs to one partition: the partition column is part of the key.
    The new partitions are first written and committed to a folder beside the
    table and swapped in from there. A swap that was cut short is made good by the
    next call, before it reads the table.

    With ``unique`` the caller knows that no two rows of the source share a key. It is
    computed once, into partitions beside the table, and if the table has none of
    them these are what is swapped in.
    """
    spark = source.sparkSession
    finish_swap(spark, path, partition_col)
    target = read_table(spark, path) if schema is None else spark.read.schema(schema).parquet(path)
    beside = f"{path.rstrip('/')}.source"
    if unique:
        source = _like(source, target)
        write_table(source, beside, "overwrite", [partition_col])
        source = spark.read.schema(source.schema).parquet(beside)
    values = source.select(partition_col).distinct()
    local = values.limit(SMALL_ROWS + 1).collect()
    if len(local) > SMALL_ROWS:
        touched = target.join(values, partition_col, "left_semi")
    else:
        # literals, so that untouched folders are not even listed
        listed = [r[0] for r in local]
        wanted = F.col(partition_col).isin([v for v in listed if v is not None])
        touched = target.filter(wanted | F.col(partition_col).isNull() if None in listed else wanted)
    whole_key = [*keys, partition_col]
    new = touched.isEmpty()  # new partitions only: nothing to look for
    if new and unique:
        _move(spark, beside, _staged(path))
    else:
        if new:
            merged = unique_source(source, whole_key, order, False)
        else:
            merged = upsert(touched, source, whole_key, order=order)
        write_table(_like(merged, target), _staged(path), "overwrite", [partition_col])
    finish_swap(spark, path, partition_col)
    if unique:
        _files(spark, path).delete(_folder(spark, beside), True)


def _like(df: DataFrame, table: DataFrame) -> DataFrame:
    """The table's columns with its types: the files are to lie beside its own."""
    kinds = {f.name: f.dataType for f in table.schema}
    same = {f.name for f in df.schema if kinds.get(f.name) == f.dataType}
    return df.select(*[F.col(c) if c in same else F.col(c).cast(kinds[c]) for c in table.columns])


def _staged(path: str) -> str:
    return f"{path.rstrip('/')}.staged"


def _folder(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _files(spark: SparkSession, path: str):
    return _folder(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def _move(spark: SparkSession, old: str, new: str) -> None:
    """Put folder ``old`` in the place of ``new``."""
    fs = _files(spark, new)
    fs.delete(_folder(spark, new), True)
    if not fs.rename(_folder(spark, old), _folder(spark, new)):
        raise OSError(f"{old} could not be moved to {new}")


def table_exists(spark: SparkSession, path: str) -> bool:
    return _files(spark, path).exists(_folder(spark, path))


def finish_swap(spark: SparkSession, path: str, partition_col: str) -> bool:
    """Swap in partitions that are committed beside the table; False if there are none.

    Their folders are moved one by one; those still beside the table are moved by the
    next call if this one is cut short.
    """
    staged, fs = _staged(path), _files(spark, path)
    if not fs.exists(_folder(spark, f"{staged}/_SUCCESS")):
        return False
    fs.mkdirs(_folder(spark, path))
    for name in [f.getPath().getName() for f in fs.listStatus(_folder(spark, staged))]:
        if unquote(name).startswith(f"{partition_col}="):
            _move(spark, f"{staged}/{name}", f"{path}/{name}")
    fs.delete(_folder(spark, staged), True)
    spark.catalog.refreshByPath(path)
    return True
