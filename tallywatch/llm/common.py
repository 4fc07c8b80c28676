"""What the operators of this subpackage share."""

from __future__ import annotations

import gc
import os
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import wraps
from pathlib import Path

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywatch.session import pinned

TEXT_ROWS = 2_000  # texts that go to a Python worker at a time
SMALL_IDS = 1_000_000  # rows of a few numbers that may be broadcast: some 40 MB

#: A word: a run of characters other than the ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

Names = list[str]


def importable(query: Callable) -> Callable:
    """``query``, with this package on the path of Spark's Python workers.

    For sessions begun elsewhere than in the package's folder. Executors on other
    machines need the package installed, or sent along with ``--py-files``.
    """

    @wraps(query)
    def run(spark: SparkSession, *args: object) -> DataFrame:
        root = str(Path(__file__).resolve().parents[2])
        env = spark.sparkContext.environment
        paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
        if root not in paths:
            env["PYTHONPATH"] = os.pathsep.join([root, *paths])
        return query(spark, *args)

    return run


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d.rstrip('/')}/{name}.parquet")


def numbered(df: DataFrame, name: str, label: str) -> DataFrame:
    """``df`` written to the shared folder with a number of its own for each row.

    Equal rows get different numbers, and the numbers stay: later reads see what
    was written, also after an executor is lost.
    """
    return pinned(df.withColumn(name, F.monotonically_increasing_id()), label)


def of_driver(spark: SparkSession, **columns: pa.Array) -> DataFrame:
    """A few rows that the driver has, as a table.

    ``createDataFrame`` sends a list of rows through Python workers of another kind than
    those of queries: each executor starts a daemon and workers for it, which stay.
    """
    with arrow_rows(spark, SMALL_IDS):
        return spark.createDataFrame(pa.table(columns))


def file_rows(df: DataFrame, name: str, label: str) -> DataFrame:
    """``df`` with a long of its own for each row, the same in every read.

    Rows read straight from files are known by their file's number and their place
    there; anything else is written first, see ``numbered``. The numbers tell rows
    apart, they are no order: other files give other numbers (see ``content``).
    """
    try:
        place = df.select("*", "_metadata.file_path", "_metadata.row_index")
    except AnalysisException:
        return numbered(df, name, label)
    path, index = place.columns[-2:]
    files = sorted(r[0] for r in place.select(path).distinct().collect())  # names of files only
    numbers = pa.array(range(len(files)), pa.int64())
    number = of_driver(df.sparkSession, __file=numbers, __path=pa.array(files, pa.string()))
    found = place.join(F.broadcast(number), F.col(path) == F.col("__path"))
    row = F.shiftleft("__file", 40).bitwiseOR(F.col(index))
    return found.withColumn(name, row).select(*df.columns, name)


def content(df: DataFrame, *columns: str) -> Column:
    """A number that depends on what a row holds only, not on where it lies."""
    return F.xxhash64(*(F.col(c) for c in columns or df.columns))


def let_go(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of results that are written and not used again.

    It does so when the driver collects its garbage, which a driver with little to do
    puts off while the executors' disks fill up.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """What runs meanwhile sends ``rows`` rows to a Python worker at a time, or the session's if fewer.

    Spark counts rows, not bytes, and holds a batch several times, beside the heap and in
    the worker: 10,000 texts are some 20 MB each time.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    n = int(before)
    spark.conf.set(key, str(min(n, rows) if n > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def by_ids(df: DataFrame, ids: DataFrame, name: str, how: str) -> DataFrame:
    """A join with stored ids, broadcast up to ``SMALL_IDS`` of them, else shuffled."""
    small = ids.count() <= SMALL_IDS
    return df.join(F.broadcast(ids) if small else ids, name, how)


def n_words(text: str | Column) -> Column:
    """Number of words, 0 for null."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, everything else as it is."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def unit(key: Column, digits: int = 53) -> Column:
    """A 64-bit hash as a number from 0 up to, not including, 1."""
    return F.shiftrightunsigned(key, 64 - digits).cast("double") / F.lit(float(1 << digits))


def ranked(df: DataFrame, name: str, *order: Column, label: str = "ranked") -> DataFrame:
    """``df`` with gapless ranks from 0 in ``order``; no task sees all rows.

    Rows are range-partitioned and written; ranks are the place within a part
    plus the rows of the parts before it.
    """
    from pyspark.sql import Window

    part = "__part"
    stored = pinned(df.repartitionByRange(*order).withColumn(part, F.spark_partition_id()), label)
    counts = sorted(stored.groupBy(part).count().collect())  # one number for each part
    before, total = {}, 0
    for at, n in counts:
        before[at] = total
        total += n
    starts = of_driver(
        df.sparkSession,
        **{part: pa.array(before.keys(), pa.int32()), "__start": pa.array(before.values(), pa.int64())},
    )
    place = F.row_number().over(Window.partitionBy(part).orderBy(*order)) - 1
    return (
        stored.withColumn(name, place.cast("long"))
        .join(F.broadcast(starts), part)
        .withColumn(name, F.col(name) + F.col("__start"))
        .drop(part, "__start")
    )


def with_fields(schema: T.StructType, *fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([*schema.fields, *(T.StructField(n, t) for n, t in fields)])
