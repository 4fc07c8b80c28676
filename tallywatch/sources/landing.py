"""Landed CSV files: one scan over all of them, with lineage."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywatch import rules
from tallywatch.schemas import CORRUPT, LANDING

CSV_ONLY = "*.csv"


def read_landing(
    spark: SparkSession,
    path: str,
    schema: T.StructType = LANDING,
    glob: str = CSV_ONLY,
) -> DataFrame:
    """All files in ``path`` that match ``glob``, as one table.

    Header, explicit schema, permissive: a value that does not parse becomes
    null and the text of its line goes to the corrupt-record column when the
    schema has one. A header that names other columns, or the same in another
    order, is an error and not silently read by position. A folder without a matching file gives an empty table,
    which the gate in ``operators.quality`` rejects.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("pathGlobFilter", glob)
        .csv(path)
    )


def add_txn_id(df: DataFrame, run_id: str, name: str = "txn_id") -> DataFrame:
    """Row id for files that bring none, as the tie-breaker of the windows.

    The run and the row's number in it, so no two rows of any runs share one; in one
    run the text sorts like the number. It depends on how files are split into tasks,
    so write the rows (bronze) before using it.
    """
    row = F.lpad(F.monotonically_increasing_id().cast("string"), 19, "0")
    return df.select(F.concat(F.lit(f"{run_id}-"), row).alias(name), "*")


def add_audit_cols(
    df: DataFrame, run_id: str, run_ts: str | dt.datetime, source: str | None = None
) -> DataFrame:
    """Load time, source file, status, PII flag and run id.

    For a file scan the source is the row's file; pass ``source`` otherwise.
    """
    origin = F.col("_metadata.file_path") if source is None else F.lit(source)
    return df.select(
        "*",
        F.lit(str(run_ts)).cast("timestamp").alias("ingestion_timestamp"),
        origin.alias("source_file"),
        F.lit(rules.STATUS_NEW).alias("status"),
        F.lit(True).alias("is_pii_flag"),
        F.lit(run_id).alias("job_run_id"),
    )
