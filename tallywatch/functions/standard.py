"""Standardising, masking and keys: one projection, no shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywatch import rules
from tallywatch.schemas import RAW

_BOOLEANS = ("isFraud", "isFlaggedFraud", "is_pii_flag")
_TIMESTAMPS = ("ingestion_timestamp",)


def normalize(df: DataFrame) -> DataFrame:
    """Trim and upper-case ``type``; give every known column its silver type.

    Values that do not parse become null and are left to the gates.
    """
    types = {f.name: f.dataType for f in RAW.fields}
    changed = {}
    for name in df.columns:
        if name == "type":
            changed[name] = F.upper(F.trim(F.col(name)))
        elif name in _BOOLEANS:
            changed[name] = F.col(name).try_cast("boolean")
        elif name in _TIMESTAMPS:
            changed[name] = F.col(name).try_cast("timestamp")
        elif name in types:
            changed[name] = F.col(name).try_cast(types[name])
    return df.withColumns(changed)


def mask(
    df: DataFrame,
    salt: str,
    cols: Sequence[str] = ("nameOrig", "nameDest"),
    *,
    clean: bool = True,
    drop: bool = True,
) -> DataFrame:
    """Add ``<col>_hashed``, the salted SHA-256 of each identifier.

    ``clean`` trims and upper-cases first; ``drop`` removes the raw column. An
    empty salt gives the plain hash. Null stays null. The salt has no default:
    take it from configuration.
    """
    hashed = {}
    for name in cols:
        text = F.col(name).cast("string")
        if clean:
            text = F.upper(F.trim(text))
        hashed[f"{name}_hashed"] = F.sha2(F.concat(text, F.lit(salt)), 256)
    out = df.withColumns(hashed)
    return out.drop(*cols) if drop else out


def surrogate_key(
    df: DataFrame,
    cols: Sequence[str] = ("step", "nameOrig_hashed", "amount"),
    name: str = "transaction_sk",
) -> DataFrame:
    """64-bit hash key. It is never null, so null tests belong on ``cols``."""
    return df.withColumn(name, F.xxhash64(*cols))


def fingerprint(df: DataFrame, cols: Sequence[str], name: str = "row_fingerprint") -> DataFrame:
    """SHA-256 over the joined text of ``cols``; nulls are skipped."""
    texts = [F.col(c).cast("string") for c in cols]
    return df.withColumn(name, F.sha2(F.concat_ws(rules.FINGERPRINT_SEPARATOR, *texts), 256))


def impute(df: DataFrame, values: Mapping[str, float] = rules.FEATURE_DEFAULTS) -> DataFrame:
    """Replace nulls by the given value per column."""
    return df.fillna(dict(values))


def add_exec_cols(df: DataFrame) -> DataFrame:
    """Application id and partition id. For tracing only: never part of a key."""
    app = df.sparkSession.sparkContext.applicationId
    return df.withColumns({"spark_job_id": F.lit(app), "partition_id": F.spark_partition_id()})
