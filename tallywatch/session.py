"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.ui.enabled": "false",
    # no call-site capture for every column built: plans here have hundreds
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "tallywatch", **settings: str) -> SparkSession:
    """A session with the settings the library is tested under.

    Pass further settings with ``_`` for ``.``: ``spark_sql_shuffle_partitions``.
    """
    builder = SparkSession.builder.appName(app)
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    for name, value in settings.items():
        builder = builder.config(name.replace("_", "."), str(value))
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder under the session's shared ``spark.checkpoint.dir``.

    Only a local session may go without that setting; it then gets a temporary
    folder of its own, which it keeps using.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="tallywatch-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def pinned(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table written to the shared folder.

    For results that another run of the same plan may give differently (an
    approximate percentile depends on the order partial results arrive in) and
    that several parts of a query must agree on, lost executors or not.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
