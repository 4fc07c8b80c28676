"""Explicit schemas of the layers; nothing in the library infers one."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
CORRUPT = "_corrupt_record"

RAW = T.StructType(
    [
        T.StructField("txn_id", T.LongType()),
        T.StructField("step", T.IntegerType()),
        T.StructField("type", T.StringType()),
        T.StructField("amount", MONEY),
        T.StructField("nameOrig", T.StringType()),
        T.StructField("oldbalanceOrg", MONEY),
        T.StructField("newbalanceOrig", MONEY),
        T.StructField("nameDest", T.StringType()),
        T.StructField("oldbalanceDest", MONEY),
        T.StructField("newbalanceDest", MONEY),
        T.StructField("isFraud", T.IntegerType()),
        T.StructField("isFlaggedFraud", T.IntegerType()),
    ]
)

# The columns of the source files that bring no id of their own.
SOURCE = T.StructType([f for f in RAW.fields if f.name != "txn_id"])

# RAW with a column that receives the text of malformed CSV lines.
LANDING = T.StructType([*RAW.fields, T.StructField(CORRUPT, T.StringType())])

DIM_ACCOUNT = T.StructType(
    [
        T.StructField("account_sk", T.LongType()),
        T.StructField("nameOrig_hashed", T.StringType()),
        T.StructField("customer_segment", T.StringType()),
        T.StructField("account_activity", T.StringType()),
        T.StructField("account_audit_status", T.StringType()),
        T.StructField("is_current", T.BooleanType()),
        T.StructField("start_date", T.TimestampType()),
        T.StructField("end_date", T.TimestampType()),
    ]
)
