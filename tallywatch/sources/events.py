"""The ``events`` test table seen as raw banking transactions.

One text for both engines: Spark and the SQL oracle run the same projection.
Null, negative and untrimmed values are planted by arithmetic on the id; every
row of the table becomes one transaction.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

EVENTS = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
)

TXN_SQL = """
select event_id as txn_id,
  cast((extract(day from ts) - 1) * 24 + extract(hour from ts) + 1 as int) as step,
  case when event_id % 13 = 0 then concat(' ', lower(ty), ' ') else ty end as type,
  case when event_id % 97 = 0 then cast(null as decimal(18,2))
       when event_id % 89 = 0 then cast(-amt as decimal(18,2)) else amt end as amount,
  case when event_id % 83 = 0 then null else concat('C', cast(user_id as string)) end as nameOrig,
  concat(case when event_id % 3 = 0 then 'M' else 'C' end, cast(event_id % 89 as string)) as nameDest,
  cast(case when event_id % 10 < 5 then amt when event_id % 10 < 8 then amt + k else k end
       as decimal(18,2)) as oldbalanceOrg,
  cast(case when event_id % 10 < 5 then 0 when event_id % 10 < 7 then k
            when event_id % 10 = 7 then k + 0.5 when event_id % 20 = 8 then k
            when event_id % 20 = 18 then k + 1000 else 0 end as decimal(18,2)) as newbalanceOrig,
  cast(case when event_id % 4 = 0 then 0 else k end as decimal(18,2)) as oldbalanceDest,
  cast(case when event_id % 4 = 0 then 0 else k + amt end as decimal(18,2)) as newbalanceDest,
  case when event_id % 10 = 0 and ty in ('TRANSFER', 'CASH_OUT') then 1 else 0 end as isFraud,
  case when amt > 1000000 then 1 else 0 end as isFlaggedFraud
from (select event_id, ts, user_id, event_id % 1000 as k,
        case when event_id % 50 = 0 then cast(100 * (event_id % 30 + 1) as decimal(18,2))
             else cast(value * 4000 as decimal(18,2)) end as amt,
        case event_type when 'purchase' then 'PAYMENT' when 'click' then 'CASH_OUT'
                        when 'view' then 'TRANSFER' when 'signup' then 'CASH_IN'
                        else 'DEBIT' end as ty
      from {events}) e
"""


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as raw transactions."""
    return spark.sql(TXN_SQL, events=read_events(spark, sf_dir))


def timed_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the event time ``ts``."""
    text = TXN_SQL.replace("select event_id as txn_id,", "select event_id as txn_id, ts,", 1)
    return spark.sql(text, events=read_events(spark, sf_dir))
