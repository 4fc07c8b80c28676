"""Registration and what the sections share.

SQL starts from the common tables of ``BASE``: ``t`` raw transactions, ``n``
standardised and masked, ``z`` with type statistics. Text of amounts and ratios
goes out as double; values that depend on the order of floating-point sums are
rounded to four places in both engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywatch.sources.events import TXN_SQL

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

SALT = "registered-query-salt"
FIRST_RUN, SECOND_RUN = "2025-01-16 00:00:00", "2025-02-01 00:00:00"
SPLIT_STEP = 360

ACCT = f"sha256(upper(trim(nameOrig)) || '{SALT}')"
DEST = f"sha256(upper(trim(nameDest)) || '{SALT}')"

BASE = f"""with t as ({TXN_SQL.format(events="events")}),
n as (
  select txn_id, step, upper(trim(type)) as type, amount, {ACCT} as acct, {DEST} as dest, nameDest,
    oldbalanceOrg, newbalanceOrig, oldbalanceDest, newbalanceDest, isFraud, isFlaggedFraud,
    abs(oldbalanceOrg - amount - newbalanceOrig) as gap,
    case when abs(oldbalanceOrg - amount - newbalanceOrig) < 0.01 then 1 else 0 end as math_ok
  from t),
st as (
  select type, cast(sum(amount) as double) / nullif(count(amount), 0) as mu,
    stddev_samp(cast(amount as double)) as sd, count(amount) as cnt
  from n group by type),
z as (
  select n.*, mu, case when sd > 0 then (cast(amount as double) - mu) / sd end as z_score
  from n left join st on n.type = st.type)
"""


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Add a query under ``name``; ``sql`` continues ``BASE`` (or is complete)."""

    def add(query: Query) -> Query:
        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = sql if sql.lstrip().startswith("with t as") else BASE + sql
        return query

    return add


def dbl(col: str | Column) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("double")


def big(col: str | Column) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("long")


def rnd(col: str | Column, places: int = 4) -> Column:
    return F.round(dbl(col), places)


def sql_rnd(expression: str, places: int = 4) -> str:
    """The same rounding in SQL: half away from zero on the digits of the number."""
    digits = f"cast(cast({expression} as varchar) as decimal(38,18))"
    return f"cast(round({digits}, {places}) as double)"
