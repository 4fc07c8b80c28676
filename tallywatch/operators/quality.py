"""Gates, quarantine, audit notes and reconciliation.

Checks that need several counts take them in one aggregate over the table.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywatch import rules
from tallywatch.functions.exprs import flag, holds, ratio


class IntegrityError(Exception):
    """A gate or reconciliation check failed."""


class Split(NamedTuple):
    kept: DataFrame
    rejected: DataFrame


# -- gates --------------------------------------------------------------------


def gate(
    df: DataFrame,
    cols: Sequence[str] = ("amount", "type"),
    threshold: float = rules.NULL_RATIO_LIMIT,
) -> DataFrame:
    """One row: rows, rows with a null in any of ``cols``, ratio, verdict.

    Fails on an empty input and on a ratio above (not at) the threshold.
    """
    missing = F.lit(False)
    for name in cols:
        missing = missing | F.col(name).isNull()
    counted = df.agg(
        F.count(F.lit(1)).alias("row_count"), F.count_if(missing).alias("null_count")
    )
    return counted.withColumns(
        {
            "null_ratio": ratio(F.col("null_count"), F.col("row_count")),
            "is_empty": F.col("row_count") == 0,
        }
    ).withColumn("passes", holds(F.col("null_ratio") <= threshold))


def enforce_gate(report: DataFrame) -> None:
    """Raise when the one-row report of ``gate`` does not pass."""
    row = report.first()
    if row["is_empty"]:
        raise IntegrityError("input is empty")
    if not row["passes"]:
        raise IntegrityError(f"null ratio {row['null_ratio']:.2%} above the limit")


def count_invalid(df: DataFrame, predicate: Column | None = None) -> DataFrame:
    """One row with the number of rows that satisfy ``predicate`` (amount < 0)."""
    if predicate is None:
        predicate = F.col("amount") < 0
    return df.agg(F.count_if(predicate).alias("invalid_count"))


def null_profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row with the share of nulls per column."""
    return df.agg(
        *[ratio(F.count_if(F.col(c).isNull()), F.count(F.lit(1))).alias(c) for c in cols]
    )


# -- quarantine ----------------------------------------------------------------


def add_reason(
    df: DataFrame, key_inputs: Sequence[str] = ("step",), account: str = "nameOrig_hashed"
) -> DataFrame:
    """``quarantine_reason``: why the row may not enter the gold layer, else null.

    A hash key is never null, so the test is on the columns it is made of.
    """
    no_key = F.lit(False)
    for name in key_inputs:
        no_key = no_key | F.col(name).isNull()
    amount = F.col("amount")
    return df.withColumn(
        "quarantine_reason",
        F.when(no_key, rules.REASON_KEY)
        .when(amount.isNull(), rules.REASON_NO_AMOUNT)
        .when(amount <= 0, rules.REASON_AMOUNT)
        .when(F.col(account).isNull(), rules.REASON_ACCOUNT),
    )


def split_valid(
    df: DataFrame, key_inputs: Sequence[str] = ("step",), account: str = "nameOrig_hashed"
) -> Split:
    """Valid rows, and quarantined rows with their reason; together the input."""
    tagged = add_reason(df, key_inputs, account)
    reason = F.col("quarantine_reason")
    return Split(
        tagged.filter(reason.isNull()).drop("quarantine_reason"), tagged.filter(reason.isNotNull())
    )


def split_by(df: DataFrame, predicate: Column, reason: str = rules.REASON_OTHER) -> Split:
    """The same for one predicate; rows where it is unknown are rejected."""
    ok = holds(predicate)
    rejected = df.filter(~ok).withColumn("quarantine_reason", F.lit(reason))
    return Split(df.filter(ok), rejected)


def logical_errors(
    df: DataFrame, lo: int = rules.STEP_LOW, hi: int = rules.STEP_HIGH
) -> DataFrame:
    """Flag rows whose transfer raised the balance or whose step is out of range."""
    return df.withColumn("has_logical_error", flag(_balance_rose() | _step_outside(lo, hi)))


def audit_note(
    df: DataFrame, lo: int = rules.STEP_LOW, hi: int = rules.STEP_HIGH
) -> DataFrame:
    """All warnings of the row, joined; empty text for a clean row."""
    notes = [
        F.when(_balance_rose(), rules.NOTE_BALANCE),
        F.when(_step_outside(lo, hi), rules.NOTE_STEP),
    ]
    return df.withColumn("audit_note", F.concat_ws(rules.NOTE_SEPARATOR, *notes))


def _balance_rose() -> Column:
    return (F.col("type") == "TRANSFER") & (F.col("newbalanceOrig") > F.col("oldbalanceOrg"))


def _step_outside(lo: int, hi: int) -> Column:
    return ~F.col("step").between(lo, hi)


def score_bounds(
    df: DataFrame, col: str = "total_risk_score", lo: float = 0, hi: float = 100
) -> DataFrame:
    """Flag scores outside [lo, hi]; needs a numeric score."""
    return df.withColumn("risk_score_out_of_bounds", flag(~F.col(col).between(lo, hi)))


def split_sane(df: DataFrame, z_max: float = rules.SANE_Z) -> Split:
    """Rows with a z-score within bounds; the rest goes to audit with a reason."""
    z = F.col("z_score")
    tagged = df.withColumn("is_mathematically_sane", flag(F.abs(z) <= z_max))
    sane = F.col("is_mathematically_sane") == 1
    reason = F.when(z.isNull(), "no variance").otherwise("z-score out of bounds")
    return Split(tagged.filter(sane), tagged.filter(~sane).withColumn("audit_reason", reason))


# -- keys -----------------------------------------------------------------------


def dedupe(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the first by ``order``, which should end in a unique column."""
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rn", first).filter(F.col("__rn") == 1).drop("__rn")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counts.filter(F.col("n") > 1)


def has_duplicates(df: DataFrame, keys: Sequence[str]) -> bool:
    """True when some key occurs more than once; fetches at most one row."""
    return bool(duplicate_keys(df, keys).take(1))


def missing_rows(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``a`` whose key is absent from ``b``."""
    # distinct first, so a frequent key of ``b`` moves once per task
    return a.join(b.select(*keys).distinct(), list(keys), "left_anti")


# -- reconciliation ---------------------------------------------------------------


def reconcile(
    silver: DataFrame,
    fact: DataFrame,
    dim: DataFrame,
    key: str = "nameOrig_hashed",
) -> DataFrame:
    """One row comparing layers: rows, amounts, filtered rows, orphans, verdict.

    Orphans are fact rows whose account is not in the dimension. They are counted
    per account before the join, so a frequent account is one row there.
    """
    zero = F.lit(0).cast("decimal(18,2)")

    def layer(name: str, rows: Column, amount: Column, df: DataFrame) -> DataFrame:
        per_layer = df.agg(
            F.coalesce(rows, F.lit(0)).alias("n"),
            F.coalesce(F.sum(amount), zero).cast("decimal(38,2)").alias("total"),
        )
        return per_layer.withColumn("layer", F.lit(name))

    per_account = fact.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    orphans = missing_rows(per_account, dim, [key])
    amount, every = F.col("amount"), F.count(F.lit(1))
    stacked = (
        layer("silver", every, amount, silver)
        .unionByName(layer("fact", every, amount, fact))
        .unionByName(layer("orphan", F.sum("n"), zero, orphans))
    )

    def pick(name: str, value: str) -> Column:
        return F.max(F.when(F.col("layer") == name, F.col(value)))

    report = stacked.agg(
        pick("silver", "n").alias("silver_rows"),
        pick("fact", "n").alias("fact_rows"),
        pick("silver", "total").alias("silver_amount"),
        pick("fact", "total").alias("fact_amount"),
        pick("orphan", "n").alias("orphan_rows"),
    )
    return report.withColumns(
        {
            "filtered_rows": F.col("silver_rows") - F.col("fact_rows"),
            "amount_diff": F.abs(F.col("silver_amount") - F.col("fact_amount")),
            "passes": (F.col("orphan_rows") == 0) & (F.col("fact_rows") <= F.col("silver_rows")),
        }
    )


def diverted(
    silver: DataFrame, fact: DataFrame, quarantine: DataFrame, failures: DataFrame
) -> DataFrame:
    """One row: what left between two layers, and whether all of it is accounted for.

    ``quarantine`` and ``failures`` are the stored tables of rows that were put aside;
    ``explained`` says that they and the fact make up the layer before.
    """
    layers = {"silver": silver, "fact": fact, "quarantined": quarantine, "failed": failures}
    counted = None
    for name, df in layers.items():
        one = df.agg(F.count(F.lit(1)).alias("n")).withColumn("layer", F.lit(name))
        counted = one if counted is None else counted.unionByName(one)
    out = counted.agg(
        *[F.max(F.when(F.col("layer") == n, F.col("n"))).alias(f"{n}_rows") for n in layers]
    )
    left = F.col("silver_rows") - F.col("fact_rows")
    return out.withColumn("explained", left == F.col("quarantined_rows") + F.col("failed_rows"))


def enforce(report: DataFrame) -> None:
    """Raise when the one-row report of ``reconcile`` does not pass."""
    row = report.first()
    if not row["passes"]:
        raise IntegrityError(
            f"{row['orphan_rows']} orphans, {row['fact_rows']} fact rows "
            f"against {row['silver_rows']} silver rows"
        )
