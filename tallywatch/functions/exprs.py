"""Small column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def above(value: Column, bands, otherwise: str) -> Column:
    """Label of the first band whose limit ``value`` exceeds (bands high to low)."""
    chain = F
    for limit, label in bands:
        chain = chain.when(value > limit, label)
    return chain.otherwise(otherwise)


def below(value: Column, bands, otherwise: str) -> Column:
    """Label of the first band whose limit ``value`` stays under (bands low to high)."""
    chain = F
    for limit, label in bands:
        chain = chain.when(value < limit, label)
    return chain.otherwise(otherwise)


def flag(condition: Column) -> Column:
    """1 where the condition is true, 0 where it is false or unknown."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def holds(condition: Column) -> Column:
    """True where the condition is true, false where it is false or unknown."""
    return F.coalesce(condition, F.lit(False))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as double; null where the denominator is 0 or null."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def mean(total: Column, count: Column) -> Column:
    """Average from an exact decimal sum and a count.

    Decimal sums do not depend on the order in which partitions are merged, so
    neither does an average taken this way.
    """
    return ratio(total, count)
