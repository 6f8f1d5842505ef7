"""Order-independent arithmetic.

Sums of doubles depend on the order in which partitions are merged, so money and weights are
added as decimals and become doubles only when a ratio is taken.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
TOTAL = "decimal(38,2)"


def money(col: Column | str) -> Column:
    return _col(col).cast(MONEY)


def total(col: Column | str) -> Column:
    """Exact sum of a money expression."""
    return F.sum(_col(col)).cast(TOTAL)


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Division as double; null where the denominator is zero or null."""
    return F.try_divide(_col(numerator).cast("double"), _col(denominator).cast("double"))


def mean(col: Column | str) -> Column:
    """Average of an exact number: one exact sum divided once."""
    return ratio(F.sum(_col(col)), F.count(_col(col)))


def exact_sum(col: Column | str) -> Column:
    """Sum of doubles taken at twelve decimals, the same in whatever order rows arrive."""
    return F.sum(_col(col).cast("decimal(28,12)")).cast("double")


def exact_mean(col: Column | str) -> Column:
    return ratio(exact_sum(col), F.count(_col(col)))


def _col(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col
