"""Classifying expressions: value segments, recency weights, weekdays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from basketlens.params import HIGH_LABEL, LOW_LABEL, MEDIUM_LABEL

# Age limit in days and the weight up to it; older interactions get the last weight.
RECENCY_WEIGHTS = ((30, "1.0"), (90, "0.8"), (180, "0.6"))
OLDEST_WEIGHT = "0.4"
WISHLIST_WEIGHT = "0.6"

WEIGHT = "decimal(2,1)"


def value_segment(
    spend: Column,
    high: int,
    medium: int,
    inclusive: bool = True,
    labels: tuple[str, str, str] = (HIGH_LABEL, MEDIUM_LABEL, LOW_LABEL),
) -> Column:
    """Segment by spend; unknown spend falls into the lowest segment."""

    def reaches(limit: int) -> Column:
        return spend >= limit if inclusive else spend > limit

    return F.when(reaches(high), labels[0]).when(reaches(medium), labels[1]).otherwise(labels[2])


def recency_weight(age_days: Column) -> Column:
    def weight(text: str) -> Column:
        return F.lit(text).cast(WEIGHT)

    expr = None
    for limit, text in RECENCY_WEIGHTS:
        young = age_days <= limit
        expr = F.when(young, weight(text)) if expr is None else expr.when(young, weight(text))
    return expr.otherwise(weight(OLDEST_WEIGHT))


def day_name(day: Column) -> Column:
    return F.date_format(day, "EEEE")


def is_weekend(day: Column) -> Column:
    return F.dayofweek(day).isin(1, 7)
