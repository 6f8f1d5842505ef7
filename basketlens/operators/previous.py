"""Previous-row values along a time axis without sorting the whole axis in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_previous(
    df: DataFrame,
    order: str,
    values: dict[str, str],
    bucket: Column,
    by: Sequence[str] = (),
) -> DataFrame:
    """Add ``values`` (new name -> source column) taken from the row before, along ``order``.

    Rows are sorted inside ``bucket`` (a coarse, order-preserving piece of the axis, such as the
    month). The first row of a bucket takes the last row of the bucket before it, which needs
    one row per bucket only. ``order`` must be unique within ``by``.
    """
    by = list(by)
    source = F.struct(*[F.col(c).alias(n) for n, c in values.items()])
    keyed = df.withColumn("_bucket", bucket)
    inside = Window.partitionBy(*by, "_bucket").orderBy(order)
    across = Window.partitionBy(*by).orderBy("_bucket")

    lasts = keyed.groupBy(*by, "_bucket").agg(F.max_by(source, F.col(order)).alias("_last"))
    carried = lasts.select(*by, "_bucket", F.lag("_last").over(across).alias("_carried"))

    previous = F.coalesce("_before", "_carried")
    return (
        keyed.withColumn("_before", F.lag(source).over(inside))
        .join(carried, [*by, "_bucket"], "left")
        .select(*df.columns, *[previous[n].alias(n) for n in values])
    )


def growth_percent(current: Column, previous: Column) -> Column:
    """Change against ``previous`` in percent; 0 where there is no positive previous value."""
    now, before = current.cast("double"), previous.cast("double")
    return F.when(before > 0, (now - before) / before * 100).otherwise(F.lit(0.0))
