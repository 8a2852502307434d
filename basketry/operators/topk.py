"""Top-k by value for a k that grows with the data."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_WIDE = "decimal(38,6)"


def kth_largest(df: DataFrame, value: str, k: int, *, buckets: int = 1024) -> Decimal:
    """The ``k``-th largest of an exact decimal column (at most 6 places); ``1 <= k <= rows``.

    A sort with a limit would bring all k rows into one task. Instead the value range that must
    hold the answer is cut into buckets, each round one map-side combined count of at most
    ``buckets`` groups, until one value is left in it. Every round narrows the range about
    ``buckets`` times, so money values need a handful of rounds at most.

    ``df`` is read once per round: stage it first.
    """
    column = F.col(value).cast(_WIDE)
    low, high = df.agg(F.min(column), F.max(column)).first()
    rank = k  # rank of the answer within [low, high]
    while low < high:
        inside = df.select(column.alias("v")).filter(F.col("v").between(F.lit(low), F.lit(high)))
        width = (high - low) / buckets
        # Any non-decreasing numbering of the values will do, so rounding here is harmless.
        number = F.floor((F.col("v") - F.lit(low)).cast("double") / F.lit(float(width)))
        counts = (
            inside.groupBy(F.least(number, F.lit(buckets)).alias("bucket"))
            .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
            .orderBy(F.desc("bucket"))
            .collect()
        )
        for bucket in counts:
            if rank <= bucket["n"]:
                break
            rank -= bucket["n"]
        low, high = bucket["low"], bucket["high"]
    return low


def sum_down_to(value: str, kth: Column, k: Column) -> Column:
    """Sum of the ``k`` largest, given the ``k``-th: ties with it count as often as they fit."""
    column = F.col(value).cast(_WIDE)
    above = column > kth
    ties = (k - F.count_if(above)).cast("decimal(18,0)")
    return F.coalesce(F.sum(F.when(above, column)), F.lit(0)) + ties * kth
