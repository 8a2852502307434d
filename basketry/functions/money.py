"""Money expressions: doubles rounded half-even, summed exactly."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_even(col: Column, places: int) -> Column:
    """Scale, round half to even, unscale: the rounding numpy applies to doubles.

    Spark's own ``round`` and ``bround`` work on the decimal text and differ on some values.
    """
    factor = float(10**places)
    return F.rint(col * factor) / factor


def as_exact(col: Column) -> Column:
    """A money double (at most 4 decimals) as a decimal, so that sums do not depend on row order.

    An amount that does not fit fails the run, in ANSI mode or not.
    """
    exact = col.try_cast("decimal(18,4)")
    lost = F.concat(F.lit("amount is too large to sum exactly: "), col.cast("string"))
    return F.when(col.isNotNull() & exact.isNull(), F.raise_error(lost)).otherwise(exact)


def exact_sum(col: Column) -> Column:
    return F.sum(as_exact(col))


def share_pct(part: Column, whole: Column) -> Column:
    """100 * part / whole on doubles."""
    return F.lit(100.0) * part.cast("double") / whole.cast("double")
