"""Currency conversion with a backward as-of join on the invoice day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basketry.functions.money import round_half_even
from basketry.functions.times import utc_day
from basketry.functions.aggregates import one_row

_RATE = "fx_rate_gbp_eur"


def fx_calendar(fx: DataFrame) -> DataFrame:
    """Rate table -> one row per calendar day from the first to the last rated day.

    Each rate holds until the day before the next one, a missing rate too: the as-of rule takes the
    latest *row*, not the latest known rate. A day listed twice fails.

    At most one row per calendar day comes out, whatever comes in, so the single ordered window and
    the broadcast of the result are bounded by the calendar (about 3.7 million days from year 1 to
    9999; some thousands in practice) and do not grow with the sales.
    """
    several = F.concat(F.lit("FX date has several rates: "), F.col("date").cast("string"))
    daily = (
        fx.filter(F.col("date").isNotNull())
        .groupBy("date")
        .agg(F.count(F.lit(1)).alias("n"), F.max(_RATE).alias(_RATE))
        .withColumn(_RATE, F.when(F.col("n") > 1, F.raise_error(several)).otherwise(F.col(_RATE)))
    )
    until = F.coalesce(F.date_sub(F.lead("date").over(W.orderBy("date")), 1), F.col("date"))
    return daily.withColumn("until", until).select(
        F.explode(F.sequence("date", "until")).alias("fx_day"),
        F.when(~F.isnan(_RATE), F.col(_RATE)).alias(_RATE),
    )


def _table_figures(fx: DataFrame) -> Column:
    """Last rated day and median rate, from one pass over the rate table.

    The median counts each rate once; it is not weighted by lines.
    """
    rate = F.when(~F.isnan(_RATE), F.col(_RATE))
    return fx.agg(F.struct(F.max("date").alias("last_day"), F.median(rate).alias("median"))).scalar()


def _median_rate(fx: DataFrame) -> Column:
    return _table_figures(fx)["median"]


def asof_rate(df: DataFrame, fx: DataFrame, day: Column) -> DataFrame:
    """Add the rate of the latest rated day not after ``day``, null where there is none.

    Days after the last rated one are looked up as that one, so the lookup is a plain hash join:
    no range condition, no second scan for the days in use, no shuffle of ``df``.
    """
    # `least` skips nulls: a line without a day must not take the last day's rate.
    lookup = F.when(day.isNotNull(), F.least(day, _table_figures(fx)["last_day"]))
    return (
        df.withColumn("fx_day", lookup)
        .join(F.broadcast(fx_calendar(fx)), "fx_day", "left")
        .drop("fx_day")
    )


def fx_asof(days: DataFrame, fx: DataFrame) -> DataFrame:
    """Days with their rate, filled with the median of the rates where no earlier rate exists."""
    known = asof_rate(days, fx, F.col("invoice_day"))
    return known.withColumns(
        {
            _RATE: F.coalesce(F.col(_RATE), _median_rate(fx)),
            "is_fallback": F.col(_RATE).isNull(),
        }
    )


def apply_fx_historical(sales: DataFrame, fx: DataFrame) -> DataFrame:
    """Add revenue in GBP, the rate of the invoice day, and revenue in EUR, rounded to 4 places."""
    gbp = round_half_even(F.col("Quantity") * F.col("UnitPrice"), 4)
    rated = asof_rate(sales.withColumn("revenue_gbp", gbp), fx, utc_day(F.col("InvoiceDate")))
    return rated.withColumn(_RATE, F.coalesce(F.col(_RATE), _median_rate(fx))).withColumn(
        "revenue_eur", round_half_even(F.col("revenue_gbp") * F.col(_RATE), 4)
    )


def fx_fallback_rows(sales: DataFrame, fx: DataFrame) -> DataFrame:
    """How many lines take the median because no rate precedes them, and that median."""
    rated = asof_rate(sales, fx, utc_day(F.col("InvoiceDate")))
    return one_row(
        rated,
        missing_rows=F.count_if(F.col(_RATE).isNull()),
        total_rows=F.count(F.lit(1)),
    ).withColumn("fallback_rate", _median_rate(fx))


def invoice_days(sales: DataFrame) -> DataFrame:
    """Distinct days of the lines before cleaning: the days a rate is needed for."""
    return sales.select(utc_day(F.col("InvoiceDate")).alias("invoice_day")).distinct()


def fx_missing_days(sales: DataFrame, fx: DataFrame) -> DataFrame:
    """Needed days without a rate of their own: what is left to land."""
    return invoice_days(sales).join(fx.select(F.col("date").alias("invoice_day")), "invoice_day", "left_anti")
