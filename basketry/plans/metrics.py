"""What a run reports about its inputs, besides the quality of the fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.aggregates import one_row
from basketry.functions.times import utc_day
from basketry.operators.clean import counter_metrics
from basketry.operators.enrich import country_join_misses, with_country_key
from basketry.operators.fx import fx_asof
from basketry.session import stage
from basketry.sources.reference import fx_rate_stats


def run_metrics(
    sales: DataFrame, countries_norm: DataFrame, fx: DataFrame, countries_bytes: int | None = None
) -> DataFrame:
    """One row: country misses, lines at the fallback rate and that rate, days without a rate, rate figures.

    The sales are read once and combined per day and country before they are shuffled; that roll-up is staged, as days and
    countries are both looked up in it.
    """
    day = utc_day(F.col("InvoiceDate")).alias("invoice_day")
    rollup = stage(sales.groupBy(day, "Country").agg(counter_metrics()["rows_out"].alias("lines")), "rollup")
    per_day = rollup.groupBy("invoice_day").agg(F.sum("lines").alias("lines"))
    rated = fx_asof(per_day, fx).join(
        fx.select(F.col("date").alias("invoice_day"), F.lit(True).alias("landed")).distinct(), "invoice_day", "left"
    )
    days = one_row(
        rated,
        fallback_lines=F.coalesce(F.sum(F.when(F.col("is_fallback"), F.col("lines"))), F.lit(0)),
        days_needed=F.count("invoice_day"),
        days_missing=F.count_if(F.col("landed").isNull() & F.col("invoice_day").isNotNull()),
    )
    misses = country_join_misses(
        with_country_key(rollup), countries_norm, side_bytes=countries_bytes, lines=F.col("lines")
    )
    return days.withColumns(
        {
            "misses": misses.select(F.struct("*")).scalar(),
            "rates": fx_rate_stats(fx).select(F.struct("*")).scalar(),
            "fallback_rate": fx.agg(F.median(F.when(~F.isnan("fx_rate_gbp_eur"), F.col("fx_rate_gbp_eur")))).scalar(),
        }
    ).select("misses.*", "fallback_lines", "fallback_rate", "days_needed", "days_missing", "rates.*")
