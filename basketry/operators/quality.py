"""Data-quality report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.money import as_exact, exact_sum, round_half_even
from basketry.functions.aggregates import one_row
from basketry.schemas import UNMATCHED_REGION


def _fact_metrics(fact: DataFrame) -> DataFrame:
    """Metrics of the fact in one scan.

    Lines are first rolled up per invoice, customer and country, combined on the map side. The
    three exact distinct counts, which copy their input once each, then run on the roll-up.
    """
    revenue = F.col("revenue_eur")
    rollup = fact.groupBy("invoice_no", "customer_id", "country").agg(
        F.count_if(F.col("region") == UNMATCHED_REGION).alias("unknown"),
        exact_sum(revenue).alias("total"),
        F.min(revenue).alias("low"),
        F.max(revenue).alias("high"),
    )
    return one_row(
        rollup,
        rows_with_unknown_region=F.coalesce(F.sum("unknown"), F.lit(0)),
        unique_customers=F.count_distinct("customer_id"),
        unique_invoices=F.count_distinct("invoice_no"),
        unique_countries=F.count_distinct("country"),
        revenue_eur_total=round_half_even(F.coalesce(F.sum("total").cast("double"), F.lit(0.0)), 2),
        revenue_eur_min=round_half_even(as_exact(F.min("low")).cast("double"), 2),
        revenue_eur_max=round_half_even(as_exact(F.max("high")).cast("double"), 2),
    )


def build_quality_report(counters: DataFrame, fact: DataFrame) -> DataFrame:
    """One row with 14 metrics from the cleaning counters (one row) and the fact."""
    metrics = _fact_metrics(fact)
    total = F.greatest("rows_in", F.lit(1))

    def pct(name: str):
        return round_half_even(F.lit(100) * F.col(name) / total, 2)

    return counters.withColumn("fact", metrics.select(F.struct("*")).scalar()).select(
        F.col("rows_in").alias("rows_input"),
        F.col("rows_out").alias("rows_output"),
        pct("rows_out").alias("kept_pct"),
        "dropped_missing_customer_id",
        pct("dropped_missing_customer_id").alias("dropped_missing_customer_id_pct"),
        "dropped_non_positive_quantity",
        "dropped_non_positive_price",
        "fact.*",
    )
