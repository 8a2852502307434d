"""Data contracts: named conditions over one aggregate pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.functions.aggregates import one_row
from basketry.operators.clean import counter_metrics
from basketry.schemas import KEY, MAX_FX_RATE, MIN_FX_RATE


class ContractViolation(ValueError):
    """Data broke a declared contract."""


def expect(df: DataFrame, conditions: dict[str, Column]) -> None:
    """Raise unless every aggregate condition holds; all of them share one pass over ``df``."""
    labels = list(conditions)
    checks = [F.coalesce(conditions[label], F.lit(False)).alias(f"c{i}") for i, label in enumerate(labels)]
    verdicts = df.agg(*checks).first()
    broken = [label for label, holds in zip(labels, verdicts) if not holds]
    if broken:
        raise ContractViolation("; ".join(broken))


def gap_metrics() -> dict[str, Column]:
    """Lines that lack what the extract's types declare: quantity and time are never missing."""
    return {
        "sales_without_quantity": F.count_if(F.col("Quantity").isNull()),
        "sales_without_date": F.count_if(F.col("InvoiceDate").isNull()),
    }


def check_gaps(counted: dict[str, int]) -> None:
    """``counted`` holds the values of ``gap_metrics``, among others."""
    columns = {"sales_without_quantity": "Quantity", "sales_without_date": "InvoiceDate"}
    broken = [f"{column} has missing values" for name, column in columns.items() if counted[name]]
    if broken:
        raise ContractViolation("; ".join(broken))


def check_sales(sales: DataFrame) -> DataFrame:
    check_gaps(one_row(sales, **gap_metrics()).first().asDict())
    return sales


def duplicate_keys(fact: DataFrame) -> DataFrame:
    """Business keys held by more than one row, with their number of rows."""
    return fact.groupBy(*KEY).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def check_unique_countries(countries_norm: DataFrame) -> DataFrame:
    """Two entries of one normalized name would double the lines of that country."""
    key = F.col("country_key")
    expect(countries_norm, {"country names collide after normalizing": F.count_distinct(key) == F.count(key)})
    return countries_norm


def check_accounts(counters: dict[str, int], fact_lines: int) -> None:
    """Every line read is kept or dropped by one rule, and every kept line is one line of the fact."""
    parts = sum(n for name, n in counters.items() if name == "rows_out" or name.startswith("dropped"))
    if parts != counters["rows_in"]:
        raise ContractViolation(f"{counters['rows_in']} lines read, but {parts} kept or dropped")
    if fact_lines != counters["rows_out"]:
        raise ContractViolation(f"{counters['rows_out']} lines kept, but {fact_lines} in the fact")


def check_unique_key(fact: DataFrame) -> DataFrame:
    expect(duplicate_keys(fact), {"business key is not unique": F.count(F.lit(1)) == 0})
    return fact


def contract_report(sales: DataFrame, countries: DataFrame, fx: DataFrame, fact: DataFrame) -> DataFrame:
    """All contracts as counts in one row, for a report that does not stop the run.

    One scan of the sales and one of the fact, however many contracts there are.
    """
    rate = F.col("fx_rate_gbp_eur")
    in_bounds = F.coalesce(~F.isnan(rate) & rate.between(MIN_FX_RATE, MAX_FX_RATE), F.lit(False))
    metrics = counter_metrics()
    accounted = sum((F.col(name) for name in metrics if name != "rows_in"), F.lit(0))
    keys = fact.groupBy(*KEY).agg(F.count(F.lit(1)).alias("rows"))
    return (
        one_row(
            sales,
            **metrics,
            **gap_metrics(),
        )
        .withColumns(
            {
                "countries_found": countries.agg(F.count(F.lit(1))).scalar(),
                "fx": fx.agg(
                    F.struct(
                        F.count_if(~in_bounds).alias("out_of_bounds"),
                        (F.count("date") - F.count_distinct("date")).alias("repeated"),
                    )
                ).scalar(),
                "keys": keys.agg(
                    F.struct(
                        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
                        F.count_if(F.col("rows") > 1).alias("repeated"),
                    )
                ).scalar(),
            }
        )
        .select(
            "sales_without_quantity",
            "sales_without_date",
            "countries_found",
            F.col("fx.out_of_bounds").alias("fx_out_of_bounds"),
            F.col("fx.repeated").alias("fx_days_repeated"),
            (F.col("rows_in") - accounted).alias("lines_unaccounted"),
            (F.col("rows_out") - F.col("keys.rows")).alias("lines_lost_in_join"),
            F.col("keys.repeated").alias("keys_repeated"),
        )
    )
