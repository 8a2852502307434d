"""Cleaning rules and their drop counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.functions.aggregates import one_row


def _has_customer() -> Column:
    return F.col("CustomerID").isNotNull()


def _positive_quantity() -> Column:
    return F.col("Quantity") > 0


def _positive_price() -> Column:
    """Spark orders NaN above every number."""
    return (F.col("UnitPrice") > 0) & ~F.isnan("UnitPrice")


def clean_sales(sales: DataFrame) -> DataFrame:
    """Keep lines with a customer, a positive quantity and a positive price.

    Plain comparisons, which drop nulls too and reach the Parquet scan.
    """
    return sales.filter(_has_customer() & _positive_quantity() & _positive_price())


def counter_metrics() -> dict[str, Column]:
    """Lines per rule, the first broken one counting; the parts add up to ``rows_in``."""
    # A null is a definite no here: it must fall into one of the parts.
    customer = _has_customer()
    quantity = F.coalesce(_positive_quantity(), F.lit(False))
    price = F.coalesce(_positive_price(), F.lit(False))
    return {
        "rows_in": F.count(F.lit(1)),
        "dropped_missing_customer_id": F.count_if(~customer),
        "dropped_non_positive_quantity": F.count_if(customer & ~quantity),
        "dropped_non_positive_price": F.count_if(customer & quantity & ~price),
        "rows_out": F.count_if(customer & quantity & price),
    }


def clean_counters(sales: DataFrame) -> DataFrame:
    """What the cleaning keeps and drops, in one pass over three columns.

    A run saves even that: it observes the same counters while it stages the lines.
    """
    return one_row(sales, **counter_metrics())
