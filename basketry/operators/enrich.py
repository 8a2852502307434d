"""Text normalization and country enrichment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.functions.text import lookup, strip_lower
from basketry.functions.aggregates import one_row
from basketry.schemas import COUNTRY_ALIASES, UNMATCHED_REGION

BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024


def normalize_sales(sales: DataFrame) -> DataFrame:
    """Strip and lower-case country and customer; add the join key with aliases resolved."""
    return with_country_key(sales.withColumn("CustomerID", strip_lower(F.col("CustomerID"))))


def with_country_key(df: DataFrame) -> DataFrame:
    return df.withColumn("Country", strip_lower(F.col("Country"))).withColumn(
        "country_key", lookup(F.col("Country"), COUNTRY_ALIASES)
    )


def normalize_countries(countries: DataFrame) -> DataFrame:
    return countries.select(strip_lower(F.col("country")).alias("country_key"), "region", "population")


def data_bytes(df: DataFrame) -> int:
    """Size of the rows of ``df``, summed on the executors: text at its length, the rest at 8 bytes."""
    widths = [
        F.coalesce(F.octet_length(field.name), F.lit(0)) + 16
        if isinstance(field.dataType, T.StringType)
        else F.lit(8)
        for field in df.schema
    ]
    width = sum(widths[1:], widths[0]).cast("bigint")
    return df.agg(F.coalesce(F.sum(width), F.lit(0))).first()[0]


def _join_countries(sales: DataFrame, countries: DataFrame, limit_bytes: int, side_bytes: int | None) -> DataFrame:
    """Left join that keeps every line.

    The countries side is measured, unless the caller has: within the limit it is broadcast and sales are
    not shuffled at all. Beyond it both sides are shuffled, and adaptive execution splits the partition
    of a country that holds a large part of the lines.
    """
    size = data_bytes(countries) if side_bytes is None else side_bytes
    side = F.broadcast(countries) if size <= limit_bytes else countries
    return sales.join(side, "country_key", "left")


def enrich_with_countries(
    sales: DataFrame,
    countries: DataFrame,
    limit_bytes: int = BROADCAST_LIMIT_BYTES,
    side_bytes: int | None = None,
) -> DataFrame:
    """Add region and population; lines without a match get ``unknown`` and 0.

    A key given twice on the countries side multiplies its lines; ``check_unique_countries`` refuses that.
    ``side_bytes``: what ``data_bytes`` gave for the countries, so that one run measures them once.
    """
    return _join_countries(sales, countries, limit_bytes, side_bytes).withColumns(
        {
            "region": F.coalesce("region", F.lit(UNMATCHED_REGION)),
            "population": F.coalesce("population", F.lit(0)).cast("bigint"),
        }
    )


def country_join_misses(
    sales: DataFrame,
    countries: DataFrame,
    limit_bytes: int = BROADCAST_LIMIT_BYTES,
    side_bytes: int | None = None,
    lines: Column | None = None,
) -> DataFrame:
    """Lines that end up without a region, out of all joined lines; ``lines``: how many a row stands for."""
    n = F.lit(1) if lines is None else lines
    return one_row(
        _join_countries(sales, countries, limit_bytes, side_bytes),
        unmatched_rows=F.coalesce(F.sum(F.when(F.col("region").isNull(), n)), F.lit(0)).cast("bigint"),
        total_rows=F.coalesce(F.sum(n), F.lit(0)).cast("bigint"),
    )
