"""Reference data landed as JSON: countries and daily exchange rates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.functions.aggregates import one_row
from basketry.operators.contracts import expect
from basketry.schemas import MAX_FX_DAYS, MAX_FX_RATE, MIN_COUNTRIES, MIN_FX_RATE, REGION_NOT_GIVEN


def _country_records(spark: SparkSession, path: str) -> DataFrame:
    """One variant per array element; a payload that is no list fails.

    Variants tell an absent field from an explicit null, which a typed JSON scan cannot.
    """
    payload = spark.read.text(path, wholetext=True).select(F.parse_json("value").alias("payload"))
    is_list = F.schema_of_variant("payload").startswith("ARRAY")
    not_list = F.raise_error(F.lit("the countries file holds no JSON list")).cast("array<variant>")
    items = F.when(is_list, F.try_variant_get("payload", "$", "array<variant>")).otherwise(not_list)
    return payload.select(F.explode(items).alias("item"))


def parse_countries(spark: SparkSession, path: str) -> DataFrame:
    """Flatten the countries list: unnamed entries are skipped, absent fields get their default."""
    records = _country_records(spark, path).select(
        F.try_variant_get("item", "$.name.common", "string").alias("country"),
        F.try_variant_get("item", "$.region", "variant").alias("region"),
        F.try_variant_get("item", "$.population", "variant").alias("population"),
    )
    population = F.variant_get("population", "$", "bigint")
    null_population = F.raise_error(F.concat(F.lit("population is null: "), F.col("country")))
    return records.filter(F.length("country") > 0).select(
        "country",
        F.when(F.col("region").isNull(), REGION_NOT_GIVEN)
        .otherwise(F.variant_get("region", "$", "string"))
        .alias("region"),
        F.when(F.col("population").isNull(), 0)
        .when(F.is_variant_null("population"), null_population.cast("bigint"))
        .otherwise(population)
        .alias("population"),
    )


def skipped_countries(spark: SparkSession, path: str) -> DataFrame:
    """How many entries the reading of the countries skips because they have no name."""
    name = F.try_variant_get("item", "$.name.common", "string")
    return one_row(_country_records(spark, path), skipped_countries=F.count_if(F.coalesce(F.length(name), F.lit(0)) == 0))


def count_unnamed(spark: SparkSession, path: str) -> int:
    return skipped_countries(spark, path).first()[0]


def read_countries(spark: SparkSession, path: str, minimum: int = MIN_COUNTRIES) -> DataFrame:
    """Countries data, refused when it holds suspiciously few entries."""
    countries = parse_countries(spark, path)
    found = countries.count()
    if found < minimum:
        raise ValueError(f"countries data has only {found} entries, expected at least {minimum}")
    return countries


def parse_fx_rates(spark: SparkSession, path: str, currency: str = "EUR") -> DataFrame:
    """One rate per landed day file or line: ``{"date": …, "rates": {"EUR": …}}``.

    A day landed twice with the same rate is one row.
    """
    landed = spark.read.schema("date date, rates map<string,double>").json(path, mode="FAILFAST")
    return landed.select("date", F.col("rates")[currency].alias("fx_rate_gbp_eur")).distinct()


def check_fx_rates(fx: DataFrame, low: float = MIN_FX_RATE, high: float = MAX_FX_RATE) -> DataFrame:
    """Refuse rates that are missing, no number or outside the sanity bounds, and days given twice."""
    rate = F.col("fx_rate_gbp_eur")
    within = F.coalesce(~F.isnan(rate) & rate.between(low, high), F.lit(False))
    expect(
        fx,
        {
            f"an FX rate is not within {low} and {high}": F.count_if(~within) == 0,
            # The calendar between the first and the last day is expanded and broadcast.
            f"FX dates span more than {MAX_FX_DAYS} days": F.coalesce(
                F.date_diff(F.max("date"), F.min("date")), F.lit(0)
            ) < MAX_FX_DAYS,
            "FX date is missing": F.count_if(F.col("date").isNull()) == 0,
            "FX date has several rates": F.count_distinct("date") == F.count("date"),
        },
    )
    return fx


def read_fx_rates(spark: SparkSession, path: str, currency: str = "EUR") -> DataFrame:
    return check_fx_rates(parse_fx_rates(spark, path, currency))


def fx_rate_stats(fx: DataFrame) -> DataFrame:
    rate = F.col("fx_rate_gbp_eur")
    return one_row(
        fx,
        rates_fetched=F.count("date"),
        min_rate=F.min(rate),
        max_rate=F.max(rate),
    )
