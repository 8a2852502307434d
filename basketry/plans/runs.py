"""The incremental run: extract, transform, load. Any scheduler can call these functions.

Between the steps data lies as Parquet under the shared scratch folder; the steps hand each other a
small record. A failed step can be repeated from the record of the one before.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.functions.aggregates import literal_row
from basketry.functions.times import from_micros
from basketry.operators.clean import counter_metrics
from basketry.operators.contracts import check_accounts, check_gaps, check_unique_countries, gap_metrics
from basketry.operators.enrich import data_bytes, normalize_countries
from basketry.operators.fact import without_key_text
from basketry.operators.quality import build_quality_report
from basketry.plans.metrics import run_metrics
from basketry.plans.transform import to_fact
from basketry.schemas import COUNTRIES, FACT, FX_RATES, MIN_COUNTRIES
from basketry.session import dropping_shuffles, fit_shuffles, prepare, run_scratch, scratch_path, stage, stage_observed
from basketry.sources.fact_table import stored_mark, upsert_into
from basketry.sources.reference import count_unnamed, read_countries, read_fx_rates
from basketry.sources.sales import read_sales_csv, read_sales_parquet
from basketry.sources.watermark import get_last_watermark, update_watermark


@dataclass(frozen=True)
class Staged:
    """What an extract has put aside: the new lines, what was counted of them, and the reference data as of now."""

    counters: dict[str, int]
    sales: str
    countries: str
    rates: str
    countries_bytes: int
    skipped_countries: int
    newer_than: datetime | None

    @property
    def lines(self) -> int:
        return self.counters["rows_in"]


@dataclass(frozen=True)
class Converted:
    """The staged fact of the new lines and its newest time in microseconds; no path if there were none."""

    lines: int = 0
    fact: str | None = None
    newest: int | None = None
    quality: dict[str, Any] = field(default_factory=dict)
    metrics: dict[str, Any] = field(default_factory=dict)


@dataclass(frozen=True)
class Report:
    """What one whole run did."""

    received: int
    added: int
    changed: int
    newer_than: str | None
    quality: dict[str, Any]
    metrics: dict[str, Any]


def run_extract(
    spark: SparkSession,
    sales_csv: str | list[str],
    countries_json: str,
    fx_json: str,
    metadata_path: str,
    *,
    multi_line: bool,
    min_countries: int = MIN_COUNTRIES,
    fact_path: str | None = None,
    **csv_options: Any,
) -> Staged:
    """Stage the lines newer than the stored mark, and the reference data.

    The mark is the one committed with the fact, if that is named and has one; else that of the metadata.
    """
    prepare(spark)
    fit_shuffles(spark, [sales_csv] if isinstance(sales_csv, str) else sales_csv)
    committed = from_micros(stored_mark(spark, fact_path)) if fact_path else None
    mark = committed or get_last_watermark(spark, metadata_path)
    sales_path, countries_path, rates_path = (scratch_path(spark, n) for n in ("sales", "countries", "rates"))
    feed = read_sales_csv(spark, sales_csv, mark, multi_line=multi_line, **csv_options)
    counters = stage_sales(feed, sales_path)
    countries = stage(read_countries(spark, countries_json, min_countries), "countries", countries_path)
    normalized = check_unique_countries(normalize_countries(countries))
    if counters["rows_in"]:
        stage(read_fx_rates(spark, fx_json), "rates", rates_path)
    return Staged(
        counters, sales_path, countries_path, rates_path, data_bytes(normalized), count_unnamed(spark, countries_json), mark
    )


def stage_sales(feed: DataFrame, path: str) -> dict[str, int]:
    """Stage new lines; what the cleaning will keep and drop of them, counted on the way."""
    _, counters = stage_observed(feed, "sales", {**counter_metrics(), **gap_metrics()}, path)
    check_gaps(counters)
    return counters


def run_transform(spark: SparkSession, staged: Staged) -> Converted:
    """Stage the fact of the extracted lines, hold it to its contracts and report on it; nothing without lines."""
    prepare(spark)
    if not staged.lines:
        return Converted()
    sales = read_sales_parquet(spark, staged.sales)
    countries = spark.read.schema(COUNTRIES).parquet(staged.countries)
    fx = spark.read.schema(FX_RATES).parquet(staged.rates)
    if fx.isEmpty():
        raise ValueError("there are sales to convert but no FX rates")
    converted = convert(sales, staged.counters, countries, fx, staged.countries_bytes)
    return replace(converted, metrics={**converted.metrics, "skipped_countries": staged.skipped_countries})


def convert(
    sales: DataFrame, counters: dict[str, int], countries: DataFrame, fx: DataFrame, countries_bytes: int
) -> Converted:
    """Stage the fact of staged lines, hold it to their counters and report on it.

    The lines are read twice: for the fact, and for the metrics.
    """
    spark = sales.sparkSession
    path = scratch_path(spark, "fact")
    rows = without_key_text(to_fact(sales, countries, fx, countries_bytes))
    wanted = {"lines": F.count(F.lit(1)), "newest": F.unix_micros(F.max("invoice_date"))}
    fact, seen = stage_observed(rows, "fact", wanted, path)
    check_accounts(counters, seen["lines"])
    counted = T.StructType([T.StructField(name, T.LongType()) for name in counter_metrics()])
    row = literal_row(spark, counted, *[counters[name] for name in counted.fieldNames()])
    with dropping_shuffles(spark):
        quality = build_quality_report(row, fact).first().asDict()
        noted = run_metrics(sales, normalize_countries(countries), fx, countries_bytes).first().asDict()
    return Converted(seen["lines"], path, seen["newest"], quality, noted)


def run_load(
    spark: SparkSession, converted: Converted, fact_path: str, metadata_path: str, grain: str = "month"
) -> dict[str, int]:
    """Upsert the staged fact and advance the mark in one commit: a load that fails is simply repeated.

    Without rows the mark stays. The metadata get a copy of the mark for other readers; if a crash left it behind, the
    next load brings it up.
    """
    prepare(spark)
    counts = {"records": 0, "upserted": 0, "modified": 0}
    if converted.fact:
        fact = spark.read.schema(FACT).parquet(converted.fact)
        counts = upsert_into(spark, fact_path, fact, grain, converted.newest)
    mark = from_micros(stored_mark(spark, fact_path))
    if mark is not None and mark != get_last_watermark(spark, metadata_path):
        update_watermark(spark, metadata_path, mark)
    return counts


def run_daily(
    spark: SparkSession,
    sales_csv: str | list[str],
    countries_json: str,
    fx_json: str,
    fact_path: str,
    metadata_path: str,
    *,
    multi_line: bool,
    grain: str = "month",
    min_countries: int = MIN_COUNTRIES,
    **csv_options: Any,
) -> Report:
    """One whole run. What it stages goes when it ends, well or not: a run that failed begins anew."""
    with run_scratch(spark, "run"):
        staged = run_extract(
            spark, sales_csv, countries_json, fx_json, metadata_path,
            multi_line=multi_line, min_countries=min_countries, fact_path=fact_path, **csv_options,
        )
        converted = run_transform(spark, staged)
        counts = run_load(spark, converted, fact_path, metadata_path, grain)
    return Report(
        counts["records"], counts["upserted"], counts["modified"],
        staged.newer_than.isoformat() if staged.newer_than else None, converted.quality, converted.metrics,
    )
