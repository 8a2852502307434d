"""Sales feed: CSV scan (whole or incremental) and its streaming twin."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.functions.text import missing_as_null
from basketry.functions.times import as_utc
from basketry.schemas import NA_TOKENS, SALES
from basketry.sources.quoted_csv import read_quoted_csv

ENCODING = "ISO-8859-1"


def _csv_options(multi_line: bool) -> dict[str, object]:
    return {
        "header": True,
        "encoding": ENCODING,
        "quote": '"',
        "escape": '"',  # a doubled quote inside a quoted field is one quote
        "enforceSchema": False,  # every file's header must name the columns in the same order
        "mode": "FAILFAST",
        "multiLine": multi_line,
    }


def _parsed(text: Column, value: Column, name: str) -> Column:
    """``value`` parsed from ``text``; text that does not parse fails the run, in ANSI mode or not."""
    unreadable = F.concat(F.lit(f"{name} is not readable: "), text)
    return F.when(text.isNotNull() & value.isNull(), F.raise_error(unreadable)).otherwise(value)


def typed_sales(raw: DataFrame, timestamp_format: str | None = None) -> DataFrame:
    """Give all-text feed columns their declared types.

    Missing markers become null first, which a typed CSV scan cannot do for numbers. A missing
    quantity fails (the column is declared an integer); a missing price is left to the cleaning.
    """
    columns = []
    for field in SALES:
        if field.name not in raw.columns:
            continue
        text = missing_as_null(F.col(field.name), NA_TOKENS)
        if field.dataType == T.StringType():
            value = text
        elif field.dataType == T.TimestampType():
            fmt = F.lit(timestamp_format) if timestamp_format else None
            value = _parsed(text, F.try_to_timestamp(text, fmt), field.name)
        else:
            value = _parsed(text, text.try_cast(field.dataType), field.name)
        if field.name == "Quantity":
            value = F.coalesce(value, F.raise_error(F.lit("Quantity has missing values")).cast("bigint"))
        columns.append(value.alias(field.name))
    return raw.select(*columns)


def newer_than(sales: DataFrame, mark: datetime | None) -> DataFrame:
    """Lines strictly newer than the high-water mark; all of them on a cold start."""
    return sales if mark is None else sales.filter(F.col("InvoiceDate") > F.lit(as_utc(mark)))


def read_sales_csv(
    spark: SparkSession,
    path: str | list[str],
    mark: datetime | None = None,
    *,
    multi_line: bool,
    strict_quotes: bool = False,
    timestamp_format: str | None = None,
) -> DataFrame:
    """Scan the sales feed by header name and keep the lines newer than ``mark``.

    ``multi_line`` has no default, as the feed decides: ``True`` keeps line breaks inside quotes but makes each
    file one task; ``False`` splits large files, which must then hold one line per row. ``strict_quotes`` says that all
    quotes stand around a field or are doubled in one: then files with breaks in quotes are split too.
    """
    raw = spark.read.options(**_csv_options(multi_line)).csv(path)
    if multi_line and strict_quotes:
        raw = read_quoted_csv(spark, path, raw.columns, ENCODING)
    return newer_than(typed_sales(raw, timestamp_format), mark)


def stream_sales_csv(
    spark: SparkSession,
    folder: str,
    *,
    multi_line: bool,
    columns: tuple[str, ...] = tuple(SALES.fieldNames()),
    timestamp_format: str | None = None,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """The same scan over files as they land; ``columns`` is the header order of the feed."""
    schema = T.StructType([T.StructField(name, T.StringType()) for name in columns])
    reader = spark.readStream.schema(schema).options(**_csv_options(multi_line))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return typed_sales(reader.csv(folder), timestamp_format)


def read_sales_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Staged sales; a time stored without a zone is taken as UTC."""
    sales = spark.read.parquet(path)
    return sales.withColumn("InvoiceDate", F.col("InvoiceDate").cast("timestamp"))
