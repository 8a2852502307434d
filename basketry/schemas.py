"""Declared schemas, column constants and fixed values of the sales model."""

from __future__ import annotations

from pyspark.sql import types as T

# Sales lines as extracted. Column names follow the sales feed's header.
SALES = T.StructType(
    [
        T.StructField("InvoiceNo", T.StringType()),
        T.StructField("StockCode", T.StringType()),
        T.StructField("Description", T.StringType()),
        T.StructField("Quantity", T.LongType()),
        T.StructField("UnitPrice", T.DoubleType()),
        T.StructField("InvoiceDate", T.TimestampType()),
        T.StructField("CustomerID", T.StringType()),
        T.StructField("Country", T.StringType()),
    ]
)

COUNTRIES = T.StructType(
    [
        T.StructField("country", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("population", T.LongType()),
    ]
)

FX_RATES = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("fx_rate_gbp_eur", T.DoubleType()),
    ]
)

# The fact as stored; the concatenated business key `_bk` is derived and never stored.
FACT = T.StructType(
    [
        T.StructField("invoice_no", T.StringType()),
        T.StructField("stock_code", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("quantity", T.LongType()),
        T.StructField("unit_price_gbp", T.DoubleType()),
        T.StructField("invoice_date", T.TimestampType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("population", T.LongType()),
        T.StructField("revenue_gbp", T.DoubleType()),
        T.StructField("revenue_eur", T.DoubleType()),
        T.StructField("fx_rate_gbp_eur", T.DoubleType()),
        T.StructField("row_hash", T.StringType()),
    ]
)

# High-water marks, one appended row per successful load; the newest row counts.
METADATA = T.StructType(
    [
        T.StructField("id", T.StringType(), False),
        T.StructField("invoice_date", T.TimestampType(), False),
        T.StructField("updated_at", T.TimestampType(), False),
    ]
)

# Business key of a fact row.
KEY = ("invoice_no", "stock_code", "customer_id", "row_hash")

# Names in the sales feed -> names in the countries data.
COUNTRY_ALIASES = {
    "eire": "ireland",
    "channel islands": "jersey",
    "usa": "united states",
    "rsa": "south africa",
    "czech republic": "czechia",
}

# Region of a line whose country has no match, and of a country without a region.
UNMATCHED_REGION = "unknown"
REGION_NOT_GIVEN = "Unknown"

# Sanity limits of the reference data.
MIN_COUNTRIES = 100
MIN_FX_RATE = 0.5
MAX_FX_RATE = 2.5
MAX_FX_DAYS = 100 * 366

# Fixed value: illustrative GBP->EUR rate for insights straight from the sales feed.
CONSTANT_FX_RATE = 1.17

# CSV fields read as missing (the default missing markers of pandas).
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
