"""Hand-made rows shared by the tests."""

from __future__ import annotations

from datetime import date, datetime, timezone

from basketry.schemas import COUNTRIES, FACT, FX_RATES, SALES


def utc(text: str) -> datetime:
    return datetime.fromisoformat(text).replace(tzinfo=timezone.utc)


def line(invoice="A1", **changes):
    values = {
        "InvoiceNo": invoice,
        "StockCode": "X",
        "Description": "a",
        "Quantity": 1,
        "UnitPrice": 10.0,
        "InvoiceDate": utc("2011-01-01"),
        "CustomerID": "c1",
        "Country": "United Kingdom",
    }
    values.update(changes)
    return tuple(values[name] for name in SALES.fieldNames())


# One line breaks each cleaning rule; the last one is padded; the rate changes between the two lines that are kept.
RAW = [
    line("K1", StockCode="M4", Description="bowl", Quantity=3, UnitPrice=2.5),
    line("K2", StockCode="M5", Description="jar", Quantity=-4, UnitPrice=1.25, InvoiceDate=utc("2011-01-06"),
         CustomerID="n8", Country="Norway"),
    line("K3", StockCode="M6", Description="lid", Quantity=6, UnitPrice=0.0, InvoiceDate=utc("2011-01-08"),
         CustomerID="n9", Country="Italy"),
    line("K4", StockCode="M7", Description="mug", Quantity=2, UnitPrice=7.75, InvoiceDate=utc("2011-01-09"),
         CustomerID=None, Country="Portugal"),
    line("K5", StockCode="M8", Description="cup", UnitPrice=8.0, InvoiceDate=utc("2011-01-11"),
         CustomerID=" N5\t", Country="\tUnited Kingdom "),
]

LISTED = [
    ("United Kingdom", "Europe", 60_100_000),
    ("Norway", "Europe", 5_400_000),
    ("Italy", "Europe", 58_900_000),
    ("Portugal", "Europe", 10_300_000),
]

RATES = [
    (date(2011, 1, 1), 1.2),
    (date(2011, 1, 6), 1.2),
    (date(2011, 1, 8), 1.3),
    (date(2011, 1, 9), 1.3),
    (date(2011, 1, 11), 1.25),
]


def sales(spark, rows=RAW):
    return spark.createDataFrame(rows, SALES)


def countries(spark, rows=LISTED):
    return spark.createDataFrame(rows, COUNTRIES)


def rates(spark, rows=RATES):
    return spark.createDataFrame(rows, FX_RATES)


def fact_row(**changes):
    values = {
        "invoice_no": "A1",
        "stock_code": "X",
        "description": "a",
        "quantity": 1,
        "unit_price_gbp": 10.0,
        "invoice_date": utc("2011-01-01"),
        "customer_id": "c1",
        "country": "uk",
        "region": "Europe",
        "population": 1,
        "revenue_gbp": 10.0,
        "revenue_eur": 11.7,
        "fx_rate_gbp_eur": 1.17,
        "row_hash": "abc123",
    }
    values.update(changes)
    return tuple(values[name] for name in FACT.fieldNames())


def facts(spark, rows):
    return spark.createDataFrame(rows, FACT)


def sorted_rows(df):
    return sorted(df.collect(), key=str)
