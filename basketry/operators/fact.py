"""Shape of the fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.keys import HASHED, business_key, row_hash
from basketry.schemas import FACT, KEY

# Fact column -> column of the converted lines.
_SOURCE = {
    "invoice_no": "InvoiceNo",
    "stock_code": "StockCode",
    "description": "Description",
    "quantity": "Quantity",
    "unit_price_gbp": "UnitPrice",
    "invoice_date": "InvoiceDate",
    "customer_id": "CustomerID",
    "country": "Country",
}


def build_fact_records(converted: DataFrame) -> DataFrame:
    """Rename and cast to the fact's columns, then add the row hash and the business key.

    A feed without descriptions gets empty ones.
    """
    if "Description" not in converted.columns:
        converted = converted.withColumn("Description", F.lit(""))
    hashed = converted.withColumn("row_hash", row_hash(*[F.col(name) for name in HASHED]))
    return hashed.select(
        *[F.col(_SOURCE.get(f.name, f.name)).cast(f.dataType).alias(f.name) for f in FACT]
    ).withColumn("_bk", business_key(*[F.col(name) for name in KEY]))


def without_key_text(fact: DataFrame) -> DataFrame:
    """The fact as stored: the concatenated key is left out."""
    return fact.drop("_bk")
