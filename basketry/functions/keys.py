"""Row hash and business key.

The hashed text is the one Python's ``str`` prints for each field, so stored keys stay comparable.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# How a missing string and a missing time print.
MISSING_TEXT = "<NA>"
MISSING_TIME = "NaT"

HASHED = ("InvoiceNo", "StockCode", "CustomerID", "Quantity", "UnitPrice", "InvoiceDate")
HASH_LENGTH = 12


def float_text(col: Column) -> Column:
    """A double as Python prints it: plain digits from 1e-4 up to 1e16, ``1e-05`` style outside.

    Spark switches to its ``1.0E7`` style earlier (from 1e7 and below 1e-3). Between the two limits
    the digits are moved with a decimal cast; beyond them the exponent is re-spelled. From 1e16 on, the JVM
    prints more digits than Python for about half of all doubles, so keys of such prices differ from stored ones. Kept short:
    with the rest of the fact it must fit the 8000 bytes of bytecode the JVM is willing to compile.
    """
    shown = col.cast("string")
    size = F.abs(col)
    plain = F.regexp_replace(shown.try_cast("decimal(38,21)").cast("string"), r"(\.\d+?)0+$", "$1")
    respelled = shown
    for pattern, text in ((r"\.0E", "E"), (r"E-(\d)$", "E-0$1"), (r"E(?=\d)", "E+"), ("Infinity", "inf")):
        respelled = F.regexp_replace(respelled, pattern, text)
    return (
        F.when((size == 0) | ((size >= 1e-3) & (size < 1e7)), shown)
        .when((size >= 1e-4) & (size < 1e16), plain)
        .otherwise(F.lower(respelled))
    )


def time_text(col: Column) -> Column:
    """A UTC time as Python prints it; microseconds only where there are any."""
    whole = F.unix_micros(col) % 1_000_000 == 0
    return F.when(whole, F.date_format(col, "yyyy-MM-dd HH:mm:ss'+00:00'")).otherwise(
        F.date_format(col, "yyyy-MM-dd HH:mm:ss.SSSSSS'+00:00'")
    )


def row_hash(
    invoice_no: Column,
    stock_code: Column,
    customer_id: Column,
    quantity: Column,
    unit_price: Column,
    invoice_date: Column,
) -> Column:
    """First 12 hex digits of the SHA-1 over six fields.

    Every field is filled first: ``concat_ws`` skips nulls, which would let different rows collide.
    """
    payload = F.concat_ws(
        "|",
        F.coalesce(invoice_no, F.lit(MISSING_TEXT)),
        F.coalesce(stock_code, F.lit(MISSING_TEXT)),
        F.coalesce(customer_id, F.lit(MISSING_TEXT)),
        F.coalesce(quantity.cast("string"), F.lit(MISSING_TEXT)),
        F.coalesce(float_text(unit_price), F.lit("nan")),
        F.coalesce(time_text(invoice_date), F.lit(MISSING_TIME)),
    )
    return F.left(F.sha1(payload.cast("binary")), F.lit(HASH_LENGTH))


def business_key(*parts: Column) -> Column:
    return F.concat_ws("|", *[F.coalesce(part, F.lit(MISSING_TEXT)) for part in parts])
