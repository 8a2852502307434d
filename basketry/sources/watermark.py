"""High-water mark of the batch loads (not a streaming watermark)."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.functions.times import as_utc, from_micros
from basketry.functions.aggregates import literal_row, one_row
from basketry.schemas import METADATA
from basketry.session import delete_path, list_names, read_if_exists

_ID = "last_watermark"


def next_watermark(fact: DataFrame) -> DataFrame:
    """Newest invoice time of the cleaned fact: lines dropped after it are read again next time."""
    return one_row(fact, invoice_date=F.max("invoice_date"))


def get_last_watermark(spark: SparkSession, path: str) -> datetime | None:
    """The mark of the newest successful load, or ``None`` on a cold start."""
    marks = read_if_exists(spark, path, METADATA)
    if marks is None:
        return None
    newest = marks.filter(F.col("id") == _ID).agg(
        F.unix_micros(F.max_by("invoice_date", "updated_at")).alias("mark")
    )
    return from_micros(newest.first()["mark"])


def update_watermark(spark: SparkSession, path: str, mark: datetime) -> None:
    """Append the new mark, then drop the files of older ones: a crash in between loses no mark."""
    older = [name for name in list_names(spark, path) if name.startswith("part-")]
    row = literal_row(spark, METADATA, _ID, as_utc(mark), datetime.now(timezone.utc))
    row.coalesce(1).write.mode("append").parquet(path)
    for name in older:
        delete_path(spark, f"{path.rstrip('/')}/{name}")
