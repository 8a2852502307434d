"""Upsert on the business key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions.aggregates import one_row
from basketry.schemas import FACT, KEY

KEEP, INSERT, UPDATE, SAME = "keep", "insert", "update", "same"

# Rows of one batch that share a key: the one with the smallest description, then country, wins.
_FIRST_BY = ("description", "country")
_PAYLOAD = _FIRST_BY + tuple(n for n in FACT.fieldNames() if n not in KEY + _FIRST_BY)


def _key() -> Column:
    """The key as one value; inside it a null part equals a null part."""
    return F.struct(*KEY).alias("key")


def _unpacked() -> list[Column]:
    return [F.col("key")[n].alias(n) if n in KEY else F.col("row")[n].alias(n) for n in FACT.fieldNames()]


def _first_of_each_key(batch: DataFrame) -> DataFrame:
    """One row per key, with ``batch_rows``.

    Exact copies, the usual case, are counted by hash before anything is sorted. What is left of a key is
    combined on the map side, so however many copies a key has, few of them are shuffled.
    """
    distinct = batch.groupBy(*FACT.fieldNames()).agg(F.count(F.lit(1)).alias("copies"))
    return (
        distinct.select(_key(), F.struct(*_PAYLOAD).alias("new"), "copies")
        .groupBy("key")
        .agg(F.min("new").alias("new"), F.sum("copies").alias("batch_rows"))
    )


def classify(
    target: DataFrame | None, batch: DataFrame, unique_target: bool = False, carry: tuple[str, ...] = ()
) -> DataFrame:
    """Target and batch merged by key; ``_change`` says what the upsert does to each row.

    The target's rows are shuffled as they are, once, and matched with the batch's one row per key.
    ``unique_target``: a key that the target holds twice fails. ``carry``: columns of the target that are kept
    beside its rows, null for new ones.
    """
    new = _first_of_each_key(batch)
    if target is None:
        return new.withColumnRenamed("new", "row").select(*_unpacked(), F.lit(INSERT).alias("_change"), "batch_rows")
    old = target.select(_key(), F.struct(*_PAYLOAD).alias("old"), *carry)
    if unique_target:
        # The match needs the same distribution and order, so numbering costs no shuffle of its own.
        number = F.row_number().over(Window.partitionBy("key").orderBy("key"))
        twice = F.raise_error(F.concat(F.lit("business key is not unique: "), F.to_json("key")))
        old = old.withColumn("old", F.when(number > 1, twice).otherwise(F.col("old")))
    before, after = F.col("old"), F.col("new")
    change = (
        F.when(after.isNull(), KEEP)
        .when(before.isNull(), INSERT)
        .when(after.eqNullSafe(before), SAME)
        .otherwise(UPDATE)
    )
    merged = old.join(new, "key", "full_outer").withColumns({"_change": change, "row": F.coalesce(after, before)})
    return merged.select(*_unpacked(), "_change", F.coalesce("batch_rows", F.lit(0)).alias("batch_rows"), *carry)


def upsert(target: DataFrame | None, batch: DataFrame) -> DataFrame:
    """The target after the batch: matched keys overwritten, new keys added, the rest kept."""
    return classify(target, batch).select(*FACT.fieldNames())


def deduplicate(batch: DataFrame) -> DataFrame:
    return upsert(None, batch)


def upsert_counts(target: DataFrame | None, batch: DataFrame) -> DataFrame:
    """Batch rows, keys added, and keys matched whose stored values change."""
    return one_row(
        classify(target, batch),
        records=F.coalesce(F.sum("batch_rows"), F.lit(0)),
        upserted=F.count_if(F.col("_change") == INSERT),
        modified=F.count_if(F.col("_change") == UPDATE),
    )
