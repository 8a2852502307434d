"""As-of join of two large tables: each left row with the latest right row of its key that is not after it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basketry.functions.text import quoted
from basketry.session import stage

_RIGHT, _LEFT = 0, 1


def _side(df: DataFrame, keys: list[str], time: str, side: int, column: Column) -> DataFrame:
    key = F.struct(*[quoted(k) for k in keys]) if keys else F.struct(F.lit(0).alias("all"))
    return df.select(key.alias("key"), quoted(time).alias("time"), F.lit(side).alias("side"), column)


def asof_join(
    left: DataFrame,
    right: DataFrame,
    left_time: str,
    right_time: str,
    keys: list[str],
    values: list[str],
    ranges: int | None = None,
) -> DataFrame:
    """Every left row, with the ``values`` of the latest row of ``right`` of equal ``keys`` not after it.

    Neither side is broadcast or expanded to days, so both may be large, and times may be of any precision. Rows of both sides
    are put in order of key and time, cut into ``ranges`` (as many as shuffles have partitions, if not given) and each row takes the last
    right row before it in its range. Only a range's first key can go on from the range before: what that key held there
    comes from a table of one row a range, which is all that is broadcast. A key with most of the rows is cut into many ranges.

    As ``fx_asof`` has it, the latest *row* counts, even if its values are null. Rows of ``right`` with equal key and time give the
    greatest values (nulls are smallest). A left row without time, or without an earlier right row, gets nulls; right rows without time are
    left out. Null keys match each other. Repeated left rows stay. Left columns with the name of a value are refused,
    other columns may clash; an empty side is no special case. Sorting writes both sides once.
    """
    clash = {v.lower() for v in values} & {c.lower() for c in left.columns}
    if clash:
        raise ValueError(f"left table already has {sorted(clash)}")
    spark = left.sparkSession
    found = F.struct(*[quoted(v) for v in values]).alias("found")
    dated = right.filter(quoted(right_time).isNotNull())
    # One row for each key and time, so that many at one moment are combined before the shuffle.
    rates = _side(dated, keys, right_time, _RIGHT, found).groupBy("key", "time", "side").agg(F.max("found").alias("found"))
    lines = _side(left, keys, left_time, _LEFT, F.struct(*[quoted(c) for c in left.columns]).alias("row"))
    both = lines.unionByName(rates, allowMissingColumns=True)
    n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The salt parts rows of one key and moment; a right row has none and comes first.
    salt = F.when(F.col("side") == _LEFT, F.xxhash64("row")).otherwise(F.lit(None))
    placed = both.withColumn("salt", salt).repartitionByRange(n, "key", "time", "side", "salt")
    placed = stage(placed.withColumn("range", F.spark_partition_id()), "asof")

    # What each range ends with: its last key, and the last right row of that key in it, if there is one.
    last_key = placed.groupBy("range").agg(F.max("key").alias("key"))
    held = placed.filter(F.col("side") == _RIGHT).groupBy("range", "key").agg(F.max_by("found", "time").alias("found"))
    ends = last_key.join(held, ["range", "key"], "left")
    # The key that a range begins with has held the latest of these in the ranges before.
    first_key = placed.groupBy("range").agg(F.min("key").alias("key"))
    begins = first_key.select("range", "key", F.lit(None).cast(ends.schema["found"].dataType).alias("found"))
    marks = ends.withColumn("at", F.lit(1)).unionByName(begins.withColumn("at", F.lit(0)))
    before = W.partitionBy("key").orderBy("range", "at").rowsBetween(W.unboundedPreceding, -1)
    carried = marks.withColumn("carried", F.last("found", ignorenulls=True).over(before)).filter("at = 0")
    carried = carried.select("range", F.col("key").alias("begins"), "carried")

    upto = W.partitionBy("range", "key").orderBy("time", "side").rowsBetween(W.unboundedPreceding, W.currentRow)
    known = placed.withColumn("within", F.last("found", ignorenulls=True).over(upto)).filter(F.col("side") == _LEFT)
    known = known.join(F.broadcast(carried), "range")
    own = F.when(F.col("begins").eqNullSafe(F.col("key")), F.coalesce("within", "carried")).otherwise(F.col("within"))
    own = F.when(F.col("time").isNotNull(), own)
    return known.select("row", own.alias("found")).select("row.*", "found.*")
