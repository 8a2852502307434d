"""Bloom filters of the keys in data files, as a table: which files can hold a key, without opening them.

A filter is made of 64-bit words. A key's hash picks one word of its file's filter and four bits in it, so a filter is a grouped
``bit_or``, and asking is a join on file and word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bits of a filter for each key, at least; about one other key in a hundred is taken for one of the file's.
BITS_PER_KEY = 12
_BITS = 4

FILTERS = "file string, word long, bits long"


def words_for(rows: int) -> int:
    """Words of the filter of so many keys, a power of two."""
    return 1 << max(0, (rows * BITS_PER_KEY - 1) // 64).bit_length()


def key_hash(*key: str) -> Column:
    """One number for a key of several columns; a null part is told from every value but by where it stands."""
    parts = [part for name in key for part in (F.col(name).isNull(), F.col(name))]
    return F.xxhash64(*parts)


def _word(hashed: Column, words: Column) -> Column:
    return F.pmod(hashed, words)


def _mask(hashed: Column) -> Column:
    """Four bits of a word, from the hash of the hash: which word it is says nothing about them."""
    again = F.xxhash64(hashed)
    mask = F.lit(0).cast("long")
    for at in range(_BITS):
        place = F.shiftrightunsigned(again, 6 * at).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))
    return mask


def build(rows: DataFrame, file: str, hashed: Column, words: DataFrame) -> DataFrame:
    """``FILTERS`` of the files in ``rows``; ``words`` has a row for each ``file`` with how many ``words`` it gets.

    The words are grouped by a number of the file, which is turned into its name again once they are few.
    """
    numbered = words.withColumn("number", F.xxhash64("file"))
    keys = rows.select(F.col(file).alias("file"), hashed.alias("h")).join(F.broadcast(numbered), "file")
    marked = keys.select("number", _word(F.col("h"), F.col("words")).alias("word"), _mask(F.col("h")).alias("bits"))
    grouped = marked.groupBy("number", "word").agg(F.bit_or("bits").alias("bits")).sortWithinPartitions("number", "word")
    return grouped.join(F.broadcast(numbered.select("number", "file")), "number").select("file", "word", "bits")


def may_hold(keys: DataFrame, filters: DataFrame) -> DataFrame:
    """``file`` of every pair of a key and a file, given as ``file``, ``words`` and ``h``, that the filter does not rule out."""
    asked = keys.select("file", _word(F.col("h"), F.col("words")).alias("word"), _mask(F.col("h")).alias("mask")).distinct()
    held = asked.join(filters, ["file", "word"]).filter(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask"))
    return held.select("file").distinct()


def read(spark: SparkSession, folders: list[str]) -> DataFrame:
    return spark.read.schema(FILTERS).parquet(*folders)
