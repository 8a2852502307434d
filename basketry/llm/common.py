"""What the operators of this subpackage share: their inputs, shipping code to executors, linked components."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable

import numpy as np
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import basketry
from basketry.session import prepare, run_scratch, scratch_path, stage

_PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application: their Python may not have it."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    path = os.path.join(tempfile.mkdtemp(prefix="basketry-"), "basketry.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, names in os.walk(_PACKAGE):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.join(basketry.__name__, os.path.relpath(full, _PACKAGE)))
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def quoted(name: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def texts(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Only ``doc_id`` and ``text`` (null: empty): other columns cannot clash with what an operator adds."""
    ship_package(df.sparkSession)
    return df.select(
        quoted(id_column).cast("long").alias("doc_id"), F.coalesce(quoted(text_column), F.lit("")).alias("text")
    )


def bounded_slices(batch, size_of: int, max_bytes: int = 1 << 20):
    """Slices of an Arrow batch whose texts, in column ``size_of``, have about ``max_bytes`` together; a row at least."""
    ends = np.cumsum(np.asarray(pc.binary_length(batch.column(size_of)).fill_null(0), np.int64))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + max_bytes, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def finished(spark: SparkSession, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """What ``build`` gives, written as a table of its own; whatever it stages on the way goes when that is done."""
    path = scratch_path(spark, name)
    with run_scratch(spark, name):
        return stage(build(), name, path)


def numbered(df: DataFrame, order: list, name: str) -> DataFrame:
    """``df`` with a column ``name`` of 1, 2, 3, ... in an order that no two rows share.

    Rows are dealt by ranges of the order and numbered in them; how many each range holds is all that reaches the driver.
    """
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    parts = stage(dealt.withColumn("_at", F.monotonically_increasing_id()), "ranges")
    part = F.shiftright("_at", 33)
    before, total = [], 0
    for row in parts.groupBy(part.alias("part")).count().orderBy("part").collect():
        before.append((row["part"], total))
        total += row["count"]
    starts = df.sparkSession.createDataFrame(before, "_part long, _before long")
    at = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        parts.withColumn("_part", part).join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_before") + at + 1).drop("_part", "_before", "_at")
    )


def connected_components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node``, ``root`` (smallest node it is linked to, over any number of links) of ``a``, ``b`` pairs.

    Alternating large-star and small-star rounds: each is a grouped minimum, combined before the shuffle,
    and a join that adaptive execution splits at a hot hub, so a component of any size stays spread. Every
    round is written to the shared folder, so a lost executor costs one round. Only a count and a checksum
    reach the driver. Nodes without a link to another node are left out. No links: no rows.
    """
    def state(edges: DataFrame) -> tuple:
        return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())

    def towards_smallest(edges: DataFrame, both_ways: bool) -> DataFrame:
        around = edges.union(edges.select(F.col("b"), F.col("a"))) if both_ways else edges
        least = around.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        moved = around.join(least.hint("shuffle_merge"), "a")
        # Large star: neighbours above the node move to the smallest; small star: all of those below, and the node.
        if both_ways:
            out = moved.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            out = moved.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
                least.select("a", F.col("m").alias("b"))
            )
        return out.filter(F.col("a") > F.col("b")).distinct()

    edges = stage(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .filter(F.col("a") > F.col("b")).distinct(),
        "links",
    )
    before = state(edges)
    for _ in range(max_rounds):
        edges = stage(towards_smallest(towards_smallest(edges, True), False), "links")
        after = state(edges)
        if after == before:
            roots = edges.select(F.col("b").alias("node")).distinct()
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                roots.select("node", F.col("node").alias("root"))
            )
        before = after
    raise RuntimeError(f"components not settled after {max_rounds} rounds")
