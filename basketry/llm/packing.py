"""Best-fit packing of documents into bins of one length, under conflicts."""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import quoted, ship_package
from basketry.session import stage

#: Words a bin holds.
CAPACITY = 2048
#: Documents of one group, on average: what a task packs at a time.
GROUP_ROWS = 8192

_PLACED = (
    "doc_id long, piece long, from_word long, n_words long, bin_id string, bin_offset long"
)


def count_words(text: Column) -> Column:
    """Runs of what is not ASCII white space."""
    inner = F.regexp_replace(F.coalesce(text, F.lit("")), r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")
    return F.when(inner == "", F.lit(0)).otherwise(F.size(F.split(inner, r"[\x20\x09-\x0D]+"))).cast("long")


def best_fit(sizes: list[int], sources: list[int], clusters: list[int], capacity: int) -> list[tuple[int, int]]:
    """Bin and offset of each piece, pieces given from the longest to the shortest.

    Open bins are ordered by what is left in them. The search begins at the first bin that is large enough, the
    tightest, and goes on to the next until one holds neither the piece's source nor its cluster; only then a new
    one is opened. What a bin holds of each is a bitmap.
    """
    order: list[tuple[int, int]] = []  # what is left, bin
    source_bits: list[int] = []
    cluster_bits: list[int] = []
    placed = []
    for size, source, cluster in zip(sizes, sources, clusters):
        source_bit, cluster_bit = 1 << source, 1 << cluster
        at = bisect_left(order, (size, -1))
        while at < len(order):
            b = order[at][1]
            if not (source_bits[b] & source_bit or cluster_bits[b] & cluster_bit):
                break
            at += 1
        if at < len(order):
            left, b = order.pop(at)
        else:
            left, b = capacity, len(source_bits)
            source_bits.append(0)
            cluster_bits.append(0)
        source_bits[b] |= source_bit
        cluster_bits[b] |= cluster_bit
        placed.append((b, capacity - left))
        if left > size:
            insort(order, (left - size, b))
    return placed


def _pack_group(capacity: int):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(
            ["rest", "doc_id", "cluster", "source"], ascending=[False, True, True, True], kind="stable"
        )
        sources = pd.factorize(frame["source"], use_na_sentinel=False)[0].tolist()
        clusters = pd.factorize(frame["cluster"], use_na_sentinel=False)[0].tolist()
        placed = best_fit(frame["rest"].tolist(), sources, clusters, capacity)
        group = frame["pack_group"].iloc[0]
        bins, offsets = zip(*placed)
        return pd.DataFrame({
            "doc_id": frame["doc_id"].astype("Int64"),
            "piece": frame["n_words"] // capacity,
            "from_word": frame["n_words"] - frame["rest"],
            "n_words": frame["rest"],
            "bin_id": [f"{group}-{b}" for b in bins],
            "bin_offset": np.array(offsets, np.int64),
        })

    return run


def pack(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    cluster_column: str | None = None,
    capacity: int = CAPACITY,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Where each piece of each document lies: ``piece``, ``from_word``, ``n_words``, ``bin_id``, ``bin_offset``.

    A document longer than a bin fills bins of its own with whole pieces; its rest is packed with the others, from
    the longest to the shortest, each into the tightest bin that has room and neither its source nor its cluster of
    duplicates. Without ``cluster_column`` a cluster is all documents of the same words in the same order. Null
    sources are one source, null clusters one cluster.

    Documents are dealt by hash into groups of about ``group_rows``, packed each by itself, so a hot source is spread
    as all others are, and a group costs at most one open bin of slack per conflict. Only ids, lengths and hashes are
    shuffled, never texts.

    Null or empty text: one piece of 0 words without a bin. Null ids stay null. Repeated rows: a document each, in one
    cluster. Ties are broken by id, then cluster. An empty table gives no rows; other columns are dropped.
    """
    ship_package(df.sparkSession)
    text = F.coalesce(quoted(text_column), F.lit(""))
    same = F.xxhash64(F.regexp_replace(F.lower(text), r"[\x20\x09-\x0D]+", " "))
    # Three uses below, of a few numbers each; the texts are read once.
    measured = stage(df.select(
        quoted(id_column).cast("long").alias("doc_id"),
        quoted(source_column).cast("string").alias("source"),
        (quoted(cluster_column).cast("string") if cluster_column else same.cast("string")).alias("cluster"),
        count_words(text).alias("n_words"),
        # Repeated rows share all columns, so their place in the input deals them out.
        F.xxhash64(quoted(id_column), same, F.monotonically_increasing_id()).alias("deal"),
    ), "measured")
    groups = max(1, -(-measured.count() // group_rows))
    rows = measured.withColumns(
        {"pack_group": F.pmod("deal", F.lit(groups)), "rest": F.col("n_words") % capacity}
    )
    whole = rows.filter(F.col("n_words") >= capacity).withColumn(
        "piece", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("n_words") / capacity) - 1))
    )
    full = whole.select(
        "doc_id", "piece", (F.col("piece") * capacity).alias("from_word"), F.lit(capacity).cast("long").alias("n_words"),
        # Repeated rows fill bins of their own: only ``deal`` tells them apart.
        F.concat_ws("-", F.lit("full"), "doc_id", "cluster", "deal", "piece").alias("bin_id"),
        F.lit(0).cast("long").alias("bin_offset"),
    )
    empty = rows.filter("n_words = 0").select(
        "doc_id", F.lit(0).cast("long").alias("piece"), F.lit(0).cast("long").alias("from_word"), "n_words",
        F.lit(None).cast("string").alias("bin_id"), F.lit(None).cast("long").alias("bin_offset"),
    )
    rest = rows.filter("rest > 0").groupBy("pack_group").applyInPandas(_pack_group(capacity), _PLACED)
    return full.union(empty).union(rest)
