"""Importance resampling towards a target: documents drawn by how much more their n-grams stand in a target's texts."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import bounded_slices, finished, numbered, ship_package, texts
from basketry.session import stage

#: Buckets that n-grams are hashed to; what is counted for each is all that the driver holds.
BUCKETS = 10_000
#: Words of an n-gram, at most.
LONGEST = 2
#: Gains and scores are whole numbers of this part.
SCALE = 1000
#: Words a document needs to be drawn.
FEWEST_WORDS = 20
#: Documents drawn of each hundred that have enough words.
SHARE = 25
SEED = 7

_WORD_BYTES = bytes(range(48, 58)) + bytes(range(97, 123)) + bytes(range(128, 256))
#: A-Z to a-z, every other byte that stands in no word to a space.
_SEPARATED = bytes(b if b in _WORD_BYTES else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


@lru_cache(maxsize=1)
def _zero_bytes() -> list[np.ndarray]:
    """What 1, 2, 4, 8, ... zero bytes after it make of a CRC, as four tables of 256 entries, one for each of its bytes.

    A CRC is linear over GF(2), so a table follows from what becomes of its single bits.
    """
    def table(bits: np.ndarray) -> np.ndarray:
        out = np.zeros((4, 256), np.uint32)
        values = np.arange(256)
        for bit in range(32):
            out[bit // 8] ^= np.where(values >> (bit % 8) & 1, bits[bit], 0).astype(np.uint32)
        return out

    one = np.array([zlib.crc32(b"\0", 1 << bit) ^ zlib.crc32(b"\0", 0) for bit in range(32)], np.uint32)
    tables = [table(one)]
    for _ in range(40):
        tables.append(table(_through(tables[-1], _through(tables[-1], np.uint32(1) << np.arange(32, dtype=np.uint32)))))
    return tables


def _through(table: np.ndarray, crcs: np.ndarray) -> np.ndarray:
    return (
        table[0][crcs & 255] ^ table[1][crcs >> 8 & 255] ^ table[2][crcs >> 16 & 255] ^ table[3][crcs >> 24]
    ).astype(np.uint32)


def shifted(crcs: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """What each CRC adds to the CRC of a text that goes on for so many bytes: the product with a power of x."""
    out = np.asarray(crcs, np.uint32).copy()
    for power, table in enumerate(_zero_bytes()):
        moved = np.flatnonzero(lengths >> power & 1)
        if not len(moved):
            if not (lengths >> power).any():
                break
            continue
        out[moved] = _through(table, out[moved])
    return out


def ngram_crcs(words: list[bytes], owners: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """CRC32 of all runs of 1 to ``longest`` words of one owner, joined by spaces, and whose they are, by owner.

    The words are scanned once, each after a space. The running CRC after word i is kept; the CRC of words i to j is
    that after j with what came before i, brought to its place, cancelled.
    """
    pieces = [b" " + w for w in words]
    after = np.fromiter(accumulate(pieces, lambda crc, piece: zlib.crc32(piece, crc), initial=0), np.uint32)
    ends = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))
    starts = np.concatenate(([0], ends[:-1])) + 1 if len(ends) else ends
    # What comes before a word ends with the space; zlib inverts a CRC before and after.
    every = np.uint32(0xFFFFFFFF)
    before = _through(_zero_bytes()[0], after[:-1] ^ every ^ np.uint32(32)) ^ every
    crcs, of = [], []
    for n in range(1, longest + 1):
        first = np.arange(max(0, len(pieces) - n + 1))
        first = first[owners[first] == owners[first + n - 1]]
        crcs.append(after[first + n] ^ shifted(before[first], ends[first + n - 1] - starts[first]))
        of.append(owners[first])
    order = np.argsort(np.concatenate(of), kind="stable")
    return np.concatenate(crcs)[order], np.concatenate(of)[order]


def words_of(text: bytes) -> list[bytes]:
    """Runs of digits, lower-cased letters a-z and bytes over 127."""
    return text.translate(_SEPARATED).split()


def _bucket_batches(longest: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = _kind(buckets)
        for batch in batches:
            for part in bounded_slices(batch, 1):
                rows = [words_of(t) for t in part.column(1).to_pylist()]
                sizes = [len(r) for r in rows]
                crcs, of = ngram_crcs([w for r in rows for w in r], np.repeat(np.arange(len(rows)), sizes), longest)
                ends = np.searchsorted(of, np.arange(len(rows)), side="right").tolist()
                placed = (crcs % np.uint32(buckets)).astype(kind)
                held = [placed[a:b].tobytes() for a, b in zip([0, *ends[:-1]], ends)]
                values = [part.column(0), pa.array(sizes, pa.int64()), pa.array(np.diff(ends, prepend=0)), held]
                yield pa.RecordBatch.from_arrays(
                    [v if isinstance(v, pa.Array) else pa.array(v, pa.binary()) for v in values],
                    ["doc_id", "n_words", "n_features", "buckets"],
                )

    return run


def _kind(buckets: int) -> str:
    return "<u2" if buckets <= 1 << 16 else "<u4"


def features(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    longest: int = LONGEST,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Per row: ``doc_id``, ``n_words``, ``n_features`` and ``buckets``, the n-grams' buckets as packed numbers.

    Words are runs of digits, letters and characters over 127, A-Z lower-cased; an n-gram is 1 to ``longest`` of them
    in a row, joined by a space, repeats counted, and its bucket the CRC32 of that modulo ``buckets``.
    """
    ship_package(df.sparkSession)
    docs = texts(df, id_column, text_column).select("doc_id", F.col("text").cast("binary").alias("text"))
    return docs.mapInArrow(
        _bucket_batches(longest, buckets), "doc_id long, n_words long, n_features long, buckets binary"
    )


def bucket_counts(coded: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``bucket`` and how many n-grams are in it. A task sends one row for each bucket at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in bounded_slices(batch, 0):
                data = np.frombuffer(b"".join(part.column(0).to_pylist()), _kind(buckets))
                total += np.bincount(data, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])

    counted = coded.select("buckets").mapInArrow(run, "bucket long, n long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Of each bucket: how much likelier it is in the target than in the source, smoothed by one, as a scaled logarithm.

    ``buckets`` counts of either side reach the driver, however large the tables are.
    """
    seen = []
    for counts in (source, target):
        held = [0.0] * buckets
        for row in counts.collect():
            held[row["bucket"]] = float(row["n"])
        seen.append(held)
    s_all, t_all = (sum(held) for held in seen)
    ratio = [(t + 1) * (s_all + buckets) / ((s + 1) * (t_all + buckets)) for s, t in zip(*seen)]
    return np.array([math.floor(SCALE * math.log(r)) for r in ratio], np.int64)


def weigh(coded: DataFrame, gain: np.ndarray) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_features`` and ``weight``, the mean gain of the n-grams, rounded down; none: 0."""
    kind = _kind(len(gain))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in bounded_slices(batch, 3):
                n = part.column(2).to_numpy()
                values = gain[np.frombuffer(b"".join(part.column(3).to_pylist()), kind)]
                ends = np.cumsum(n)
                sums = np.concatenate(([0], np.cumsum(values)))
                mean = (sums[ends] - sums[ends - n]) // np.maximum(n, 1)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:3], pa.array(mean, pa.int64())], ["doc_id", "n_words", "n_features", "weight"]
                )

    return coded.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Scaled Gumbel noise from a hash of the id, so that the highest scores are a draw without replacement."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    h = F.conv(F.left(F.sha2(key, 256), F.lit(8)), 16, 10).cast("double")
    return F.floor(-SCALE * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def resample(
    df: DataFrame,
    target: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    share: int = SHARE,
    fewest_words: int = FEWEST_WORDS,
    longest: int = LONGEST,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Draw ``share`` percent of the documents of at least ``fewest_words`` words, without replacement, by weight.

    Per row of ``df``: ``doc_id``, ``n_words``, ``n_features``, ``weight``, ``score`` (the weight with Gumbel noise from the id)
    and ``rank`` (1, 2, 3 and so on by score, then by id; null if not drawn). ``target`` has a column of the same name for
    its texts.

    A text is scanned once: its n-grams' buckets, two bytes each, are staged, counted per task and summed; only counts
    of ``buckets`` buckets reach the driver, and as many gains go to the executors. Ranks come from ranges of scores, so
    no task sorts all. Nulls and texts without words have no n-grams: weight 0, never drawn. A null id counts as one
    of its own, first among ties. Repeated rows are a document each. An empty table gives no rows, an empty target
    equal counts of none. Other columns are dropped, whatever their names. What is staged goes, but for the result.
    """
    spark = df.sparkSession

    def build() -> DataFrame:
        coded = stage(features(df, id_column, text_column, longest, buckets), "buckets")
        wanted = features(target.withColumn("_none", F.lit(None).cast("long")), "_none", text_column, longest, buckets)
        gain = gains(bucket_counts(coded, buckets), bucket_counts(wanted, buckets), buckets)
        scored = weigh(coded, gain).withColumn("score", F.col("weight") + noise(F.col("doc_id")))
        scored = stage(scored.withColumn("row", F.monotonically_increasing_id()), "scores")
        able = scored.filter(F.col("n_words") >= fewest_words)
        drawn = able.count() * share // 100
        ranks = numbered(able.select("row", "score", "doc_id"), [F.desc("score"), "doc_id", "row"], "rank")
        ranks = ranks.filter(F.col("rank") <= drawn).select("row", "rank")
        return scored.join(ranks, "row", "left").drop("row")

    return finished(spark, "importance", build)
