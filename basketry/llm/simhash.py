"""SimHash near-duplicates: fingerprints, linked through a grid over their segments' bit counts."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import connected_components, quoted, texts
from basketry.session import stage

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
#: Bits in one segment; with two, the counts of all segments fit the place of the segments themselves.
SEGMENT_BITS = 2
_EVEN = 0x5555555555555555
#: A cell of more fingerprints is first cut along exact blocks of bits.
DENSE = 512


def fingerprint(text: str, shingle_words: int = SHINGLE_WORDS) -> int:
    """Bit i is 1 if it is set in over half of the shingles' hashes; no words: 0."""
    words = text.encode().lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    n = max(1, len(words) - shingle_words + 1)
    starts = np.concatenate(([0], ends[:-1] + 1))[:n]
    shingles = map(joined.__getitem__, map(slice, starts.tolist(), ends[-n:].tolist()))
    hashes = np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=SEED), shingles), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for i in range(0, n, 65536):
        bits = np.unpackbits(hashes[i : i + 65536].astype("<u8").view(np.uint8).reshape(-1, 8), 1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def _fingerprint_batches(shingle_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = [fingerprint(t.as_py(), shingle_words) for t in batch.column(1)]
            signed = pa.array(np.array(marks, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), signed], ["doc_id", "text_key", "mark"])

    return run


def fingerprints(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle_words: int = SHINGLE_WORDS
) -> DataFrame:
    """``doc_id``, ``text_key`` (hash of the text) and ``mark``, the fingerprint as a signed long."""
    rows = texts(df, id_column, text_column).withColumn("text_key", F.xxhash64("text"))
    return rows.mapInArrow(_fingerprint_batches(shingle_words), "doc_id long, text_key long, mark long")


def segment_counts(mark: Column) -> Column:
    """The bit counts of all two-bit segments, each in its segment's place."""
    upper = F.shiftrightunsigned(mark, 1)
    ones = mark.bitwiseXOR(upper).bitwiseAND(F.lit(_EVEN))
    twos = F.shiftleft(mark.bitwiseAND(upper).bitwiseAND(F.lit(_EVEN)), 1)
    return ones.bitwiseOR(twos)


def grid_masks(max_bits: int = MAX_BITS) -> list[int]:
    """Which segments each grid looks at.

    The segments are dealt into twice as many groups as bits may differ. Each differing bit changes one count by
    one, so a pair in reach has equal counts in at least half of the groups, and meets in the cell of some grid.
    """
    groups = 2 * max(1, max_bits)
    segments = 64 // SEGMENT_BITS
    masks = [0] * groups
    for i in range(segments):
        masks[i * groups // segments] |= 3 << (SEGMENT_BITS * i)
    signed = lambda m: m - (1 << 64) if m >> 63 else m
    return [signed(sum(c)) for c in combinations(masks, groups - max_bits)]


def _counts(marks: np.ndarray) -> np.ndarray:
    even, one = np.uint64(_EVEN), np.uint64(1)
    return (marks & even) + ((marks >> one) & even)


def _in_reach(a, b, max_bits: int) -> np.ndarray:
    """Pairs whose segment counts are in reach by Manhattan distance, and then whose bits are."""
    a, b = np.broadcast_arrays(a, b)
    differ = _counts(a) ^ _counts(b)
    even, one = np.uint64(_EVEN), np.uint64(1)
    low, high = differ & even, (differ >> one) & even
    # Counts are 0 (00), 1 (01) or 2 (10): a difference in the low bit alone or in both bits is 1, in the high bit 2.
    apart = np.bitwise_count(low).astype(np.int16) + 2 * np.bitwise_count(high) - 2 * np.bitwise_count(low & high)
    near = apart <= max_bits
    near[near] = np.bitwise_count(a[near] ^ b[near]) <= max_bits
    return near


def link_cell(marks: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links that connect what is in reach among distinct fingerprints: at most one less than there are."""
    if len(marks) > DENSE and max_bits < 4:
        # Pairs that differ in at most three bits agree in one of four blocks of 16.
        links: list[tuple[int, int]] = []
        for shift in (0, 16, 32, 48):
            block = (marks >> np.uint64(shift)) & np.uint64(0xFFFF)
            order = np.argsort(block, kind="stable")
            cuts = np.flatnonzero(np.diff(block[order])) + 1
            for part in np.split(marks[order], cuts):
                if len(part) > 1:
                    links += _spread(part, max_bits)
        return links
    return _spread(marks, max_bits)


def _spread(marks: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    links, rest = [], marks
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            at = queue.pop()
            near = _in_reach(at, rest, max_bits)
            if near.any():
                found = rest[near]
                links += [(int(at), int(f)) for f in found]
                queue += list(found)
                rest = rest[~near]
    return links


def _link_batches(max_bits: int):
    """Cells arrive sorted; one that batches cut is held until its end has come."""

    def links_of(grids: np.ndarray, cells: np.ndarray, marks: np.ndarray) -> pa.RecordBatch:
        new = np.concatenate(([True], (np.diff(cells) != 0) | (np.diff(grids) != 0)))
        starts = np.flatnonzero(new)
        sizes = np.diff(np.concatenate((starts, [len(marks)])))
        two = starts[sizes == 2]
        two = two[_in_reach(marks[two], marks[two + 1], max_bits)] if len(two) else two
        pairs = [np.stack((marks[two], marks[two + 1]), 1)]
        for start, n in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
            found = link_cell(marks[start : start + n], max_bits)
            if found:
                pairs.append(np.array(found, np.uint64))
        both = np.concatenate(pairs).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            got = [batch.column(i).to_numpy() for i in range(3)]
            rows = got if held is None else [np.concatenate(x) for x in zip(held, got)]
            last = np.flatnonzero((rows[0] != rows[0][-1]) | (rows[1] != rows[1][-1]))
            cut = last[-1] + 1 if len(last) else 0
            held = [x[cut:] for x in rows]
            if cut:
                yield links_of(rows[0][:cut], rows[1][:cut], rows[2][:cut].view(np.uint64))
        if held is not None and len(held[0]):
            yield links_of(held[0], held[1], np.ascontiguousarray(held[2]).view(np.uint64))

    return run


def link_fingerprints(marks: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links ``a``, ``b`` that connect distinct fingerprints ``mark`` differing in at most ``max_bits`` bits.

    Fingerprints are embedded as the bit counts of their segments, whose Manhattan distance is never above the
    number of differing bits. Every grid cuts that space into cells by some of the counts; each cell is joined with
    itself under the distance, then checked bit by bit. Not all pairs come out but links that connect them.
    """
    grids = F.explode(F.array(*[
        F.struct(F.lit(i).alias("grid"), F.col("counts").bitwiseAND(F.lit(m)).alias("cell"))
        for i, m in enumerate(grid_masks(max_bits))
    ])).alias("at")
    cells = (
        marks.select("mark").distinct().withColumn("counts", segment_counts(F.col("mark")))
        .select(grids, "mark").select("at.grid", "at.cell", "mark")
    )
    dealt = cells.repartition("grid", "cell").sortWithinPartitions("grid", "cell", "mark")
    return dealt.mapInArrow(_link_batches(max_bits), "a long, b long")


def near_duplicates(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """Per row: ``doc_id``, ``text_key``, ``mark``, ``root`` (smallest fingerprint linked) and ``component_id``.

    Copies fall on one fingerprint before anything is joined, so a group of any number of them costs one row.
    Fingerprints, links and components stay distributed; a task holds the distinct fingerprints of one cell.

    Null or empty text: fingerprint 0, linked like any other. Null ids: in their component, but its id is the
    smallest that is not null (null if all are). Repeated rows: one row each. An empty table gives no rows; other
    columns are dropped, whatever their names.
    """
    marked = stage(fingerprints(df, id_column, text_column, shingle_words), "fingerprints")
    roots = connected_components(link_fingerprints(marked, max_bits))
    firsts = marked.groupBy("mark").agg(F.min("doc_id").alias("first_id"))
    rooted = firsts.join(roots.withColumnRenamed("node", "mark"), "mark", "left").select(
        "mark", F.coalesce("root", "mark").alias("root"), "first_id"
    )
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    parts = stage(rooted.join(least, "root").select("mark", "root", "component_id"), "components")
    return marked.join(parts, "mark").select("doc_id", "text_key", "mark", "root", "component_id")


def drop_near_duplicates(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """``df`` with one document of each component: the one with the smallest id. All columns stay.

    Repeated rows of one id leave one row. Of a component without any id, one row is left.
    """
    parts = near_duplicates(df, id_column, text_column, **options)
    first = parts.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("root", "component_id").agg(
        F.min("text_key").alias("text_key")
    )
    kept = F.struct(F.col("component_id").alias("i"), F.col("text_key").alias("k"))
    keep = first.select(kept.cast("struct<i:bigint,k:bigint>").alias("kept"))
    text_key = F.xxhash64(F.coalesce(quoted(text_column), F.lit("")))
    keyed = df.select(
        F.struct(*[quoted(c) for c in df.columns]).alias("row"),
        # As nullable as the other side's: else the join casts it, and the step after it shuffles the texts again.
        F.struct(quoted(id_column).cast("long").alias("i"), text_key.alias("k")).cast("struct<i:bigint,k:bigint>").alias("own"),
    )
    # Inside a key a null id equals a null id. Both steps need the key's distribution: texts are shuffled once.
    joined = keyed.join(keep, F.col("own") == F.col("kept"), "left_semi")
    return joined.dropDuplicates(["own"]).select("row.*")
