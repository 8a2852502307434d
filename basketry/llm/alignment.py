"""Two tokenizers' tokens of one text, aligned by a merge of the places where they end."""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from basketry.llm.common import bounded_slices, finished, ship_package, texts
from basketry.session import stage

#: Ends that a piece of the merge has.
WORK = 256
#: Different pairs of ids whose counts are broadcast, at most: 24 bytes each. More are joined by a shuffle.
BROADCAST_PAIRS = 1 << 20
#: Units of text a worker remembers the ids of, and the longest of those.
REMEMBERED, REMEMBERED_CHARS = 200_000, 48
#: Units that are encoded in one string.
_AT_ONCE = 64
#: Bytes of texts that are aligned at a time.
_SLICE = 2 << 20

_LINKS = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<long>, times array<long>"
#: Fixed value: sentencepiece's sign for a space.
_SPACE = "▁"


def diagonal_cuts(a: np.ndarray, b: np.ndarray, diagonals: np.ndarray) -> np.ndarray:
    """How many ends of ``a`` are among the first so many of the merged ends, those of ``a`` first of equal ones.

    One bisection along each diagonal of the merge, all of them at a time.
    """
    low, high = np.maximum(0, diagonals - len(b)), np.minimum(diagonals, len(a))
    while (open_ := np.flatnonzero(low < high)).size:
        middle = (low[open_] + high[open_]) // 2
        passed = a[middle] <= b[diagonals[open_] - 1 - middle]
        low[open_] = np.where(passed, middle + 1, low[open_])
        high[open_] = np.where(passed, high[open_], middle)
    return low


def merge_path(a: np.ndarray, b: np.ndarray, work: int = WORK) -> tuple[np.ndarray, ...]:
    """Align two ascending lists of ends, each without repeats, that have their last end in common.

    The path through the merge is cut into pieces of ``work`` ends, which know nothing of each other; all of them
    take a step at a time. A piece emits an overlap at each step, and numbers its groups from 0: a group is closed where
    both end. Pieces are stitched by how many groups those before them closed, so a group that reaches over a border
    has one number.

    Returned: group of each ``a``, group of each ``b``; the overlaps, as places in ``a`` and in ``b``.
    """
    total = len(a) + len(b)
    borders = np.minimum(np.arange(0, total + work, work), total)
    of_a = diagonal_cuts(a, b, borders)
    i, j, size = of_a[:-1].copy(), borders[:-1] - of_a[:-1], np.diff(borders)
    far = np.iinfo(np.int64).max
    wide_a, wide_b = np.append(a, far), np.append(b, far)
    shape = (work, len(size))
    takes, closes = np.zeros(shape, bool), np.zeros(shape, bool)
    at_a, at_b = np.zeros(shape, np.int64), np.zeros(shape, np.int64)
    closed = np.zeros(len(size), np.int64)
    local = np.zeros(shape, np.int64)
    for step in range(work):
        live = step < size
        x, y = wide_a[i], wide_b[j]
        from_a = live & (x <= y)
        from_b = live & ~from_a
        both = from_b & (i > 0) & (wide_a[i - 1] == y)
        takes[step], closes[step], at_a[step], at_b[step], local[step] = from_a, both, i, j, closed
        closed += both
        i += from_a
        j += from_b
    before = np.cumsum(closed) - closed
    own = (np.arange(work)[:, None] < size).T.ravel()
    path = lambda steps: steps.T.ravel()[own]
    groups, from_a, ends_group = path(local + before), path(takes), path(closes)
    overlaps = ~ends_group  # where both end, the tokens have met at the step before
    return groups[from_a], groups[~from_a], path(at_a)[overlaps], path(at_b)[overlaps]


def _bytes_of_level(piece: str) -> bytes:
    """A byte-level token's bytes: printable bytes stand for themselves, the others follow from 256 on, in order."""
    return bytes(_level()[c] for c in piece)


def _level() -> dict[str, int]:
    if not _letters:
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in set(own)]
        _letters.update({chr(b): b for b in own} | {chr(256 + n): b for n, b in enumerate(rest)})
    return _letters


_letters: dict[str, int] = {}


def _bytes_of_piece(piece: str) -> bytes:
    if re.fullmatch("<0x[0-9A-F]{2}>", piece):
        return bytes([int(piece[3:5], 16)])
    return piece.replace(_SPACE, " ").encode()


class Pair:
    """Texts to the ids of a byte-level tokenizer (A) and of a sentencepiece model (B).

    Neither joins what stands on both sides of a space after other than white space. So texts are cut there, and each unit is
    encoded once as long as it is remembered.
    """

    def __init__(self, tokenizer_json: str, model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals the work out
        self.a = Tokenizer.from_str(tokenizer_json)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        # Names of special tokens are no byte-level text, nor are they ever given.
        names = [self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size(with_added_tokens=True))]
        added = self.a.get_added_tokens_decoder()
        self.bytes_a = [b"" if i in added else _bytes_of_level(n) for i, n in enumerate(names)]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [_bytes_of_piece(p) for p in pieces]
        self.sizes_a, self.sizes_b = (np.array(list(map(len, t)), np.int64) for t in (self.bytes_a, self.bytes_b))
        inner = any(_SPACE in p.lstrip(_SPACE) for p in pieces)
        self.units = _whole if inner else re.compile(r"(?<=\S)(?= [\s\S])").split  # a last space stays: alone it would be no text to B
        self.known: dict[str, tuple[bytes, bytes]] = {}

    def _side_by_side(self, units: list[str], ids: Callable, sizes: np.ndarray) -> Iterable[bytes]:
        """Ids of units, many in one string; their bytes tell them apart again."""
        for start in range(0, len(units), _AT_ONCE):
            some = units[start : start + _AT_ONCE]
            found = np.array(ids("".join(some)), "<u4")
            ends = np.searchsorted(np.cumsum(sizes[found]), np.cumsum([len(u.encode()) for u in some])) + 1
            for lo, hi in zip([0, *ends[:-1]], ends):
                yield found[lo:hi].tobytes()

    def _new(self, units: list[str]) -> dict[str, tuple[bytes, bytes]]:
        # A unit that ends in white space, the sign for a space or nothing is encoded by itself.
        plain = [u for u in units if not u[-1:].isspace() and _SPACE not in u]
        ids_a = lambda text: self.a.encode(text, add_special_tokens=False).ids
        ids_b = lambda text: self.b.encode(text[1:])  # noqa: E731  (the model adds the space)
        sides = zip(self._side_by_side(plain, ids_a, self.sizes_a), self._side_by_side(plain, ids_b, self.sizes_b))
        found = dict(zip(plain, sides))
        for u in units:
            if u not in found:
                found[u] = tuple(np.array(ids(u), "<u4").tobytes() for ids in (ids_a, ids_b))
        return found

    def encode(self, texts: list[str]) -> tuple[list[bytes], list[bytes]]:
        """The ids of every text, as packed numbers: by A with a space in front, by B, which adds one."""
        rows = [self.units(" " + t) for t in texts]
        asked = set(chain.from_iterable(rows))
        found = {u: self.known[u] for u in asked if u in self.known}
        new = self._new([u for u in asked if u not in found])
        found.update(new)
        if len(self.known) + len(new) > REMEMBERED:
            self.known = {}
        self.known.update((u, ids) for u, ids in new.items() if len(u) <= REMEMBERED_CHARS)
        both = [[found[u] for u in row] for row in rows]
        return tuple([b"".join([ids[side] for ids in row]) for row in both] for side in (0, 1))

    def whole(self, texts: list[str], a: list[bytes], b: list[bytes]) -> list[bool]:
        """Which texts both tokenizers give back byte by byte, and are not empty."""
        out = []
        for text, *sides in zip(texts, a, b):
            wanted = b" " + text.encode()
            ids = [np.frombuffer(side, "<u4").tolist() for side in sides]
            out.append(
                bool(text) and all(b"".join([t[i] for i in own]) == wanted for t, own in zip((self.bytes_a, self.bytes_b), ids))
            )
        return out


def _whole(text: str) -> list[str]:
    return [text]


def _written(pair: Pair) -> tuple[np.ndarray, np.ndarray]:
    """Each id as it stands in the written groups: within its side, then as the last of it."""
    out = []
    for size, last in ((len(pair.bytes_a), "|"), (len(pair.bytes_b), ";")):
        out.append(np.array([f"{i}{sign}" for sign in (",", last) for i in range(size)], object))
    return tuple(out)


def _align(texts: list[str], pair: Pair, written: tuple, work: int) -> list[list]:
    """Columns of ``_LINKS`` but for the id. All texts of a slice are one merge: each ends with an end of both."""
    coded = pair.encode(texts)
    fine = pair.whole(texts, *coded)
    coded = [[ids if ok else b"" for ids, ok in zip(side, fine)] for side in coded]
    n_a, n_b = (np.array([len(ids) // 4 for ids in side], np.int64) for side in coded)
    ids_a, ids_b = (np.frombuffer(b"".join(side), "<u4").astype(np.int64) for side in coded)
    ends_a, ends_b = np.cumsum(pair.sizes_a[ids_a]), np.cumsum(pair.sizes_b[ids_b])
    group_a, group_b, _, _ = merge_path(ends_a, ends_b, work)
    # The last of a side in a group; there both end, so these are the links.
    last_a, last_b = (np.append(np.diff(g) != 0, True)[: len(g)] for g in (group_a, group_b))
    linked_a, linked_b = ids_a[last_a], ids_b[last_b]
    doc_of = np.searchsorted(np.cumsum(n_a), np.flatnonzero(last_a), side="right")
    n_groups = np.bincount(doc_of, minlength=len(texts))

    order = np.lexsort((linked_a << 32 | linked_b, doc_of))
    pairs, docs = (linked_a << 32 | linked_b)[order], doc_of[order]
    new = np.flatnonzero(np.append(True, (np.diff(pairs) != 0) | (np.diff(docs) != 0))[: len(pairs)])
    times = np.diff(np.append(new, len(pairs)))
    offsets = pa.array(np.searchsorted(docs[new], np.arange(len(texts) + 1)), pa.int32())

    # A's tokens of a group, then B's: a token comes after all of the other side that stand before it.
    sizes_a, sizes_b = np.bincount(group_a), np.bincount(group_b)
    row = np.empty(len(ids_a) + len(ids_b), object)
    row[np.arange(len(ids_a)) + (np.cumsum(sizes_b) - sizes_b)[group_a]] = written[0][ids_a + last_a * len(pair.bytes_a)]
    row[np.arange(len(ids_b)) + np.cumsum(sizes_a)[group_b]] = written[1][ids_b + last_b * len(pair.bytes_b)]
    stops = np.cumsum(n_a + n_b).tolist()
    groups = ["".join(row[lo:hi].tolist())[:-1] for lo, hi in zip([0, *stops[:-1]], stops)]
    return [
        pa.array(n_a), pa.array(n_b), pa.array(n_groups), pa.array(n_groups), pa.array(groups, pa.string()),
        pa.ListArray.from_arrays(offsets, pa.array(pairs[new])), pa.ListArray.from_arrays(offsets, pa.array(times)),
    ]


def _batches(shared_a, shared_b, work: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, written = _pair(shared_a.value, shared_b.value)
        names = [c.split()[0] for c in _LINKS.split(", ")]
        for batch in batches:
            for part in bounded_slices(batch, 1, _SLICE):
                columns = _align(part.column(1).to_pylist(), pair, written, work)
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], names)

    return run


@lru_cache(maxsize=1)
def _pair(tokenizer_json: str, model: bytes) -> tuple:
    """One per Python worker."""
    pair = Pair(tokenizer_json, model)
    return pair, _written(pair)


def align(
    df: DataFrame,
    tokenizer_json: str,
    model: bytes,
    id_column: str = "doc_id",
    text_column: str = "text",
    work: int = WORK,
) -> DataFrame:
    """Where the tokens of a byte-level tokenizer (A) and of a sentencepiece model (B) end together in a text.

    Per row: ``doc_id``; ``n_a`` and ``n_b`` tokens; ``n_groups``, the runs of tokens between places where both end;
    ``groups``, those as text (``a1,a2|b1;a3|b2,b3``: ids in order); ``n_links``, pairs of an A and a B token that end
    together; ``pairs``, the different pairs of ids among these (A's in the upper 32 bits), and how many ``times`` each.

    A is given the text with a space in front, B the text, to which it adds one; names of special tokens are plain
    text. A task aligns about two megabytes of texts at once, or one longer text, in pieces of ``work`` ends. No text,
    an empty one, or one that either tokenizer does not give back byte by byte: no tokens. Null ids stay null; repeated rows are a
    row each. An empty table gives no rows; other columns are dropped, whatever their names.
    """
    spark = df.sparkSession
    ship_package(spark)
    # A few megabytes, whatever the input.
    shared = [spark.sparkContext.broadcast(value) for value in (tokenizer_json, model)]
    return texts(df, id_column, text_column).mapInArrow(_batches(*shared, work), _LINKS)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``pair``, ``count`` (links of the whole corpus) and ``best``: whether no pair of the same B id has more."""
    pairs = aligned.select(F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("p.*")
    counted = pairs.groupBy(F.col("pairs").alias("pair")).agg(F.sum("times").alias("count"))
    # One B id has at most as many pairs as A has ids.
    of_b = Window.partitionBy(F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)))
    return counted.withColumn("best", F.col("count") == F.max("count").over(of_b))


def with_counts(aligned: DataFrame, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """``aligned`` without its arrays, with ``n_best`` (links whose pair is a best one of its B id) and ``count_sum``
    (the counts of all links).

    ``aligned`` is read twice, so it should be staged. Up to ``broadcast_pairs`` counts are broadcast; more are joined by a
    shuffle, where adaptive execution splits a frequent pair.
    """
    counts = stage(pair_counts(aligned), "pair-counts")
    small = counts.count() <= broadcast_pairs
    marked = aligned.withColumn("row", F.monotonically_increasing_id())
    links = marked.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select(
        "row", F.col("p.pairs").alias("pair"), "p.times"
    )
    found = links.join(counts.hint("broadcast" if small else "shuffle_merge"), "pair")
    sums = found.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(F.lit(0))).alias("n_best"),
        F.sum(F.col("times") * F.col("count")).alias("count_sum"),
    )
    none = F.lit(0).cast("long")
    return marked.drop("pairs", "times").join(sums, "row", "left").drop("row").withColumns(
        {c: F.coalesce(c, none) for c in ("n_best", "count_sum")}
    )


def digests(
    df: DataFrame,
    tokenizer_json: str,
    model: bytes,
    id_column: str = "doc_id",
    text_column: str = "text",
    broadcast_pairs: int = BROADCAST_PAIRS,
) -> DataFrame:
    """``align`` and ``with_counts`` in one, the groups as ``groups_sha256`` ('' without tokens). Cases as there.

    What is staged on the way (the pairs of each text) goes when the result is written.
    """
    def build() -> DataFrame:
        aligned = align(df, tokenizer_json, model, id_column, text_column)
        digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise(F.lit("")).alias("groups_sha256")
        slim = aligned.select("doc_id", "n_a", "n_b", "n_groups", "n_links", digest, "pairs", "times")
        return with_counts(stage(slim, "aligned"), broadcast_pairs)

    return finished(df.sparkSession, "alignment", build)
