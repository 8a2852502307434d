"""Token ids in files of bit-packed blocks, readable at any place without what comes before."""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from basketry.llm.common import bounded_slices, ship_package, texts

#: Ids of a block, at least; it ends with the document that fills it.
BLOCK_IDS = 1 << 16
#: Words that are encoded in one string.
_AT_ONCE = 64
#: Bytes of texts that are encoded at a time.
_SLICE = 10 << 20
#: Words without white space beyond doubt; letters before a mark; the marks.
_FINE = r"^\n?[!-~\x{A1}-\x{AC}\x{AE}-\x{24F}]+$"
_MARKED = r"^[A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{24F}]+[.,]$"
_MARKS = ".,"

_BLOCK = (
    "part int, block int, first_id long, n_ids long, width int, doc_ids array<long>, sizes array<long>, payload binary"
)


def id_width(vocabulary: int) -> int:
    """Bits that hold every id of a vocabulary."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """Ids as numbers of ``width`` bits, lowest bit first, without gaps."""
    ids = np.ascontiguousarray(ids, "<u4")
    if width in (8, 16, 32):
        return ids.astype(f"<u{width // 8}").tobytes()
    out = []
    for start in range(0, len(ids), 8 * 8192):  # eight ids end at a whole byte
        bits = np.unpackbits(ids[start : start + 8 * 8192].view(np.uint8).reshape(-1, 4), 1, bitorder="little")
        out.append(np.packbits(bits[:, :width].ravel(), bitorder="little").tobytes())
    return b"".join(out)


def unpack(payload: bytes, width: int, start: int, n: int) -> np.ndarray:
    """``n`` ids from the ``start``-th on; only the bytes that hold them are touched."""
    if width in (8, 16, 32):
        return np.frombuffer(payload, f"<u{width // 8}", n, start * width // 8).astype("<u4")
    first = start * width // 8
    data = np.frombuffer(payload, np.uint8, -(-(start + n) * width // 8) - first, first)
    bits = np.unpackbits(data, bitorder="little")[start * width - 8 * first :][: n * width].reshape(n, width)
    wide = np.zeros((n, 32), np.uint8)
    wide[:, :width] = bits
    return np.packbits(wide, 1, bitorder="little").view("<u4").ravel()


class Encoder:
    """Texts to ids, whole columns at a time.

    The tokenizer splits before white space anyway. So a text whose words are parted by single spaces and line ends is
    cut there, and the distinct words of a column are encoded once, many side by side. Any other text is encoded
    in one go.
    """

    def __init__(self, tokenizer_json: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals the work out
        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        tokens = [self.tokenizer.id_to_token(i) or "" for i in range(_size(self.tokenizer))]
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [c.ids for c in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _is_word(self, word: str) -> bool:
        return word.split() == [word] and not any(s in word for s in self.special)

    def _broken(self, words: pa.StringArray) -> np.ndarray:
        """Which of them, apart from a line end in front, are not a single word."""
        fine = pc.match_substring_regex(words, _FINE)
        for special in self.special:
            fine = pc.and_not(fine, pc.match_substring(words, special))
        broken = ~fine.to_numpy(zero_copy_only=False)
        for i in np.flatnonzero(broken):
            word = words[int(i)].as_py()
            broken[i] = not self._is_word(word[1:] if word[:1] == "\n" else word)
        return broken

    def _side_by_side(self, words: pa.StringArray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words that each begin with white space, and how many each has: no token reaches over it."""
        found = []
        for start in range(0, len(words), 500 * _AT_ONCE):  # what the library returns takes far more room than ids
            data = words.slice(start, 500 * _AT_ONCE).to_pylist()
            ids = self._ids(["".join(data[i : i + _AT_ONCE]) for i in range(0, len(data), _AT_ONCE)])
            found.append(np.fromiter(chain.from_iterable(ids), np.uint32, sum(map(len, ids))))
        flat = np.concatenate(found) if found else np.empty(0, np.uint32)
        # A token has as many letters as bytes, so bytes tell where a word's tokens end.
        ends = np.searchsorted(np.cumsum(self.lengths[flat]), np.cumsum(lengths)) + 1
        return flat, np.diff(ends, prepend=0)

    def encode(self, texts: pa.StringArray, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and how many each text has, with ``end_id`` after each if given."""
        n = len(texts)
        if not n:
            return np.empty(0, np.uint32), np.empty(0, np.int64)
        lists = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
        bounds = lists.offsets.to_numpy().astype(np.int64)
        starts, sizes = bounds[:-1] - bounds[0], np.diff(bounds)
        coded = pc.dictionary_encode(lists.flatten())
        places, words = coded.indices.to_numpy(), coded.dictionary

        # A mark after letters is a piece of its own, so words share what comes before it.
        marked = pc.match_substring_regex(words, _MARKED).to_numpy(zero_copy_only=False)
        stems = pc.if_else(pa.array(marked), pc.utf8_slice_codeunits(words, 0, -1), words)
        stems = pc.dictionary_encode(stems)
        stem_of, stems = stems.indices.to_numpy(), stems.dictionary
        broken = self._broken(stems)
        spaced = pc.if_else(pc.starts_with(stems, "\n"), stems, pc.binary_join_element_wise(" ", stems, ""))
        spaced = pc.if_else(pa.array(broken), pa.scalar(" -"), spaced)
        values, counts = self._side_by_side(spaced, pc.binary_length(spaced).to_numpy().astype(np.int64))

        # A text's first word has nothing before it; a text with anything but single words is one piece.
        inner = broken[stem_of][places]
        inner[starts] = False
        heads = words.take(pa.array(places[starts])).to_pylist()
        plain = (np.add.reduceat(inner, starts) == 0) & [self._is_word(h) for h in heads]
        firsts = self._ids([h if p else t.as_py() for h, p, t in zip(heads, plain, texts)])
        extra = [*firsts, [], [] if end_id is None else [end_id], *self._ids(list(_MARKS))]
        empty = len(stems) + n
        counts = np.concatenate((counts, [len(e) for e in extra]))
        values = np.concatenate((values, np.fromiter(chain.from_iterable(extra), np.uint32)))

        # Two entries for each word, its stem and its mark, and one for the end of each text.
        mark_of = np.full(len(words), empty)
        for i, mark in enumerate(_MARKS):
            mark_of[marked & pc.ends_with(words, mark).to_numpy(zero_copy_only=False)] = empty + 2 + i
        entries = np.stack((stem_of[places], mark_of[places].astype(np.int32)), 1)
        entries[np.repeat(~plain, sizes)] = empty
        entries[starts] = np.stack((len(stems) + np.arange(n), np.full(n, empty)), 1)
        entries = np.insert(entries.ravel(), 2 * (starts + sizes), empty + 1)
        offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
        pieces = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
        ids = pieces.take(pa.array(entries)).flatten().to_numpy()
        return ids, np.add.reduceat(counts[entries], 2 * starts + np.arange(n))


@lru_cache(maxsize=2)
def encoder(tokenizer_json: str) -> Encoder:
    """One per Python worker."""
    return Encoder(tokenizer_json)


def _size(tokenizer: Tokenizer) -> int:
    return tokenizer.get_vocab_size(with_added_tokens=True)


def _blocks(shared, end_id: int, width: int, block_ids: int):
    """Documents of a part, in order, to its blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(shared.value)
        part = block = first = n = 0
        docs: list = []
        sizes: list[int] = []
        held: list[np.ndarray] = []

        def made() -> pa.RecordBatch:
            payload = pack(np.concatenate(held), width)
            values = [part, block, first, n, width, docs, sizes, payload]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32()]
            kinds += [pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
            names = [c.split()[0] for c in _BLOCK.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names)

        for batch in batches:
            for rows in bounded_slices(batch, 1, _SLICE):
                part = rows.column(2)[0].as_py()
                ids, counts = coder.encode(rows.column(1).cast(pa.string()), end_id)
                at = 0
                for doc, count in zip(rows.column(0).to_pylist(), counts.tolist()):
                    docs.append(doc)
                    sizes.append(count)
                    held.append(ids[at : at + count])
                    at += count
                    n += count
                    if n >= block_ids:
                        yield made()
                        block, first, n = block + 1, first + n, 0
                        docs, sizes, held = [], [], []
        if docs:
            yield made()

    return run


def write_token_files(
    df: DataFrame,
    path: str,
    tokenizer_json: str,
    end_id: int,
    id_column: str = "doc_id",
    text_column: str = "text",
    block_ids: int = BLOCK_IDS,
) -> None:
    """Encode all texts and write their ids under ``path``, in ascending order of ``doc_id``.

    ``path/blocks`` holds a folder per part; parts ascend, and so do the blocks in them. A block has whole documents:
    their ids with ``end_id`` after each, packed to the fewest bits the vocabulary needs, and each document's size.
    ``path/parts`` has one row per part: how many ids come before it. So any id is found by its part, its block's
    ``first_id`` and its place, and is read without unpacking what comes before.

    The texts are dealt by ranges of ``doc_id``; a task holds one block. Null text: as empty, the end id alone. Null
    ids come first. Repeated rows and ties: each its own document, in the order of their texts. An empty table:
    files without rows. Other columns are dropped, whatever their names.
    """
    spark = df.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(tokenizer_json)
    width = id_width(_size(Tokenizer.from_str(tokenizer_json)))
    ordered = (
        texts(df, id_column, text_column).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
        .withColumn("part", F.spark_partition_id())
    )
    blocks = ordered.mapInArrow(_blocks(shared, end_id, width, block_ids), _BLOCK)
    blocks.sortWithinPartitions("part", "block").write.partitionBy("part").parquet(f"{path}/blocks")
    sizes = read_blocks(spark, path).groupBy("part").agg(F.sum("n_ids").alias("n_ids"))
    # One row for each part, so as many as the shuffle has partitions; in order, on the driver, without data.
    start, rows = 0, []
    for part, n in sorted((r["part"], r["n_ids"]) for r in sizes.collect()):
        rows.append((part, start))
        start += n
    spark.createDataFrame(rows, "part int, before long").coalesce(1).write.parquet(f"{path}/parts")


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_BLOCK).parquet(f"{path}/blocks")


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: ``doc_id``, ``start`` (ids of all documents before it) and ``token_ids``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = unpack(row["payload"], row["width"], 0, row["n_ids"])
                offsets = np.concatenate(([0], np.cumsum(row["sizes"]))).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int64)))
                starts = pa.array(row["first"] + offsets[:-1].astype(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), starts, lists], ["doc_id", "start", "token_ids"]
                )

    return _placed(spark, path).mapInArrow(run, "doc_id long, start long, token_ids array<long>")


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """As ``read_token_files``, with each document's count and CRC32 of its ids instead of the ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = memoryview(unpack(row["payload"], row["width"], 0, row["n_ids"]).tobytes())
                ends = np.cumsum(row["sizes"])
                starts = ends - row["sizes"]
                crcs = [zlib.crc32(ids[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist())]
                arrays = [row["doc_ids"], row["first"] + starts, row["sizes"], crcs]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a, pa.int64()) for a in arrays], ["doc_id", "start", "n_tokens", "ids_crc32"]
                )

    return _placed(spark, path).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _placed(spark: SparkSession, path: str) -> DataFrame:
    """Blocks with ``first``, the place of their first id in the whole."""
    parts = spark.read.schema("part int, before long").parquet(f"{path}/parts")
    return read_blocks(spark, path).join(F.broadcast(parts), "part").select(
        (F.col("first_id") + F.col("before")).alias("first"), "n_ids", "width", "doc_ids", "sizes", "payload"
    )
