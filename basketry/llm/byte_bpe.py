"""Byte-level BPE through a sentencepiece model that is serialised straight from the vocabulary."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm.common import bounded_slices, quoted, ship_package, texts
from basketry.llm.pretokens import Remembered, read_ranks, splitter

#: The piece sentencepiece demands for the unknown. It holds a white space, which no mapped byte is.
_UNKNOWN = "unknown piece"
#: Pieces that are handed over in one string.
_AT_ONCE = 256


def byte_letters() -> list[str]:
    """A printable letter for each byte: itself where Latin-1 prints it, else the next free one from 256 on."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {b: chr(b) for b in prints}
    for i, b in enumerate(b for b in range(256) if b not in letters):
        letters[b] = chr(256 + i)
    return [letters[b] for b in range(256)]


_LETTERS = byte_letters()
_TO_LETTERS = {b: letter for b, letter in enumerate(_LETTERS)}
_TO_BYTES = {ord(letter): b for b, letter in enumerate(_LETTERS)}


def mapped(data: bytes) -> str:
    return data.decode("latin-1").translate(_TO_LETTERS)


def unmapped(piece: str) -> bytes:
    return piece.translate(_TO_BYTES).encode("latin-1")


def _varint(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


def _number(field: int, n: int) -> bytes:
    return _varint(field << 3) + _varint(n)


def _bytes(field: int, data: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(data)) + data


def serialise_model(tokens: list[bytes]) -> bytes:
    """The model file: pieces in rank order, so that ids are ranks; scores are negative ranks.

    Fixed values are the field numbers of the model format: piece 1 (text 1, score 2, type 3: 1 normal, 2 unknown),
    trainer 2 (type 3: 2 is BPE, size 4, ids of unknown 40, begin 41, end 42, padding 43, unknown's text 45),
    normaliser 3 (name 1, dummy prefix 3, white space removed 4, escaped 5).
    """
    def piece(text: str, score: float, kind: int) -> bytes:
        number = _varint(2 << 3 | 5) + np.array(score, "<f4").tobytes()
        return _bytes(1, _bytes(1, text.encode()) + number + _number(3, kind))

    parts = [piece(mapped(token), -rank, 1) for rank, token in enumerate(tokens)]
    parts.append(piece(_UNKNOWN, 0.0, 2))
    trainer = [
        _number(3, 2), _number(4, len(parts)), _number(40, len(tokens)), _number(41, -1), _number(42, -1),
        _number(43, -1), _bytes(45, _UNKNOWN.encode()),
    ]
    normaliser = [_bytes(1, b"identity"), _number(3, 0), _number(4, 0), _number(5, 0)]
    return b"".join([*parts, _bytes(2, b"".join(trainer)), _bytes(3, b"".join(normaliser))])


@lru_cache(maxsize=2)
def _processor(model: bytes) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_proto=model)


@lru_cache(maxsize=2)
def encoder(model: bytes, pattern: str):
    """Texts to ids. One per Python worker: pieces seen before are not merged again."""
    split, processor = splitter(pattern), _processor(model)

    unknown = processor.get_piece_size() - 1

    def work_out(pieces: list[str]) -> Iterator[bytes]:
        # A white space is no mapped byte, so nothing merges across it: it comes back as the unknown piece.
        for start in range(0, len(pieces), _AT_ONCE):
            part = pieces[start : start + _AT_ONCE]
            text = " ".join([mapped(p.encode()) for p in part])
            ids = np.array(processor.encode(text, out_type=int), np.int32)
            cuts = (4 * np.flatnonzero(ids == unknown)).tolist()
            data = ids.tobytes()
            yield from map(data.__getitem__, map(slice, [0, *[c + 4 for c in cuts]], [*cuts, len(data)]))

    known = Remembered(work_out)

    def encode(texts: list[str]) -> list[np.ndarray]:
        return [np.frombuffer(b"".join(ids), np.int32) for ids in known.look_up([split(text) for text in texts])]

    return encode


@lru_cache(maxsize=2)
def decoder(model: bytes):
    """Ids to bytes, by the inverse of the mapping of the model's pieces."""
    processor = _processor(model)
    pieces = [unmapped(processor.id_to_piece(i)) for i in range(processor.get_piece_size() - 1)]
    return lambda ids: b"".join(map(pieces.__getitem__, ids))


def read_model(path: str) -> bytes:
    """The model of a rank file."""
    return serialise_model(read_ranks(path))


def encode(
    df: DataFrame, model: bytes, pattern: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id`` and ``token_ids`` (array of int) of each row's whole text, without special tokens.

    ``pattern`` splits the text; every match is mapped byte by byte and merged by itself. The model (about 1 MB)
    goes out once per executor. Nothing is shuffled.

    Null or empty text: no ids. Null ids stay null; repeated rows give a row each; an empty table gives no rows;
    other columns are dropped, whatever their names.
    """
    shared = _broadcast(df.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to_ids = encoder(shared.value, pattern)
        for batch in batches:
            for part in bounded_slices(batch, 1):
                ids = _lists(to_ids(part.column(1).to_pylist()))
                yield pa.RecordBatch.from_arrays([part.column(0), ids], ["doc_id", "token_ids"])

    return texts(df, id_column, text_column).mapInArrow(run, "doc_id long, token_ids array<int>")


def decode(df: DataFrame, model: bytes, id_column: str = "doc_id", ids_column: str = "token_ids") -> DataFrame:
    """``doc_id``, ``token_ids`` and ``decoded``, the bytes the ids stand for. Null ids: no bytes."""
    shared = _broadcast(df.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to_bytes = decoder(shared.value)
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                data = [to_bytes(ids.values.to_numpy().tolist() if ids.values else ()) for ids in part.column(1)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(data, pa.binary())], ["doc_id", "token_ids", "decoded"]
                )

    rows = df.select(
        quoted(id_column).alias("doc_id"),
        F.coalesce(quoted(ids_column), F.array().cast("array<int>")).alias("token_ids"),
    )
    return rows.mapInArrow(run, "doc_id long, token_ids array<int>, decoded binary")


def _lists(rows: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum([len(r) for r in rows]))).astype(np.int32)
    values = np.concatenate(rows) if rows else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32()))


def _broadcast(spark: SparkSession, model: bytes):
    ship_package(spark)
    return spark.sparkContext.broadcast(model)
