"""CSV files with line breaks inside quotes, read in pieces by many tasks.

Spark reads such a file as a whole, as a break may end a record or belong to a field. Here a first pass counts the quotes of
each piece. A piece begins inside quotes if the pieces before it hold an odd number of them, so the second pass knows
where records begin and reads all pieces at once. Records over the border of two pieces are put together from their parts.

The feed has to quote strictly (RFC 4180): a quote stands at either end of a field, or doubled within one. A quote inside a
field without quotes would mislead the count.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# A record of more characters fails: a quote is missing somewhere, and all that follows would be one record.
MAX_RECORD = 64 * 1024 * 1024

# What a part of the text is: a whole record, the first of its file, or the parts of one over the borders of pieces.
_WHOLE, _HEADER, _HEAD, _INNER, _TAIL = "whole", "header", "head", "inner", "tail"
_PIECE = ("file", "start")
_PARTS = "file string, start long, kind string, record string"


def _lines(spark: SparkSession, path: str | list[str], encoding: str) -> DataFrame:
    """The lines of all files, with the piece each begins in; a carriage return before the break is kept."""
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.col("_metadata.file_block_length").alias("length"),
        F.decode(F.col("value").cast("binary"), encoding).alias("line"),
    )


def _pieces(lines: DataFrame) -> DataFrame:
    """One row a piece: whether it begins and ends inside quotes. As many rows as Spark has splits in its own list.

    A quote left open at the end of a file fails.
    """
    quotes = F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit("")))
    counted = lines.groupBy(*_PIECE, "length").agg(F.sum(quotes).alias("quotes"))
    upto = Window.partitionBy("file").orderBy("start")
    read = counted.withColumn("after", F.sum("quotes").over(upto) % 2 == 1)
    last = F.lead("start").over(upto).isNull()
    left_open = F.raise_error(F.concat(F.lit("a quote is left open in "), F.col("file"))).cast("boolean")
    return read.select(
        *_PIECE, "length",
        (F.col("quotes") % 2 == F.when(F.col("after"), 0).otherwise(1)).alias("inside"),
        F.when(last & F.col("after"), left_open).otherwise(F.col("after")).alias("after"),
    )


class _Piece:
    """Cuts the lines of one piece, which come in order and in batches, into records."""

    def __init__(self, file: str, start: int, inside: bool, max_record: int):
        self.file, self.start, self.open, self.max_record = file, start, inside, max_record
        self.held: list[str] = []
        self.size = 0
        self.kind = _TAIL if inside else _HEADER if start == 0 else _WHOLE

    def cut(self, lines: pd.Series) -> Iterator[tuple[str, str]]:
        odd = lines.str.count('"').to_numpy() % 2 == 1
        for line, turns in zip(lines.to_numpy(), odd):
            self.held.append(line)
            self.size += len(line) + 1
            self.open ^= bool(turns)
            if self.size > self.max_record and (self.open or len(self.held) > 1):
                raise ValueError(f"a record of {self.file} from byte {self.start} on is longer than {self.max_record}")
            if not self.open:
                record = "\n".join(self.held)
                yield self.kind, record
                # Empty lines may stand before a header.
                self.kind = self.kind if self.kind == _HEADER and not record.strip() else _WHOLE
                self.held, self.size = [], 0

    def end(self) -> Iterator[tuple[str, str]]:
        """What goes on in the next piece."""
        if self.held and self.kind == _HEADER:
            raise ValueError(f"the header of {self.file} does not end in its first piece")
        if self.held:
            yield (_INNER if self.kind == _TAIL else _HEAD), "\n".join(self.held)


def _parts(lines: DataFrame, pieces: DataFrame, max_record: int) -> DataFrame:
    """Records and parts of such, cut by the tasks that scan the lines; a piece is one task's, so its lines stay in order."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        piece: _Piece | None = None

        def frame(found: list[tuple[str, str]]) -> pd.DataFrame:
            kinds, records = zip(*found)
            return pd.DataFrame({"file": piece.file, "start": piece.start, "kind": kinds, "record": records})

        for batch in batches:
            # A task may hold several pieces, one after the other.
            where = (batch["file"] != batch["file"].shift()) | (batch["start"] != batch["start"].shift())
            for _, rows in batch.groupby(where.cumsum(), sort=False):
                first = rows.iloc[0]
                if piece is None or (piece.file, piece.start) != (first["file"], first["start"]):
                    if piece and (found := list(piece.end())):
                        yield frame(found)
                    piece = _Piece(first["file"], int(first["start"]), bool(first["inside"]), max_record)
                if found := list(piece.cut(rows["line"])):
                    yield frame(found)
        if piece and (found := list(piece.end())):
            yield frame(found)

    # Between the two passes a file, or the way Spark splits it, could have changed.
    unknown = F.raise_error(F.concat(F.lit("changed between two passes: "), F.col("file"))).cast("boolean")
    marked = lines.join(F.broadcast(pieces.drop("after")), [*_PIECE, "length"], "left").select(
        *_PIECE, F.coalesce("inside", unknown).alias("inside"), "line"
    )
    return marked.mapInPandas(cut, _PARTS)


def _stitched(parts: DataFrame) -> DataFrame:
    """Records over the border of pieces. A file's parts meet in one task: of each piece at most the end of one record and
    the beginning of another."""
    order = Window.partitionBy("file").orderBy("start", (F.col("kind") == _HEAD).cast("int"))
    begun = parts.withColumn("nth", F.count_if(F.col("kind") == _HEAD).over(order))
    texts = F.transform(F.array_sort(F.collect_list(F.struct("start", "record"))), lambda p: p["record"])
    return begun.groupBy("file", "nth").agg(F.array_join(texts, "\n").alias("record")).select(
        "file", F.lit(_WHOLE).alias("kind"), "record"
    )


def read_quoted_csv(
    spark: SparkSession, path: str | list[str], columns: list[str], encoding: str, max_record: int = MAX_RECORD
) -> DataFrame:
    """The records of strictly quoted CSV files as columns of text, in no order; every file begins with a header.

    Equal to Spark's own reading with ``multiLine``, but for breaks of two characters within quotes: they stay, where
    Spark makes one of them in files whose lines end so. Fails on a header other than ``columns``, which must stand in one
    piece, on a record with another number of fields, on a quote that is never closed, and if the files change meanwhile. Blank
    lines are no records, and an empty file has none.
    """
    lines = _lines(spark, path, encoding)
    read = _pieces(lines)
    # Computed once; it also says whether any record lies over a border, which is rare.
    found = read.collect()
    pieces = spark.createDataFrame(found, read.schema)
    parts = _parts(lines, pieces, max_record)
    records = parts.filter(F.col("kind").isin(_WHOLE, _HEADER)).select("file", "kind", "record")
    if any(row["inside"] for row in found):
        torn = pieces.filter(F.col("inside") | F.col("after")).select(*_PIECE)
        near_borders = _parts(lines.join(F.broadcast(torn), [*_PIECE], "left_semi"), pieces, max_record)
        over = _stitched(near_borders.filter(F.col("kind").isin(_HEAD, _INNER, _TAIL)))
        records = records.unionByName(over)
    # A carriage return at the end belongs to the line's end.
    text = F.regexp_replace("record", "\r$", "")
    options = {"quote": '"', "escape": '"', "mode": "FAILFAST", "multiLine": "true"}
    schema = ", ".join(f"`{name}` string" for name in columns)
    parsed = (
        records.withColumn("record", text)
        .filter(F.trim("record") != "")
        .select("file", "kind", F.from_csv("record", schema, options).alias("row"))
    )
    named = F.lit(True)
    for name in columns:
        named = named & F.col(f"row.`{name}`").eqNullSafe(F.lit(name))
    other = F.raise_error(F.concat(F.lit("another header in "), F.col("file"))).cast("boolean")
    is_line = F.when(F.col("kind") != _HEADER, True).when(named, False).otherwise(other)
    return parsed.filter(is_line).select("row.*")
