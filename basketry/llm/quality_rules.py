"""Line-first cleaning: rules per line, failing lines go, documents that lose too much text are rejected."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from basketry.llm.common import bounded_slices, ship_package, texts

# How a line of prose may end, what separates entries of a menu, phrases of page furniture.
TERMINAL = ".!?…:;。！？"
CLOSERS = "\"'”’»)]}"
SYMBOLS = b"#*$%&|<>"
SEPARATORS = (b"|", b">", b"<", b"/", b"-", "»".encode(), "›".encode(), "·".encode(), "•".encode())
BOILERPLATE = (
    "all rights reserved", "click here", "cookie policy", "enable javascript", "javascript is disabled",
    "log in to", "lorem ipsum", "privacy policy", "read more", "share this", "sign up for", "skip to content",
    "subscribe to", "terms of service", "terms of use", "use cookies",
)

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_LOST = 0.5  # share of the characters in words that failing lines may hold
SENTENCE_WORDS = 30  # a line without an end must have an ended sentence for so many words
MAX_SYMBOLS_PER_WORD = 0.5
MAX_SEPARATORS = 0.2
MIN_SHOUTED_WORDS = 5
MAX_UPPER = 0.7  # share of words in capitals

_boilerplate = re.compile("|".join(map(re.escape, BOILERPLATE)), re.IGNORECASE)
_SCHEMA = (
    "doc_id long, clean_text string, n_words long, word_chars long, n_symbols long, n_dup_lines long,"
    " n_repeat_words long, n_lines long, n_failed_lines long, lost_chars long, base_failed boolean, kept boolean"
)


def repeated_words(words: list[bytes]) -> int:
    """Words inside three-word windows that the text holds twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    counts = Counter(windows)
    n = covered = 0  # covered: words up to here are counted
    for i, window in enumerate(windows):
        if counts[window] > 1:
            n += i + 3 - max(i, covered)
            covered = i + 3
    return n


def line_fails(line: str, words: list[bytes]) -> bool:
    """A line fails as unpunctuated, as navigation or as boilerplate."""
    ending = line.rstrip()[-1:]
    if ending not in TERMINAL and ending not in CLOSERS:
        # Prose that breaks off has sentences that end before.
        if SENTENCE_WORDS * sum(w[-1:] in b".!?" for w in words) < len(words):
            return True
    joined = b"".join(words)
    if len(joined) - len(joined.translate(None, SYMBOLS)) > MAX_SYMBOLS_PER_WORD * len(words):
        return True
    if sum(map(words.count, SEPARATORS)) > MAX_SEPARATORS * len(words):
        return True
    if len(words) >= MIN_SHOUTED_WORDS and sum(map(bytes.isupper, words)) > MAX_UPPER * len(words):
        return True
    return _boilerplate.search(line) is not None


def judge(text: str) -> tuple:
    """The columns after ``doc_id``."""
    data = text.encode()
    words = data.split()  # bytes split at ASCII white space only
    size = len(text) - (len(data) - sum(map(len, words)))
    kept_lines, seen = [], set()
    n_lines = n_dup = n_failed = lost = 0
    for line in text.split("\n"):
        raw = line.encode()
        own = raw.split()
        if not own:
            kept_lines.append(line)
            continue
        n_lines += 1
        n_dup += raw in seen
        seen.add(raw)
        own_size = len(line) - (len(raw) - sum(map(len, own)))
        if line_fails(line, own):
            n_failed += 1
            lost += own_size
        else:
            kept_lines.append(line)
    repeats = repeated_words(words)
    base_failed = len(words) < MIN_WORDS or 100 * repeats > MAX_REPEAT_PERCENT * len(words)
    kept = not base_failed and lost <= MAX_LOST * size
    symbols = len(data) - len(data.translate(None, SYMBOLS))
    return (
        "\n".join(kept_lines), len(words), size, symbols, n_dup, repeats, n_lines, n_failed, lost, base_failed, kept,
    )


def _judge_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in _SCHEMA.split(",")]
    kinds = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}
    types = [kinds[c.split()[1]] for c in _SCHEMA.split(",")]
    for batch in batches:
        for part in bounded_slices(batch, 1):
            columns = list(zip(*map(judge, part.column(1).to_pylist())))
            arrays = [part.column(0)] + [pa.array(c, t) for c, t in zip(columns, types[1:])]
            yield pa.RecordBatch.from_arrays(arrays, names)


def clean_lines(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: the text without its failing lines, the figures it was judged by, and the verdict ``kept``.

    A line fails if it does not end as prose does, is made of symbols, menu separators or capitals, or holds a
    phrase of page furniture. Lines without a word are left and not counted. A document is rejected if it has
    fewer than 50 words, if over half its words are in repeated three-word windows, or if over half of the
    characters of its words are in failing lines. Nothing is shuffled; a task holds one document's words.

    Null text: as empty, 0 everywhere, rejected. Null ids stay null; repeated rows are judged alike, one row each;
    an empty table gives no rows; other columns are dropped, whatever their names.
    """
    return texts(df, id_column, text_column).mapInArrow(_judge_batches, _SCHEMA)


def clean_documents(df: DataFrame, text_column: str = "text", size_column: str = "n_chars") -> DataFrame:
    """The rows that are kept, with their cleaned text and its length; the other columns stay as they are.

    Rows are judged where they lie: nothing is joined or shuffled. Cases as in ``clean_lines``.
    """
    ship_package(df.sparkSession)
    schema = df.schema
    at, size_at = schema.names.index(text_column), schema.names.index(size_column) if size_column in schema.names else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in bounded_slices(batch, at):
                judged = [judge(t or "") for t in part.column(at).to_pylist()]
                kept = pa.array([j[-1] for j in judged], pa.bool_())
                columns = list(part.columns)
                columns[at] = pa.array([j[0] for j in judged], part.schema.types[at])
                if size_at is not None:
                    columns[size_at] = pa.array([len(j[0]) for j in judged], pa.int64()).cast(part.schema.types[size_at])
                yield pa.RecordBatch.from_arrays(columns, schema=part.schema).filter(kept)

    return df.mapInArrow(run, schema)
