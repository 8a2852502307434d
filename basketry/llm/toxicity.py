"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import quoted, texts

#: Labelled rows of each class that the model is fitted on, at most: those whose ids hash lowest.
SAMPLE_PER_CLASS = 2500
#: Hashes have so many bits. The weights are kept by hash, not in an array, so a wide space costs nothing.
HASH_BITS = 40
#: Features in fewer fitted documents than this cannot pass the L1 threshold and are left out before.
MIN_DOCUMENTS = 4
ALPHA, BETA, L1, L2 = 2.0, 1.0, 6.0, 0.1
EPOCHS = 20
THRESHOLD = 0.7
#: Letters of a word's stem, so that inflected forms share a feature.
STEM = 5
#: Spread of the four kinds: words, pairs of neighbours, pairs with one word between, stems.
_KINDS = tuple(
    np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)
)

_words = re.compile(r"\w+").findall


class _Hashes(dict):
    """Hash of each word met; starts anew when full."""

    def __missing__(self, word: str) -> int:
        if len(self) > 300_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_hashes = _Hashes()


def features(text: str) -> np.ndarray:
    """Hashes of lower-case words, pairs of neighbours, pairs with one word between, and stems; repeats included."""
    words = _words(text.lower())
    single = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    stems = np.fromiter(map(_hashes.__getitem__, [w[:STEM] for w in words]), np.uint64, len(words))
    kinds = [single * _KINDS[0], stems * _KINDS[3]]
    for gap, spread in ((1, _KINDS[1]), (2, _KINDS[2])):
        left, right = single[:-gap], single[gap:]
        kinds.append(((left ^ (left >> np.uint64(29))) * spread + right) * _KINDS[0])
    return np.concatenate(kinds) >> np.uint64(64 - HASH_BITS)


@dataclass(frozen=True)
class Weights:
    """The features that the L1 term left, sorted, with their weights."""

    keys: np.ndarray
    values: np.ndarray
    bias: float

    def __post_init__(self):
        low = np.zeros(1 << 16, bool)
        low[(self.keys & np.uint64(0xFFFF)).astype(np.int64)] = True
        object.__setattr__(self, "_low", low)

    def score(self, text: str) -> float:
        """Probability of the label 1; of an empty text, that of the bias alone."""
        found = features(text)
        found = found[self._low[(found & np.uint64(0xFFFF)).astype(np.int64)]]
        margin = self.bias
        if len(found) and len(self.keys):
            found = np.unique(found)
            at = np.minimum(np.searchsorted(self.keys, found), len(self.keys) - 1)
            margin += float(self.values[at][self.keys[at] == found].sum())
        return 1.0 / (1.0 + np.exp(-np.clip(margin, -35.0, 35.0)))


def fit(rows: list[np.ndarray], labels: np.ndarray) -> Weights:
    """FTRL-proximal: every coordinate has its own rate, and stays exactly 0 until it passes the L1 threshold."""
    keys, inverse = np.unique(np.concatenate([np.unique(r) for r in rows] or [np.empty(0, np.uint64)]), return_inverse=True)
    documents = np.bincount(inverse, minlength=len(keys))
    keys = keys[documents >= MIN_DOCUMENTS]
    z, n = np.zeros(len(keys) + 1), np.zeros(len(keys) + 1)  # the last is the bias, which L1 spares
    l1 = np.full(len(z), L1)
    l1[-1] = 0.0
    places = []
    for row in rows:
        row = np.unique(row)
        at = np.searchsorted(keys, row)
        known = at < len(keys)
        known[known] = keys[at[known]] == row[known]
        places.append(np.concatenate((at[known], [len(keys)])))

    def weights(at):
        shrunk = np.sign(z[at]) * np.maximum(np.abs(z[at]) - l1[at], 0.0)
        return -shrunk / ((BETA + np.sqrt(n[at])) / ALPHA + L2)

    order = np.random.default_rng(0)
    for _ in range(EPOCHS):
        for i in order.permutation(len(rows)):
            at = places[i]
            w = weights(at)
            gradient = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35.0, 35.0))) - labels[i]
            sigma = (np.sqrt(n[at] + gradient * gradient) - np.sqrt(n[at])) / ALPHA
            z[at] += gradient - sigma * w
            n[at] += gradient * gradient
    w = weights(np.arange(len(z)))
    some = w[:-1] != 0
    return Weights(keys[some], w[:-1][some], float(w[-1]))


def held_out(id_column: Column) -> Column:
    """Rows no label may be learnt from: the CRC32 of the id as text leaves 1 when divided by three."""
    return F.coalesce(F.crc32(id_column.cast("string")) % 3 == 1, F.lit(False))


def train(
    documents: DataFrame, labels: DataFrame, label_column: str = "toxic", per_class: int = SAMPLE_PER_CLASS
) -> Weights:
    """Fit on a bounded sample: of each class the ``per_class`` labelled rows, not held out, that hash lowest.

    The features are made where the documents lie; what is gathered is the sample's features.
    Rows with a null id or label, ids labelled both ways, and labels without a document, are passed over. Of repeated
    rows of one id one counts, combined before the shuffle, so the sample does not grow with copies. Without both
    classes the score is 0.5 for all.
    """
    usable = labels.select(quoted("doc_id").cast("long").alias("doc_id"), quoted(label_column).alias("y")).filter(
        F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & ~held_out(F.col("doc_id"))
    )
    agreed = usable.groupBy("doc_id").agg(F.min("y").alias("y"), F.max("y").alias("other")).filter("y = other").drop("other")
    low = F.xxhash64("doc_id")
    chosen = [agreed.filter(F.col("y") == y).orderBy(low, "doc_id").limit(per_class) for y in (0, 1)]
    sample = chosen[0].union(chosen[1])  # at most twice ``per_class`` rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.unique(features(t.as_py())).astype(np.int64) for t in batch.column(1)]
            keys = pa.array(found, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), keys], ["doc_id", "y", "keys"])

    hashed = texts(documents).join(F.broadcast(sample), "doc_id").select("doc_id", "text", "y")
    rows = hashed.mapInArrow(run, "doc_id long, y int, keys array<long>")

    def fit_all(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("doc_id", kind="stable")
        found = fit([np.asarray(k).astype(np.uint64) for k in frame["keys"]], frame["y"].to_numpy(float))
        keys = np.append(found.keys.astype(np.int64), -1)
        return pd.DataFrame({"key": keys, "weight": np.append(found.values, found.bias)})

    # One group of bounded size: the sample.
    once = rows.groupBy("doc_id").agg(F.min("y").alias("y"), F.min("keys").alias("keys"))
    grouped = once.withColumn("sample", F.lit(0)).groupBy("sample")
    fitted = grouped.applyInPandas(fit_all, "key long, weight double").toPandas().sort_values("key")
    bias = fitted.loc[fitted["key"] == -1, "weight"]
    rest = fitted[fitted["key"] >= 0]
    return Weights(
        rest["key"].to_numpy(np.uint64), rest["weight"].to_numpy(float), float(bias.iloc[0]) if len(bias) else 0.0
    )


def score(df: DataFrame, weights: Weights, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id``, ``score`` (0 to 1) and ``predicted`` (1 from 0.7 on) of each row's whole text.

    The weights that are not 0 go out with the tasks: a few thousand, bounded by the fitted sample. Nothing is
    shuffled. Null or empty text: the bias alone. Null ids stay null; repeated rows score alike, a row each;
    an empty table gives no rows; other columns are dropped, whatever their names.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = pa.array([weights.score(t.as_py()) for t in batch.column(1)], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), scores], ["doc_id", "score"])

    scored = texts(df, id_column, text_column).mapInArrow(run, "doc_id long, score double")
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
