"""Importance resampling against plain counts, and substrings' CRCs against zlib."""

import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from rows import PROSE, table

from basketry.llm import importance, queries

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_buckets(text):
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "").encode()
    words = WORD.findall(lowered)
    runs = [b" ".join(words[i : i + n]) for n in (1, 2) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(r) % 10_000 for r in runs]


def plain(texts, wanted):
    """``n_features, weight, score, rank`` by place, for rows of id and text without equal ids."""
    rows = [(i, *plain_buckets(t)) for i, t in texts]
    s, t = np.zeros(10_000, int), np.zeros(10_000, int)
    for held, all_buckets in ((s, [r[2] for r in rows]), (t, [plain_buckets(x)[1] for x in wanted])):
        for buckets in all_buckets:
            for b in buckets:
                held[b] += 1
    ratio = [(y + 1) * (sum(s.tolist()) + 10_000) / ((x + 1) * (sum(t.tolist()) + 10_000)) for x, y in zip(s.tolist(), t.tolist())]
    gain = [math.floor(1000 * math.log(r)) for r in ratio]
    out = {}
    for i, words, buckets in rows:
        weight = sum(gain[b] for b in buckets) // len(buckets) if buckets else 0
        h = int(hashlib.sha256(f"7:{i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out[i] = [len(buckets), weight, score, None, words]
    able = sorted((i for i in out if out[i][4] >= 20), key=lambda i: (-out[i][2], i))
    for rank, i in enumerate(able[: 25 * len(able) // 100], 1):
        out[i][3] = rank
    return {i: tuple(v[:4]) for i, v in out.items()}


def test_query_equals_plain_counts(spark):
    folder = "/root/testdata/sf0.01"
    read = lambda name: spark.read.parquet(f"{folder}/{name}.parquet").collect()
    want = plain([(r.doc_id, r.text) for r in read("documents")], [r.text for r in read("benchmark")])
    got = queries.op13_importance_resampling(spark, folder)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert {r.doc_id: (r.n_features, r.weight, r.score, r["rank"]) for r in got.collect()} == want


def test_odd_rows(spark, odd, odd_rows):
    got = importance.resample(odd, table(spark, [(1, PROSE), (2, None)])).collect()
    assert len(got) == len(odd_rows)
    able = sum(plain_buckets(t)[0] >= 20 for _, t in odd_rows)
    ranks = sorted(r["rank"] for r in got if r["rank"])
    assert ranks == list(range(1, able * 25 // 100 + 1))
    assert {(r.n_features, r.weight) for r in got if r.doc_id in (4, 5)} == {(0, 0)}


def test_repeated_rows_share_out_the_ranks(spark):
    rows = [(1, PROSE)] * 30 + [(None, PROSE)] * 10 + [(2, "few words")]
    got = importance.resample(table(spark, rows), table(spark, [(1, PROSE)])).collect()
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 11))


def test_empty_tables(spark, empty):
    assert importance.resample(empty, empty).count() == 0
    assert importance.resample(table(spark, [(1, PROSE)] * 4), empty).filter("rank is not null").count() == 1


def test_target_like_documents_are_drawn_first(spark):
    rows = [(i, "alpha beta gamma delta " * 10) for i in range(30)] + [(100 + i, "omega psi chi phi " * 10) for i in range(90)]
    got = importance.resample(table(spark, rows), table(spark, [(1, "alpha beta gamma delta " * 3)])).collect()
    drawn = [r for r in got if r["rank"]]
    assert sum(r.doc_id < 30 for r in drawn) > sum(r.doc_id >= 30 for r in drawn)


WORDS = st.lists(st.lists(st.binary(min_size=1, max_size=40).filter(lambda w: b" " not in w), max_size=12), max_size=5)


@settings(max_examples=60, deadline=None)
@given(WORDS, st.integers(1, 4))
def test_crcs_of_runs_follow_from_prefixes(rows, longest):
    owners = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    crcs, of = importance.ngram_crcs([w for r in rows for w in r], owners, longest)
    for at, row in enumerate(rows):
        want = [zlib.crc32(b" ".join(row[i : i + n])) for n in range(1, longest + 1) for i in range(len(row) - n + 1)]
        assert crcs[of == at].tolist() == want


@pytest.mark.parametrize("length", [0, 1, 255, 70_000, 1 << 20])
def test_shift_cancels_a_prefix(length):
    head, tail = b"some prefix", bytes(length)
    whole = zlib.crc32(tail, zlib.crc32(head))
    assert whole ^ int(importance.shifted(np.array([zlib.crc32(head)]), np.array([length]))[0]) == zlib.crc32(tail)
