"""Packing keeps all words, overfills no bin and breaks no conflict."""

import random
import re
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from basketry.llm import packing, queries

SF = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def plain_best_fit(pieces, capacity):
    bins = []
    placed = []
    for size, source, cluster in pieces:
        fits = [
            (capacity - used, b) for b, (used, sources, clusters) in enumerate(bins)
            if capacity - used >= size and source not in sources and cluster not in clusters
        ]
        if fits:
            b = min(fits)[1]
        else:
            b = len(bins)
            bins.append([0, set(), set()])
        placed.append((b, bins[b][0]))
        bins[b][0] += size
        bins[b][1].add(source)
        bins[b][2].add(cluster)
    return placed


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 20), st.integers(0, 3), st.integers(0, 6)), max_size=40))
def test_tightest_bin_without_conflict(pieces):
    pieces = sorted(pieces, key=lambda p: -p[0])
    assert packing.best_fit(*map(list, zip(*pieces)), 20) == plain_best_fit(pieces, 20) if pieces else True


def test_hot_cluster_and_source():
    placed = packing.best_fit([1] * 500, [0] * 500, list(range(500)), 100)
    assert len({b for b, _ in placed}) == 500


def check(rows, docs, capacity):
    """``docs``: id to (text, source, cluster); ids are unique."""
    by_doc, by_bin = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        if r.bin_id is not None:
            by_bin[r.bin_id].append(r)
    assert set(by_doc) == set(docs)
    for i, own in by_doc.items():
        n, at = len(WORDS.findall(docs[i][0] or "")), 0
        for k, r in enumerate(sorted(own, key=lambda r: r.piece)):
            assert (r.piece, r.from_word) == (k, at) and (r.bin_id is None) == (n == 0)
            at += r.n_words
        assert at == n
    for own in by_bin.values():
        at = 0
        for r in sorted(own, key=lambda r: r.bin_offset):
            assert r.bin_offset == at
            at += r.n_words
        assert at <= capacity
        assert len({docs[r.doc_id][1] for r in own}) == len(own) == len({docs[r.doc_id][2] for r in own})


@pytest.mark.parametrize("group_rows", [7, 8192])
def test_all_words_packed(spark, group_rows):
    r = random.Random(4)
    docs = {}
    for i in range(150):
        text = " ".join(f"w{r.randrange(9)}" for _ in range(r.choice([0, 1, 5, 30, 64, 100, 128, 200])))
        docs[i] = (text, r.choice(["a", "a", "a", "b", None]), r.choice([None, "x", *map(str, range(40))]))
    df = spark.createDataFrame([(i, *v, 1) for i, v in docs.items()], "doc_id long, text string, source string, c string, piece int")
    rows = packing.pack(df, cluster_column="c", capacity=64, group_rows=group_rows).collect()
    check(rows, docs, 64)


def test_odd_rows(odd, odd_rows, empty):
    rows = packing.pack(odd, capacity=100).collect()
    words = Counter()
    for r in rows:
        words[r.doc_id] += r.n_words
    want = Counter()
    for i, t in odd_rows:
        want[i] += len(WORDS.findall(t or ""))
    assert words == want
    assert sum(r.bin_id is None for r in rows) == sum(not t for _, t in odd_rows)
    assert packing.pack(empty).collect() == []


def test_one_row_many_times(spark):
    df = spark.createDataFrame([(1, "same words", "s")] * 300, "doc_id long, text string, source string")
    rows = packing.pack(df, group_rows=50).collect()
    assert len(rows) == 300 and len({r.bin_id for r in rows}) == 300  # all in conflict


def test_query(spark):
    docs = {
        r.doc_id: (r.text, r.source, " ".join(WORDS.findall(r.text.lower())))
        for r in spark.read.parquet(f"{SF}/documents.parquet").collect()
    }
    rows = queries.op4_best_fit_packing(spark, SF).collect()
    check(rows, docs, packing.CAPACITY)
    assert sum(r.n_words for r in rows) > 0.6 * packing.CAPACITY * len({r.bin_id for r in rows} - {None})


def test_repeated_rows_longer_than_a_bin(spark):
    rows = [(1, "w " * 25, "s"), (1, "w " * 25, "s"), (None, "v " * 20, "s"), (None, "v " * 20, "s")]
    full = packing.pack(spark.createDataFrame(rows, "doc_id long, text string, source string"), capacity=10).filter("n_words = 10")
    bins = Counter(r.bin_id for r in full.collect())
    assert len(bins) == 8 and set(bins.values()) == {1}
