"""Alignment of two tokenizers against ends compared one by one."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from rows import table
from tokenizers import Tokenizer

from basketry.llm import alignment, queries

ODD = [
    None, "", "x▁y z", "a  b   c \n d\n  e ", "<|endoftext|> hi <s> <0x41>", "漢字 é x  y", " lead", "a\x00b \x1c c",
    "x" * 5000, "tail  ", " ", "﻿a ﬁ Å", "word  next", "one\r\n two", "a▁ b", "\U0001f600 \U0001f600",
]


@pytest.fixture(scope="module")
def given_files():
    with open(public_tokenizers.path(queries.PIECES), "rb") as file:
        return queries._tokenizer_json(), file.read()


def plain(files, texts):
    """Rows as ``digests`` gives them, by place."""
    a, b = Tokenizer.from_str(files[0]), sentencepiece.SentencePieceProcessor(model_proto=files[1])
    a.encode_special_tokens = True
    pair = alignment.Pair(*files)
    counted, rows = Counter(), []
    for text in texts:
        sides = [a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)] if text else ([], [])
        parts = [[table_[i] for i in ids] for table_, ids in zip((pair.bytes_a, pair.bytes_b), sides)]
        if any(b"".join(p) != (" " + (text or "")).encode() for p in parts):
            sides, parts = [[], []], [[], []]
        ends = [{end: i for i, end in enumerate(np.cumsum([len(x) for x in p]).tolist())} for p in parts]
        groups, links, done = [], [], [0, 0]
        for end in sorted(set(ends[0]) & set(ends[1])):
            stops = [e[end] + 1 for e in ends]
            groups.append("|".join(",".join(map(str, ids[lo:hi])) for ids, lo, hi in zip(sides, done, stops)))
            links.append((sides[0][stops[0] - 1], sides[1][stops[1] - 1]))
            done = stops
        counted.update(links)
        rows.append((sides, groups, links))
    top = {}
    for (_, y), n in counted.items():
        top[y] = max(top.get(y, 0), n)
    return [
        (
            len(sides[0]), len(sides[1]), len(groups), len(links), sum(counted[x] == top[x[1]] for x in links),
            sum(counted[x] for x in links), hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "",
        )
        for sides, groups, links in rows
    ]


def values(row):
    return row.n_a, row.n_b, row.n_groups, row.n_links, row.n_best, row.count_sum, row.groups_sha256


@pytest.mark.parametrize("broadcast_pairs", [1000, 0])
def test_digests_of_odd_texts(spark, given_files, odd_rows, broadcast_pairs):
    rows = [(i, t) for i, t in enumerate(ODD + [t for _, t in odd_rows])]
    got = alignment.digests(table(spark, rows), *given_files, broadcast_pairs=broadcast_pairs).collect()
    want = plain(given_files, [t for _, t in rows])
    assert {r.doc_id: values(r) for r in got} == dict(enumerate(want))


def test_query_equals_plain_alignment(spark, given_files):
    folder = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    want = dict(zip([r.doc_id for r in rows], plain(given_files, [r.text for r in rows])))
    assert {r.doc_id: values(r) for r in queries.op12_token_alignment(spark, folder).collect()} == want


def test_null_ids_repeated_rows_and_empty_table(spark, given_files, empty):
    rows = [(None, "the same"), (7, "the same"), (7, "the same"), (None, None)]
    got = alignment.digests(table(spark, rows), *given_files).collect()
    assert sorted((r.doc_id or 0, r.n_links) for r in got) == [(0, 0), (0, 2), (7, 2), (7, 2)]
    assert {r.count_sum for r in got} == {0, 6}
    assert alignment.digests(empty, *given_files).count() == 0


ENDS = st.lists(st.integers(1, 4), min_size=1, max_size=80).map(lambda sizes: np.cumsum(sizes))


@settings(max_examples=80, deadline=None)
@given(ENDS, ENDS, st.integers(1, 40))
def test_pieces_of_any_size_give_the_same_groups(a, b, work):
    last = max(a[-1], b[-1])
    a, b = (np.append(side, last) if side[-1] < last else side for side in (a, b))
    group_a, group_b, over_a, over_b = alignment.merge_path(a, b, work)
    shared = sorted(set(a.tolist()) & set(b.tolist()))
    assert group_a.tolist() == [sum(s < end for s in shared) for end in a.tolist()]
    assert group_b.tolist() == [sum(s < end for s in shared) for end in b.tolist()]
    begin_a, begin_b = np.append(0, a[:-1]), np.append(0, b[:-1])
    want = {(i, j) for i in range(len(a)) for j in range(len(b)) if begin_a[i] < b[j] and begin_b[j] < a[i]}
    assert sorted(zip(over_a.tolist(), over_b.tolist())) == sorted(want)


def test_diagonals_cut_the_merge_evenly():
    a, b = np.arange(2, 400, 2), np.arange(3, 400, 3)
    merged = sorted([(e, 0) for e in a.tolist()] + [(e, 1) for e in b.tolist()])
    diagonals = np.arange(0, len(merged) + 1, 7)
    cuts = alignment.diagonal_cuts(a, b, diagonals)
    assert cuts.tolist() == [sum(side == 0 for _, side in merged[:d]) for d in diagonals.tolist()]
