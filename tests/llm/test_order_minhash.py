"""Order MinHash against a plain version of the same definition."""

import hashlib
import re
import struct
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from basketry.llm import order_minhash as om
from basketry.llm import queries


def _signed(u):
    return u - (1 << 64) if u >> 63 else u


def _hash(*values):
    seed = 42
    for kind, value in values:
        data = value.encode() if kind == "s" else struct.pack("<" + kind, value)
        seed = xxhash.xxh64_intdigest(data, seed)
    return _signed(seed)


def plain(text, k=om.K, size=om.TUPLE, tuples=om.TUPLES):
    words = re.findall(r"[^\x20\x09-\x0D]{1,16}", text)
    n = len(words)
    kmers = [_hash(*[("s", w) for w in words[i : i + k]]) for i in range(max(n - k + 1, min(n, 1)))]
    seen, order = Counter(), []
    for i, x in enumerate(kmers):
        order.append((x if not seen[x] else _hash(("q", x), ("i", seen[x])), i))
        seen[x] += 1
    out = []
    for t in range(tuples):
        start = -(1 << 63) + t * ((1 << 64) // tuples)
        taken = sorted(order, key=lambda e: ((e[0] - start) % (1 << 64), e[1]))[:size]
        mix = 42
        for x, _ in sorted(taken, key=lambda e: e[1]):
            mix = _hash(("q", mix), ("q", x))
        out.append(mix & 0xFFFFFFFF)
    return out


def test_odd_rows(odd, odd_rows):
    found = Counter((r.doc_id, r.text, tuple(r.fingerprint)) for r in om.fingerprints(odd).collect())
    assert found == Counter((i, t or "", tuple(plain(t or ""))) for i, t in odd_rows)


def test_empty_table(empty):
    assert om.fingerprints(empty).collect() == []


def test_order_counts(spark):
    words = [f"w{i}" for i in range(400)]
    same = " ".join(words)
    moved = " ".join(words[200:] + words[:200])
    other = " ".join(f"v{i}" for i in range(400))
    rows = spark.createDataFrame([(same, same), (same, moved), (same, other)], "a string, b string")
    marked = om.add_fingerprints(rows, {"a": "x", "b": "y"})
    equal, shuffled, apart = [r[0] for r in marked.select(om.likeness(F.col("x"), F.col("y"))).collect()]
    assert equal == 1.0 and apart == 0.0
    assert 0.2 < shuffled < 0.8  # nearly the same k-mers, but half the pairs are in another order


@pytest.mark.parametrize("ids", [[5, 3, 9, 1], [4], [7, 7, 2, None], [None, None], list(range(100))])
def test_next_rows(spark, ids):
    rows = [(i, f"t{n}") for n, i in enumerate(ids)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = om.with_next(df, "doc_id", "text").collect()
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    want = {(i, t): order[(n + 1) % len(order)][1] for n, (i, t) in enumerate(order)}
    assert {(r.doc_id, r.text): r.next_text for r in got} == want and len(got) == len(rows)


def test_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in queries.op1_order_minhash(spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy(F.desc("doc_id")).select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for n, (doc_id, text) in enumerate(docs):
        following = docs[(n + 1) % len(docs)].text
        cut = len(text) // 3
        edited = text[: len(text) - cut] + following[:cut]
        own, other, after = plain(text), plain(edited), plain(following)
        row = got[doc_id]
        assert row.n_chars == len(text) and row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert row.fingerprint == "".join(f"{x:08x}" for x in own)
        assert row.near_edited == sum(a == b for a, b in zip(own, other)) / len(own)
        assert row.near_next == sum(a == b for a, b in zip(own, after)) / len(own)
