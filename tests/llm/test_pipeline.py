"""The pipeline, stage by stage, against plain versions of the operators."""

import random
import re
from collections import Counter

import corpus_pipeline
import pytest
from rows import table
from test_near_duplicates import plain_components, plain_kept_once, plain_mark
from test_packing import check

import __spark_entry__ as registered
from basketry.llm import quality_rules, secret_scan
from basketry.session import stage

SF = "/root/testdata/sf0.001"
TRUE = re.compile(r'AKIA[A-Z0-9]{16}|(?<=token = ")[0-9a-f]{40}|(?<=password=)[0-9a-f]{18}')


def run_stages(spark, docs):
    out = []
    for name, function in corpus_pipeline.STAGES:
        docs = stage(function(spark, docs, SF), name)
        out.append(docs)
    return out


def test_stages_against_plain_versions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    cleaned, unique, cut, masked, packed = run_stages(spark, docs)
    for df in (cleaned, unique, cut, masked):
        assert df.dtypes == docs.dtypes
        assert all(r.n_chars == len(r.text) for r in df.collect())
    judged = [(r.doc_id, quality_rules.judge(r.text)) for r in docs.collect()]
    rows = {r.doc_id: r.text for r in cleaned.collect()}
    assert rows == {i: j[0] for i, j in judged if j[-1]}
    rows = sorted(rows.items())
    label = plain_components([plain_mark(t) for _, t in rows])
    rows = [row for k, row in enumerate(rows) if label[k] == k]
    assert sorted((r.doc_id, r.text) for r in unique.collect()) == rows
    left = plain_kept_once(rows, corpus_pipeline.PASSAGE_BYTES)
    rows = [(i, t) for (i, _), t in zip(rows, left)]
    assert sorted((r.doc_id, r.text) for r in cut.collect()) == rows
    rows = [(i, TRUE.sub(secret_scan.MASK, t)) for i, t in rows]
    assert sorted((r.doc_id, r.text) for r in masked.collect()) == rows
    sources = {r.doc_id: r.source for r in docs.collect()}
    normal = {i: (t, sources[i], re.sub(r"[\x20\x09-\x0D]+", " ", t.lower())) for i, t in rows}
    check(packed.collect(), normal, 2048)


def test_run_is_the_stages_in_turn(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    last = run_stages(spark, docs)[-1]
    whole = registered.queries()["pipeline"](spark, SF)
    assert whole.columns == last.columns
    # Groups are dealt by place too, so bins may differ; pieces do not.
    pieces = lambda df: Counter((r.doc_id, r.piece, r.from_word, r.n_words) for r in df.collect())
    assert pieces(whole) == pieces(last)


@pytest.mark.parametrize("rows", [[], [(None, None), (1, ""), (1, ""), (None, "short")]])
def test_nothing_left(spark, rows):
    assert run_stages(spark, table(spark, rows))[-1].collect() == []


def test_odd_documents(spark, odd):
    last = run_stages(spark, odd)[-1].collect()
    assert all(r.doc_id in (None, 1, 2, 3, 6) for r in last)


def test_clean_documents_pass_whole(spark):
    r = random.Random(8)
    word = lambda: "".join(r.choice(["an", "re", "tu", "mi", "so", "le"]) for _ in range(r.randrange(1, 5)))
    line = lambda: ". ".join(" ".join(word() for _ in range(9)).capitalize() for _ in range(3)) + "."
    rows = [(i, "\n".join(line() for _ in range(4))) for i in range(40)]
    kept = run_stages(spark, table(spark, rows))[3]
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == rows
