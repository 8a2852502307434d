"""Personal data against Python's regular expressions, and terms against plain counts."""

import hashlib
import random
import re

import pytest
from rows import table

from basketry.llm import disclosure, queries
from pyspark.sql import functions as F

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(v - 9 * (v > 9) for v in doubled) % 10 == 0


def passes(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 10 <= len(digits) <= 15


def plain_spans(text):
    found = [
        (m.start(), at, kind, m.end())
        for at, (kind, pattern) in enumerate(PATTERNS.items())
        for m in re.finditer(pattern, text or "")
        if passes(kind, m.group())
    ]
    return [f"{kind}:{start}:{end}" for start, _, kind, end in sorted(found)]


ODD = [
    "a@b.c_d@e.f", "1.2.3.4.5.6.7.8 999.1.1.1 0255.0.0.1", "4111 1111 1111 1111 x 4111-1111-1111-1112",
    "4465758382889437 4465758382889437", "+1 (499) 555-6503 +++1 2 34567890123 +12", "x" * 3000 + "@", "1" * 3000,
    "1 " * 3000, "+1" + " " * 3000, "\U0001f600a@b.co \U0001f600 é1.2.3.4....", "a@@b.c a@b..c a@b.c.",
    "@a@b.c@d.e.f@g.h", "..a@b.c%x@y.z", "0000000.00001.1.1 256.1.1.1", "1-2-3-4 5-6", "a@b.c " * 700, None, "",
]


def test_forms_equal_plain_search(spark):
    rows = table(spark, list(enumerate(ODD)))
    found = rows.select("doc_id", disclosure.written(disclosure.base_spans(F.coalesce("text", F.lit("")))).alias("s"))
    for row in found.collect():
        assert row.s == ",".join(plain_spans(ODD[row.doc_id])), ODD[row.doc_id]


def test_query_equals_plain_search_on_every_text(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = queries.op11_disclosure(spark, folder).collect()
    assert len(rows) == len(texts)
    for row in rows:
        spans = plain_spans(texts[row.doc_id])
        counts = [sum(s.startswith(k) for s in spans) for k in PATTERNS]
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == counts
        assert row.base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert [s for s in row.spans.split(",") if s and not s.startswith("term")] == spans


@pytest.fixture(scope="module")
def named():
    """A name beside one address in different texts, and the common words of all texts."""
    draw = random.Random(3)
    words = ["".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(300)]
    prose = lambda n: " ".join(draw.choice(words) for _ in range(n))
    rows = [(i, prose(40)) for i in range(200)]
    rows += [(i, f"{prose(12)} Zyxander Quillby z.quill@corp.example.org {prose(12)}") for i in range(200, 206)]
    rows += [(206, f"{prose(10)} ZYXANDER went out {prose(5)}"), (208, None), (209, ""), (None, "+1 (499) 555-6503")]
    rows += [(300 + i, f"Copied words beside other@corp.example.org {prose(1)}") for i in range(1)] * 9
    return rows


@pytest.mark.parametrize("broadcast_rows", [1000, 0])
def test_terms_that_disclose_are_marked_wherever_they_stand(spark, named, broadcast_rows):
    found = disclosure.find_private(table(spark, named), broadcast_rows=broadcast_rows)
    rows = {r.doc_id: r.s for r in found.select("doc_id", disclosure.written(F.col("spans")).alias("s")).collect()}
    texts = dict(named)
    for i in range(200, 206):
        values = {texts[i][slice(*map(int, s.split(":")[1:]))] for s in rows[i].split(",")}
        assert values == {"Zyxander", "Quillby", "z.quill@corp.example.org"}
    assert [texts[206][slice(*map(int, s.split(":")[1:]))] for s in rows[206].split(",")] == ["ZYXANDER"]
    assert rows[None] == "phone:0:17"
    assert rows[300].startswith("email") and "term" not in rows[300]  # nine copies are one context
    assert not any(rows[i] for i in [*range(200), 208, 209])


def test_counts_behind_a_term(spark, named):
    docs = disclosure._docs(table(spark, named), "doc_id", "text")
    found = docs.withColumn("spans", disclosure.base_spans(F.col("text"))).withColumn("row", F.monotonically_increasing_id())
    row = disclosure.disclosing_terms(docs, found.select("row", "spans")).filter("term = 'zyxander'").first()
    n, both, entity, term = len(named), 6, 6, 7
    import math

    assert row.bits_told == pytest.approx(math.log2(n * both / (entity * term)))
    assert row.bits_left == pytest.approx(math.log2(n / entity) - math.log2(n * both / (entity * term)))
    assert row.shown == "<term>"  # the first letters tell as much


def test_a_family_that_tells_less_stays(spark, named):
    rows = named + [(400 + i, "zyxture " + t) for i, t in named[:60]]
    docs = disclosure._docs(table(spark, rows), "doc_id", "text")
    found = docs.withColumn("spans", disclosure.base_spans(F.col("text"))).withColumn("row", F.monotonically_increasing_id())
    shown = {r.term: r.shown for r in disclosure.disclosing_terms(docs, found.select("row", "spans")).collect()}
    assert shown == {"zyxander": "zyx*", "quillby": "<term>"}


def test_sanitised_texts(spark, named):
    clean = disclosure.sanitise(table(spark, named))
    assert clean.columns == table(spark, []).columns
    texts = {r.doc_id: r.text for r in clean.collect()}
    assert "<term> <term> <email>" in texts[203] and "<term> went out" in texts[206]
    assert texts[None] == "<phone>" and texts[0] == named[0][1] and texts[208] == ""
    assert clean.count() == len(named)


def test_many_spans_and_overlaps(spark):
    rows = [(1, "a@b.c " * 700), (2, "+1 (499) 555-6503, 4465758382889437"), (3, "+4465758382889437")]
    clean = {r.doc_id: r.text for r in disclosure.sanitise(table(spark, rows)).collect()}
    assert clean[1] == "<email> " * 700
    assert not re.search("[0-9]{5}", clean[2] + clean[3])


def test_odd_rows_and_empty_table(spark, odd, odd_rows, empty):
    found = disclosure.find_private(odd)
    assert found.count() == len(odd_rows)
    assert disclosure.find_private(empty).count() == 0
    assert disclosure.sanitise(empty).count() == 0


def test_running_sums_over_blocks(spark):
    values = list(range(1, 1500))
    frame = spark.createDataFrame([(values,)], "v array<int>")
    got = frame.select(disclosure.running(F.col("v"), lambda x, y: x + y)).first()[0]
    total, want = 0, []
    for v in values:
        total += v
        want.append(total)
    assert got == want
