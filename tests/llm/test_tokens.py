"""BPE through a built model and packed token files, against the libraries themselves."""

import base64
import hashlib
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from basketry.llm import byte_bpe, queries, token_files
from basketry.llm.pretokens import Remembered, read_ranks

RANKS = public_tokenizers.path(queries.RANKS)
JSON = open(public_tokenizers.path(queries.TOKENIZER), encoding="utf-8").read()
MODEL = byte_bpe.read_model(RANKS)
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tik():
    ranks = {token: i for i, token in enumerate(read_ranks(RANKS))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def hf():
    return Tokenizer.from_str(JSON)


TEXTS = st.lists(st.sampled_from([" the", " The.", "\nof", " <|endoftext|>", " ß,", " été.", " ,", " a.b", "x", " "])).map(
    "".join
) | st.text(st.sampled_from("ab éß漢\U0001f600 \n\t  \x85\x1c.,'s1<|>") | st.characters(codec="utf-8"), max_size=60)


@settings(max_examples=200, deadline=None)
@given(st.lists(TEXTS, max_size=5))
def test_encoders_agree_with_the_libraries(texts):
    ranks = {token: i for i, token in enumerate(read_ranks(RANKS))}
    coded = byte_bpe.encoder(MODEL, public_tokenizers.PATTERN)(texts)
    library = _tik(ranks)
    assert [c.tolist() for c in coded] == [library.encode_ordinary(t) for t in texts]
    assert [byte_bpe.decoder(MODEL)(c.tolist()) for c in coded] == [t.encode() for t in texts]
    coder = token_files.encoder(JSON)
    for end_id in (None, 2):
        ids, counts = coder.encode(pa.array(texts, pa.string()), end_id)
        cut = np.split(ids, np.cumsum(counts)[:-1]) if texts else []
        end = [] if end_id is None else [end_id]
        assert [c.tolist() for c in cut] == [
            [*c.ids, *end] for c in coder.tokenizer.encode_batch(texts, add_special_tokens=False)
        ]


_tiks: list = []


def _tik(ranks):
    if not _tiks:
        _tiks.append(
            tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        )
    return _tiks[0]


def test_letters_are_distinct_and_invertible():
    assert len(set(byte_bpe.byte_letters())) == 256
    assert byte_bpe.unmapped(byte_bpe.mapped(bytes(range(256)))) == bytes(range(256))


def test_rank_file_must_count_up(tmp_path):
    path = tmp_path / "ranks"
    path.write_bytes(base64.b64encode(b"a") + b" 0\n" + base64.b64encode(b"b") + b" 2\n")
    with pytest.raises(ValueError):
        read_ranks(str(path))


def test_remembered_forgets_and_stays_right():
    known = Remembered(lambda pieces: [p.upper() for p in pieces], limit=8)
    for n in range(40):
        rows = [[f"p{(n * i) % 23}" for i in range(6)], []]
        assert known.look_up(rows) == [[p.upper() for p in row] for row in rows]
        assert len(known) <= 12


def test_bpe_of_odd_rows(odd, odd_rows, tik):
    coded = byte_bpe.decode(byte_bpe.encode(odd, MODEL, public_tokenizers.PATTERN), MODEL)
    found = Counter((r.doc_id, tuple(r.token_ids), bytes(r.decoded)) for r in coded.collect())
    assert found == Counter((i, tuple(tik.encode_ordinary(t or "")), (t or "").encode()) for i, t in odd_rows)


def test_empty_tables(spark, empty):
    coded = byte_bpe.encode(empty, MODEL, public_tokenizers.PATTERN)
    assert byte_bpe.decode(coded, MODEL).collect() == []
    from basketry.session import scratch_path

    path = scratch_path(spark, "tokens")
    token_files.write_token_files(empty, path, JSON, 2)
    assert token_files.read_digests(spark, path).collect() == []


def test_null_ids_decode_to_nothing(spark):
    row = spark.createDataFrame([(1, None)], "doc_id long, token_ids array<int>")
    assert bytes(byte_bpe.decode(row, MODEL).first().decoded) == b""


@pytest.mark.parametrize("width", [1, 3, 8, 15, 16, 17, 31, 32])
def test_packing_and_random_access(width):
    ids = np.random.default_rng(width).integers(0, 1 << width, 70_001, dtype=np.uint64).astype("<u4")
    packed = token_files.pack(ids, width)
    assert len(packed) == -(-len(ids) * width // 8)
    for start, n in ((0, len(ids)), (1, 1), (65_530, 20), (70_000, 1), (5, 0)):
        assert (token_files.unpack(packed, width, start, n) == ids[start : start + n]).all()


@pytest.mark.parametrize("block_ids", [1, 50, 1 << 16])
def test_files_of_odd_rows(spark, odd, odd_rows, hf, block_ids):
    from basketry.session import scratch_path

    path = scratch_path(spark, "tokens")
    token_files.write_token_files(odd, path, JSON, 2, block_ids=block_ids)
    got = token_files.read_token_files(spark, path).orderBy("start").collect()
    order = sorted(odd_rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    start = 0
    for row, (doc_id, text) in zip(got, order, strict=True):
        ids = [*hf.encode(text or "", add_special_tokens=False).ids, 2]
        assert (row.doc_id, row.start, list(row.token_ids)) == (doc_id, start, ids)
        start += len(ids)


def test_queries(spark, tik, hf):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").select("doc_id", "text").collect()
    bpe = {r.doc_id: r for r in queries.op2_byte_bpe(spark, SF).collect()}
    files = {r.doc_id: r for r in queries.op7_token_files(spark, SF).collect()}
    assert len(bpe) == len(files) == len(docs)
    start = 0
    for doc_id, text in docs:
        ids = tik.encode_ordinary(text)
        row = bpe[doc_id]
        assert row.n_tokens == len(ids) and row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        ids = [*hf.encode(text, add_special_tokens=False).ids, 2]
        row = files[doc_id]
        assert (row.start, row.n_tokens) == (start, len(ids))
        assert row.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_bits_are_the_fewest():
    assert [token_files.id_width(n) for n in (1, 2, 3, 256, 257, 50_257)] == [1, 1, 2, 8, 9, 16]
