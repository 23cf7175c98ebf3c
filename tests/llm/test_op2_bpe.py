import hashlib

import pytest
from hypothesis import given, settings, strategies as st

from matchcast.llm import pair_bpe as op
from matchcast.llm import queries
from tests.llm.cases import ROWS, frame

PATH = queries.tokenizer_path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def same(library, text, row):
    found = library.encode(text, add_special_tokens=False)
    return row == (len(found.ids), " ".join(map(str, found.ids)), library.decode(found.ids, skip_special_tokens=False))


ODD = ["", "   ", " a  b\t\nc", "<|endoftext|>x<|startoftext|> y <|endoftext|>", "it's we'll ΣΑΣ ΟΔΟΣ İstanbul ß ǅ", "aaaaaa aaaaaaaaaaaaaaaa lllll !!!!!!!!", "e\u0301a\u0300", "12345 ½ Ⅷ ٣", "日本語 한국어", "\0<|endoftext|>", "a\x85b\x1cc\u3000d", "'S 'LL ''s 's's", "😀👩‍👩‍👧 ﬁ"]


def test_equals_the_library(library):
    codec = op.Codec(PATH)
    assert all(same(library, t, r) for t, r in zip(ODD, codec.rows(ODD)))


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_equals_the_library_on_any_text(text):
    from tokenizers import Tokenizer

    library = test_equals_the_library_on_any_text.__dict__.setdefault("library", Tokenizer.from_file(PATH))
    assert same(library, text, next(op.Codec(PATH).rows([text])))


def test_small_cache_gives_the_same():
    texts = [f"some words number{i} again" for i in range(50)]
    chunk, op.CHUNK_BYTES = op.CHUNK_BYTES, 64
    try:
        assert list(op.Codec(PATH, cache_words=5).rows(texts)) == list(op.Codec(PATH).rows(texts))
    finally:
        op.CHUNK_BYTES = chunk


def test_cases(spark, library):
    got = op.round_trip(frame(spark), PATH, content=True).collect()
    assert len(got) == len(ROWS)
    by_text = {r[0]: r[1] or "" for r in ROWS}
    for r in got:
        ids = library.encode(by_text[r.doc_id], add_special_tokens=False).ids
        assert r.ids == ids and r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded == library.decode(ids, skip_special_tokens=False) and r.decoded_sha256 == hashlib.sha256(r.decoded.encode()).hexdigest()
    assert op.round_trip(frame(spark, []), PATH).count() == 0


def test_query(spark, sf, library):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = queries.op2_bpe_round_trip(spark, sf).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = library.encode(docs[r.doc_id], add_special_tokens=False).ids
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
