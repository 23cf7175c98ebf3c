import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from matchcast.llm import dac_tokens as op
from matchcast.llm import queries
from tests.llm.cases import ROWS, SHARED, frame

PATH = queries.tokenizer_path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 255), st.integers(0, 2**32 - 1)), max_size=1500))
def test_access_and_all(values):
    ids = np.array(values, np.uint32)
    blobs = op.Levels.of(ids).blobs()
    levels = op.Levels.read(*blobs)
    assert (levels.span(0, len(ids)) == ids).all()
    at = np.random.default_rng(0).permutation(len(ids))
    assert (levels.access(at) == ids[at]).all()


TEXTS = ["", "   ", " a  b\t\nc", "<|endoftext|>x <|endoftext|>", "it's we'll 's !!'s  \n\n  x", "日本語 한국어", *(f"a{chr(c)}{t}" for c in range(256) for t in ("b", " c", "  d", "\n", "1", ".")), "  ", " a ", "\n\n a\n", " \n", "x  ", "\t x"]


def test_equals_the_library(library):
    encoder = op.Encoder(PATH, 0, cache_words=500)
    for text, raw in zip(TEXTS * 2, encoder.rows(TEXTS * 2), strict=True):
        assert np.frombuffer(raw, np.uint16).tolist() == [*library.encode(text, add_special_tokens=False).ids, 0], repr(text)


def check(got, rows, library):
    start = 0
    want = sorted((-1 if k is None else k, t or "") for k, t in rows)
    assert len(got) == len(want)
    for r, (k, t) in zip(sorted(got, key=lambda r: r.start), want):
        ids = np.array([*library.encode(t, add_special_tokens=False).ids, 0], "<u4")
        assert (-1 if r.doc_id is None else r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (k, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


@pytest.mark.parametrize("shard", [1, 50, 1 << 20])
def test_cases(spark, library, tmp_path, shard):
    op.write(frame(spark), PATH, str(tmp_path / "t"), shard_tokens=shard)
    shards = spark.read.schema(op.SHARDS).parquet(str(tmp_path / "t"))
    check(op.read_documents(shards).collect(), [r[:2] for r in ROWS], library)
    asked = spark.createDataFrame([(7, 0), (7, 1), (7, 2), (9, 3), (77, 0), (3, -1)], "doc_id bigint, at bigint")
    got = {(r.doc_id, r.at): r.token for r in op.lookup(shards, asked).collect()}
    ids = {k: [*library.encode(t, add_special_tokens=False).ids, 0] for k, t, *_ in ROWS if k in (7, 9)}
    assert got == {(k, i): ids[k][i] for k, i in ((7, 0), (7, 1), (7, 2), (9, 3)) if i < len(ids[k])}


def test_rows_of_one_doc_id(spark, library, tmp_path):
    """Rows that share a doc_id or have none: in the table's order, and dealt over tasks."""
    rows = [(None, f"text {i}", None, None, None, None) for i in range(40)] + SHARED
    op.write(frame(spark, rows).coalesce(1), PATH, str(tmp_path / "t"))
    shards = spark.read.schema(op.SHARDS).parquet(str(tmp_path / "t"))
    got, start = sorted(op.read_documents(shards).collect(), key=lambda r: r.start), 0
    for r, i in zip(got, sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, i)), strict=True):
        ids = np.array([*library.encode(rows[i][1] or "", add_special_tokens=False).ids, 0], "<u4")
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (rows[i][0], start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert shards.where("exists(doc_ids, x -> x is null)").select("partition").distinct().count() > 1


def test_many_places_of_a_shard(spark, library, tmp_path, monkeypatch):
    monkeypatch.setattr(op, "ASKED", 5)
    op.write(frame(spark), PATH, str(tmp_path / "t"))
    shards = spark.read.schema(op.SHARDS).parquet(str(tmp_path / "t"))
    ids = [*library.encode(ROWS[3][1], add_special_tokens=False).ids, 0]
    asked = spark.range(0, 300).select(F.lit(3).cast("bigint").alias("doc_id"), (F.col("id") * 7).alias("at"))
    assert {r.at: r.token for r in op.lookup(shards, asked).collect()} == {7 * i: ids[7 * i] for i in range(300) if 7 * i < len(ids)}


def test_empty(spark, tmp_path):
    op.write(frame(spark, []), PATH, str(tmp_path / "t"))
    assert op.read_documents(spark.read.schema(op.SHARDS).parquet(str(tmp_path / "t"))).count() == 0


def test_query(spark, sf, library):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    check(queries.op9_token_output(spark, sf).collect(), docs, library)
