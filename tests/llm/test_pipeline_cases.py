"""Every stage over nulls, empty and long texts, ties, repeated rows, shared doc_ids, clashing columns and an empty table."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from matchcast.llm import quality_nbsvm, queries
from matchcast.shared import scratch
from tests.llm.cases import ROWS, SCHEMA, SHARED
from tests.llm.test_op10_join import brute as join_brute, shingles
from tests.llm.test_op3_secrets import brute as secret_brute
from tests.llm.test_op6_decontam import brute as leak_brute

CASES = ROWS + SHARED + [(60, "secret=0123456789abcdefab here", "en", "a", 1, "x"), (61, "secret=0123456789abcdefab here", None, None, None, None)]
CLASH = ("_text", "_nid", "_key", "_found", "_h1", "document", "found", "row", "removed", "nid", "y", "node")


@pytest.fixture(scope="module")
def docs(spark):
    """The cases, each with its number, and columns named as the operators' own."""
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(CASES)], f"{SCHEMA}, number int")
    return df.select("*", *(F.lit(i).alias(c) for i, c in enumerate(CLASH))).repartition(3).cache()


def kept(spark, docs, sf, stage):
    out = stage(spark, docs, sf)
    assert out.columns == docs.columns
    rows = {r.number: r for r in out.collect()}
    assert all(r[c] == i for r in rows.values() for i, c in enumerate(CLASH))
    return rows


def test_quality(spark, docs, sf):
    marks = spark.read.parquet(f"{sf}/labels.parquet").where(queries.remainder("doc_id", 5) != 0)
    model = quality_nbsvm.fit(docs, marks)
    good = {r.number for r in quality_nbsvm.score(docs, model, keep=("number",)).collect() if r.score >= pipeline.LEAST_QUALITY}
    assert set(kept(spark, docs, sf, pipeline.quality)) == good


def test_near_duplicates(spark, docs, sf):
    got, component = kept(spark, docs, sf, pipeline.near_duplicates), {}
    for i, (d, t, *_) in enumerate(CASES):
        group = [j for j, (e, u, *_) in enumerate(CASES) if shingles(t, 5) and len(shingles(t, 5) & shingles(u, 5)) >= 0.8 * len(shingles(t, 5) | shingles(u, 5))]
        component[i] = min((CASES[j][0] for j in group if CASES[j][0] is not None), default=None)
    stays = [i for i, (d, *_) in enumerate(CASES) if d is None or component[i] is None or component[i] >= d]
    once = {(CASES[i][0], CASES[i][1]) if CASES[i][0] is not None else i for i in stays}
    assert {(CASES[i][0], CASES[i][1]) if CASES[i][0] is not None else i for i in got} == once and len(got) == len(once)
    assert len(join_brute([r[:2] for r in CASES], 5, 80)) == len(CASES)


def test_decontaminate(spark, docs, sf):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    leak = leak_brute([(i, r[1]) for i, r in enumerate(CASES)], items)
    assert set(kept(spark, docs, sf, pipeline.decontaminate)) == set(range(len(CASES))) - {d for d, _ in leak}


def test_secrets(spark, docs, sf):
    got = kept(spark, docs, sf, pipeline.secrets)
    assert len(got) == len(CASES)
    for i, (_, text, *_) in enumerate(CASES):
        assert (got[i].text == text) == (not secret_brute(text)) and got[i].n_chars == (None if text is None else len(got[i].text))


def test_tokens(spark, docs, sf):
    got = pipeline.tokens(spark, docs, sf).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in CASES) and all(r.n_tokens >= 0 for r in got)


@pytest.mark.parametrize("stage", [s for _, s in pipeline.STAGES])
def test_empty(spark, docs, sf, stage):
    out = stage(spark, docs.limit(0), sf)
    assert out.count() == 0 and (stage is pipeline.tokens or out.columns == docs.columns)


def test_run_leaves_nothing(spark, sf):
    import os

    folder = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    files = lambda: {f"{d}/{n}" for d, _, names in os.walk(folder) for n in names}
    before = files()
    with scratch(spark):
        assert pipeline.run(spark, sf).count() > 0 and files() - before
    assert files() <= before
