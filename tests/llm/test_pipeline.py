import pytest

import corpus_pipeline as pipeline
from matchcast.llm import quality_nbsvm, queries
from tests.llm.test_op10_join import brute as join_brute
from tests.llm.test_op2_bpe import PATH
from tests.llm.test_op3_secrets import BASE
from tests.llm.test_op6_decontam import brute as leak_brute


@pytest.fixture(scope="module")
def stages(spark, sf, tmp_path_factory):
    """Each stage's rows, from its predecessor's as written and read again."""
    docs, out = spark.read.parquet(f"{sf}/documents.parquet"), []
    out.append(docs.toPandas())
    for i, (_, stage) in enumerate(pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(i))
        stage(spark, docs, sf).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs.toPandas())
    return out


def test_columns(stages):
    assert [n for n, _ in pipeline.STAGES] == ["quality", "near_duplicates", "decontaminate", "secrets", "tokens"]
    assert all(list(s.columns) == list(stages[0].columns) for s in stages[:5]) and len({len(s) for s in stages[3:]}) == 1


def test_quality(spark, sf, stages):
    docs, marks = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = quality_nbsvm.fit(docs, marks.where(queries.remainder("doc_id", 5) != 0))
    good = {r.doc_id for r in quality_nbsvm.score(docs, model).where(f"score >= {pipeline.LEAST_QUALITY}").collect()}
    assert set(stages[1].doc_id) == good and len(good) < len(stages[0])
    clean = marks.where("quality = 1").toPandas().doc_id
    assert clean.isin(good).mean() > 0.9


def test_near_duplicates(stages):
    rows = list(zip(stages[1].doc_id, stages[1].text))
    assert set(stages[2].doc_id) == {int(c) for _, _, c, _ in join_brute(rows, 5, 80)}


def test_decontaminate(spark, sf, stages):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    leaks = {d for d, _ in leak_brute(list(zip(stages[2].doc_id, stages[2].text)), items)}
    assert set(stages[3].doc_id) == set(stages[2].doc_id) - leaks


def test_secrets(stages):
    before, after = (s.set_index("doc_id").text for s in stages[3:5])
    hit = [k for k, t in before.items() if any(len(m[g]) >= n for _, p, n, g in BASE for m in p.finditer(t))]
    assert {k for k in before.index if before[k] != after[k]} <= set(hit) and (stages[4].n_chars == stages[4].text.str.len()).all()


def test_tokens(stages):
    from tokenizers import Tokenizer

    library, text = Tokenizer.from_file(PATH), stages[4].set_index("doc_id").text
    assert all(n == len(library.encode(text[k], add_special_tokens=False).ids) for k, n in zip(stages[5].doc_id, stages[5].n_tokens))


def test_run_is_the_stages(spark, sf, stages):
    got = pipeline.run(spark, sf).toPandas()
    key = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, got[key].values.tolist())) == sorted(map(tuple, stages[5][key].values.tolist()))
