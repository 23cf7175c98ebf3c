import numpy as np
import pytest

from matchcast.llm import ecoc_langid as op
from matchcast.llm import queries
from tests.llm.cases import ROWS, SCHEMA, frame

WORDS = {"en": "the of and that with have this from they would", "de": "der und nicht auch sich eine wird über können für", "es": "que para como más pero sus este también señor año", "fr": "les des est dans vous être avec très où garçon"}


def corpus(spark, langs, n=40):
    random = np.random.default_rng(1)
    rows = [(i, " ".join(random.choice(WORDS[la].split(), 25)), la, None, None, "x") for i, la in enumerate(list(langs) * n)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("langs", [("en", "de"), ("en", "de", "es", "fr")])
def test_learns(spark, langs):
    df = corpus(spark, langs)
    got = op.predict(df, op.fit(df), keep=("doc_id", "lang")).collect()
    assert all(r.lang == r.lang_pred and 0.5 < r.score <= 1 for r in got) and len(got) == 40 * len(langs)


def test_ambiguous_is_flagged(spark):
    df = corpus(spark, ("en", "de"))
    mixed = spark.createDataFrame([(1, "the " * 3 + "der " * 3, None, None, None, "x"), (2, WORDS["en"] * 5, None, None, None, "x")], SCHEMA)
    got = {r.doc_id: r for r in op.predict(mixed, op.fit(df)).collect()}
    assert not got[2].ambiguous and got[1].score < got[2].score


def test_codewords():
    for n in (2, 3, 4, 7, 12, 40):
        code = op.codewords(n).astype(int)
        apart = [(code[i] != code[j]).sum() for i in range(n) for j in range(i)]
        assert min(apart) >= 1 and (n < 3 or min(apart) >= 2) and set(np.unique(code)) == {-1, 1} and (np.abs(code.sum(0)) < n).all()
    assert op.codewords(4).shape == (4, 7)


def test_many_languages():
    table = np.random.default_rng(0).integers(0, 50, (12, 1 << op.BITS)).astype(float)
    model = op.Model([f"l{i}" for i in range(12)], table)
    share = (table + op.SMOOTH) / (table + op.SMOOTH).sum(1, keepdims=True)
    assert model.decode(share @ model.weights)[0].tolist() == list(range(12))


def test_cases(spark):
    model = op.fit(frame(spark))
    got = {r.doc_id: r for r in op.predict(frame(spark), model).collect()}
    assert all(got[k].lang_pred == "und" and got[k].score == 0 for k in (1, 2, 6, 8)) and got[9].lang_pred == "es" and all(0 <= r.score <= 1 for r in got.values())
    assert op.predict(frame(spark), model).count() == len(ROWS) and op.predict(frame(spark, []), model).count() == 0
    assert {r.lang_pred for r in op.predict(frame(spark), op.fit(frame(spark, []))).collect()} == {"und"}
    one = op.predict(frame(spark), op.fit(frame(spark, ROWS[3:4]))).collect()
    assert {(r.lang_pred, r.score) for r in one} == {("en", 1.0), ("und", 0.0)}
    odd = spark.createDataFrame([(1, "日本語", None, None, None, None), (2, "½ 😀", None, None, None, None)], SCHEMA)
    assert {r.doc_id: r.lang_pred == "und" for r in op.predict(odd, model).collect()} == {1: False, 2: True}


def test_query_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op8_language_id(spark, sf).toPandas().set_index("doc_id").join(spark.read.parquet(f"{sf}/documents.parquet").toPandas().set_index("doc_id").lang)
    assert len(got) == 1000 and (got[got.held_out].lang == got[got.held_out].lang_pred).mean() > 0.98
