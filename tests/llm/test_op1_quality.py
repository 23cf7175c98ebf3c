import numpy as np
import pytest

from matchcast.llm import quality_nbsvm as op
from matchcast.llm import queries
from tests.llm.cases import ROWS, frame


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, quality int")


def corpus(spark, n=300):
    good = [(i, f"a calm sentence about topic {i} and more words.", None, None, None, None) for i in range(n)]
    bad = [(n + i, f"BUY!! NOW!! {i}!! " * 3, None, None, None, None) for i in range(n)]
    return frame(spark, good + bad), labels(spark, [(i, int(i < n)) for i in range(2 * n)])


def test_learns(spark):
    docs, marks = corpus(spark)
    model = op.fit(docs, marks)
    got = {r.doc_id: r.score for r in op.score(docs, model).collect()}
    assert all(got[i] > 0.8 for i in range(300)) and all(got[i] < 0.2 for i in range(300, 600))
    assert op.select(docs, model, 0.3).columns == docs.columns and op.select(docs, model, 0.3).count() == 300


def test_cases(spark):
    docs, marks = corpus(spark, 50)
    model = op.fit(docs, marks)
    got = op.score(frame(spark), model).collect()
    assert len(got) == len(ROWS) and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (4, 5)}) == 1 and len({r.score for r in got if r.doc_id in (1, 2)}) == 1
    assert op.score(frame(spark, []), model).count() == 0


@pytest.mark.parametrize("rows,want", [([], 0.5), ([(4, 1), (7, 1)], 1.0), ([(4, 0), (7, 0)], 0.0), ([(4, None), (None, 1)], 0.5)])
def test_one_class_or_none(spark, rows, want):
    model = op.fit(frame(spark), labels(spark, rows))
    assert all(abs(r.score - want) < 1e-6 for r in op.score(frame(spark), model).collect())


def test_lowest_label_counts(spark):
    model = op.fit(frame(spark, ROWS[8:9]), labels(spark, [(7, 1), (7, 0)]))
    assert op.score(frame(spark, ROWS[8:9]), model).first().score < 0.01


def test_dual_descent_separates():
    random = np.random.default_rng(0)
    xs = [x for x in (np.unique(random.integers(0, 40, 10)) for _ in range(120)) if (x < 20).mean() != 0.5]
    y = np.array([1 if (x < 20).mean() > 0.5 else -1 for x in xs])
    ratio = np.where(np.arange(40) < 20, 1.0, -1.0)
    w, bias = op.dual_descent(xs, ratio, y, cost=100.0, passes=200)
    hits = [np.sign(w[x] @ (ratio[x] / np.linalg.norm(ratio[x])) + bias) == t for x, t in zip(xs, y)]
    assert np.mean(hits) > 0.95


def test_query_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op1_quality_classifier(spark, sf).toPandas().set_index("doc_id")
    marks = spark.read.parquet(f"{sf}/labels.parquet").toPandas().set_index("doc_id")
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count() and set(got.predicted) <= {0, 1}
    held = got.join(marks, how="inner")[lambda x: x.held_out]
    assert (held.predicted == held.quality).mean() > 0.95 and ((held.score >= 0.3).astype(int) == held.predicted).all()
