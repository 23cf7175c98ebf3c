"""The model's parts, computed again without its code, and its independence of how the rows are laid out."""

import numpy as np

from matchcast.llm import quality_nbsvm as op
from tests.llm.cases import ROWS, SCHEMA, SHARED, frame
from tests.llm.test_op1_quality import corpus, labels

SPACES = " \t\n\v\f\r"


def grams(text):
    """Names of the indicators of a text: three bytes each, hashed, and the repeated words."""
    raw, found = (text or "").encode(), set()
    if len(raw) < 3:
        return found
    for a, b, c in zip(raw, raw[1:], raw[2:]):
        h = (a * 0x9E3779B1 ^ b * 0x85EBCA77 ^ c * 0xC2B2AE3D) % 2**32 * 0x27D4EB2F % 2**32 >> 32 - op.BITS
        found.add(h if h >= len(op.AGAIN) else len(op.AGAIN))
    words, run = "".join(" " if c in SPACES else c for c in text).split(" "), 0
    words = [w for w in words if w]
    for i, w in enumerate(words):
        run = run + 1 if i and words[i - 1] == w else 1
        found |= {k for k, n in enumerate(op.AGAIN) if run >= n}
    return found


def test_counts_and_ratios(spark):
    texts = [(r[0], r[1]) for r in ROWS + SHARED if r[0] is not None]
    marks = {k: k % 2 for k, _ in texts}
    model = op.fit(frame(spark, ROWS + SHARED).repartition(3), labels(spark, list(marks.items())))
    count = np.full((2, 1 << op.BITS), op.SMOOTH)
    for k, t in texts:
        for g in grams(t):
            count[marks[k], g] += 1
    want = np.log(count[1] / count[1].sum()) - np.log(count[0] / count[0].sum())
    assert np.allclose(model.ratio, want, atol=1e-12)


def test_scores_are_the_scaled_sums(spark):
    docs, marks = corpus(spark, 40)
    model = op.fit(docs, marks)
    for r in op.score(frame(spark, ROWS), model, keep=("doc_id", "text")).collect():
        own = sorted(grams(r.text))
        length = np.sqrt((model.ratio[own] ** 2).sum())
        margin = (model.ratio[own] * model.weights[own]).sum() / max(length, 1e-12) + model.bias
        assert abs(r.score - 1 / (1 + np.exp(-np.clip(model.slope * margin + model.offset, -30, 30)))) < 1e-9


def test_a_step_of_descent():
    """One pass over two rows, by the definition: gradient, clipped dual variable, and what it adds to the weights."""
    xs, ratio, y = [np.array([0, 1]), np.array([1, 2])], np.array([1.0, 2.0, -1.0]), np.array([1, -1])
    values = [ratio[x] / np.linalg.norm(ratio[x]) for x in xs]
    w, bias = np.zeros(3), 0.0
    for i in np.random.default_rng(1).permutation(2):
        alpha = min(max(-(y[i] * (w[xs[i]] @ values[i] + bias) - 1) / (values[i] @ values[i] + 1), 0), 0.3)
        for j, v in zip(xs[i], values[i]):
            w[j] += alpha * y[i] * v
        bias += alpha * y[i]
    got, got_bias = op.dual_descent(xs, ratio, y, cost=0.3, passes=1)
    assert np.allclose(got, w) and abs(got_bias - bias) < 1e-12


def test_the_model_is_the_same_in_any_layout(spark):
    docs, marks = corpus(spark, 150)
    one, two = (op.fit(docs.repartition(n), marks.repartition(n), sample=120) for n in (1, 7))
    assert one.bias == two.bias and one.slope == two.slope and one.offset == two.offset and (one.weights == two.weights).all()


def test_rows_of_the_sample(spark):
    rows = spark.createDataFrame([(i // 3, 1, "same") for i in range(30)] + [(50, 0, f"t{i}") for i in range(40)], "_key bigint, y int, text string")
    got = op.chosen(rows, 20)
    assert got.count() == 20 and got.rdd.getNumPartitions() == 1 and op.chosen(rows, 100).count() == 50 and op.chosen(rows.limit(0), 5).count() == 0


def test_rows_of_one_key(spark):
    docs, marks = corpus(spark, 30)
    model = op.fit(docs, marks)
    df = spark.createDataFrame(SHARED, SCHEMA)
    assert op.score(df, model).count() == len(SHARED) and op.select(df, model, 0.0).columns == df.columns
