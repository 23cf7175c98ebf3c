"""Counts, weights and decoding computed again without the operator's code."""

import itertools
import math

import numpy as np

from matchcast.llm import ecoc_langid as op
from tests.llm.cases import ROWS, SCHEMA, SHARED
from tests.llm.test_op8_language import corpus


def grams(text):
    """Hashes of three bytes around every byte of a letter, of the text in spaces."""
    folded = [c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in (text or "").encode()]
    edged = [32, *folded, 32]
    mixed = lambda a, b, c: (a * 0x9E3779B1 ^ b * 0x85EBCA77 ^ c * 0xC2B2AE3D) % 2**32 * 0x27D4EB2F % 2**32 >> 32 - op.BITS
    return [mixed(a, b, c) for a, b, c in zip(edged, edged[1:], edged[2:]) if b != 32]


def brute(train, texts):
    """(lang, score) of each text, from (text, lang) rows of up to seven languages."""
    langs = sorted({la for t, la in train if la is not None and t is not None})
    count = {la: {} for la in langs}
    for t, la in train:
        if la is not None and t is not None:
            for g in grams(t):
                count[la][g] = count[la].get(g, 0) + 1
    total = {la: sum(c.values()) + op.SMOOTH * 2**op.BITS for la, c in count.items()}
    share = lambda la, g: (count[la].get(g, 0) + op.SMOOTH) / total[la]
    bits = [(1, *rest) for rest in itertools.product((1, -1), repeat=len(langs) - 1)][1:]
    weight = lambda bit, g: math.log(np.mean([share(la, g) for la, s in zip(langs, bit) if s > 0])) - math.log(np.mean([share(la, g) for la, s in zip(langs, bit) if s < 0]))
    seen = {g for c in count.values() for g in c}
    trust = []
    for bit in bits:
        rest = weight(bit, next(g for g in range(2**op.BITS) if g not in seen))
        margin = [sum(share(la, g) * weight(bit, g) for g in seen) + rest * (2**op.BITS - len(seen)) * op.SMOOTH / total[la] for la in langs]
        trust.append(max(1e-3, min(m * s for m, s in zip(margin, bit))))
    trust = [t / np.mean(trust) for t in trust]
    out = []
    for t in texts:
        if t is None or not any(c.isalpha() for c in t):
            out.append(("und", 0.0))
            continue
        own = grams(t)
        margins = [float(np.mean([weight(bit, g) for g in own])) for bit in bits]
        loss = [sum(w * math.log1p(math.exp(-max(-30, min(30, m * op.SCALE)) * bit[i])) for m, bit, w in zip(margins, bits, trust)) for i in range(len(langs))]
        chance = np.exp(min(loss) - np.array(loss))
        out.append((langs[int(np.argmin(loss))], float(chance.max() / chance.sum())))
    return out


def test_equals_brute_force(spark):
    train = [(r.text, r.lang) for r in corpus(spark, ("en", "de", "fr"), 6).collect()] + [("no language", None), (None, "en")]
    texts = [r[1][:400] if r[1] else r[1] for r in ROWS + SHARED] + ["der und the", "été garçon"]
    docs = spark.createDataFrame([(i, t, la, None, None, "x") for i, (t, la) in enumerate(train)], SCHEMA)
    asked = spark.createDataFrame([(i, t, None, None, None, "x") for i, t in enumerate(texts)], SCHEMA).repartition(3)
    got = {r.doc_id: r for r in op.predict(asked, op.fit(docs)).collect()}
    for i, (lang, score) in enumerate(brute(train, texts)):
        assert got[i].lang_pred == lang and abs(got[i].score - score) < 1e-4, texts[i]


def test_ties_go_to_the_first_language():
    table = np.ones((3, 1 << op.BITS))
    best, score, lead = op.Model(["a", "b", "c"], table).decode(np.zeros((1, 3)))
    assert best[0] == 0 and abs(score[0] - 1 / 3) < 1e-9 and abs(lead[0]) < 1e-9
