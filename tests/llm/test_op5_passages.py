"""Passages of 50 words or more, against all windows of 50 words."""

import re

import numpy as np

from matchcast.llm import queries, unit_dedup as op
from tests.llm.cases import SCHEMA
from tests.llm.test_op5_units import LOW, WORD

ALONE = re.compile("[฀-࿿က-Ⴟក-៿　-鿿豈-﫿＀-﾿\U00020000-\U00033fff]")


def split(text):
    """(start, end, word)."""
    for m in WORD.finditer(text or ""):
        long, at = len(m[0].encode()) > op.LONG_WORD, None
        for i in range(m.start(), m.end()):
            if long or ALONE.match(text[i]):
                if at is not None:
                    yield at, i, text[at:i].translate(LOW)
                at = None
                yield i, i + 1, text[i].translate(LOW)
            elif at is None:
                at = i
        if at is not None:
            yield at, m.end(), text[at : m.end()].translate(LOW)


def brute(rows, size=50):
    """Offsets to remove by doc_id, of rows with distinct keys."""
    seen, gone = {}, {}
    for key, text in sorted(rows, key=lambda r: r[0]):
        words, own = list(split(text)), {}
        for i in range(len(words) - size + 1):
            name = tuple(w[2] for w in words[i : i + size])
            first = own.setdefault(name, i)
            start = i if name in seen else max(i, first + size) if first < i else None
            if start is not None:
                gone.setdefault(key, set()).update(range(words[start][0], words[i + size - 1][1]))
        seen |= dict.fromkeys(own)
    return gone


def removed(rows):
    got = {}
    for r in rows:
        got.setdefault(r.doc_id, set()).update(range(r.start, r.end))
    return got


def frame(spark, rows):
    return spark.createDataFrame([(k, t, None, None, None, "x") for k, t in rows], SCHEMA).repartition(3)


def closed(text, offsets):
    """The offsets, and white space between two of them."""
    return offsets | {i for m in re.finditer(r"\s+", text) if {m.start() - 1, m.end()} <= offsets for i in range(*m.span())}


def test_every_window(spark):
    random = np.random.default_rng(5)
    prose = lambda n: [f"w{x}" for x in random.integers(0, 500, n)]
    shared, few = prose(130), [*"ab", "a"] * 40
    rows = [(i, " ".join(prose(int(random.integers(0, 30))) + shared[int(random.integers(0, 40)) : int(random.integers(80, 130))] + prose(20))) for i in range(12)]
    rows += [(20, " ".join(few)), (21, "head " + " ".join(few[1:90]) + " tail"), (22, " ".join(shared + prose(9) + shared)), (23, " ".join(shared[:49])), (24, ""), (25, None)]
    got, want = removed(op.passages(frame(spark, rows)).collect()), brute(rows)
    assert {k: closed(dict(rows)[k], v) for k, v in got.items()} == {k: closed(dict(rows)[k], v) for k, v in want.items()} and len(want) > 8


def test_a_passage_is_removed_to_its_ends(spark):
    passage = " ".join(f"p{i}" for i in range(52))
    got = {r.doc_id: r.text for r in op.deduplicate(frame(spark, [(1, f"first {passage} end"), (2, f"other {passage} close")])).collect()}
    assert got == {1: f"first {passage} end", 2: "other  close"}


def test_query_covers_every_window(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = {r.doc_id: set().union(*(range(*map(int, p.split(":"))) for p in r.removed.split(","))) for r in queries.op5_substring_dedup(spark, sf).collect()}
    want = brute(rows)
    assert want and all(v <= closed(dict(rows)[k], got.get(k, set())) | {i for i in v if dict(rows)[k][i].isspace()} for k, v in want.items())
