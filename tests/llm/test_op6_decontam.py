import collections
import math
import re

import numpy as np
import pytest

from matchcast.llm import decontam as op
from matchcast.llm import queries
from tests.llm.cases import ROWS, SCHEMA, SHARED, frame

WORD = re.compile("[0-9A-Za-z\u0080-\U0010ffff]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, items, least=0.8):
    """(doc_id, item_id) of all whose best window of the item's size is similar enough."""
    bags = {}
    for i, t in items:
        w = WORD.findall((t or "").translate(LOW))
        if w:
            k = min(5, len(w))
            bags[i] = (len(w), k, collections.Counter(tuple(w[j : j + k]) for j in range(len(w) - k + 1)))
    n, share = sum(t is not None for _, t in items), collections.Counter(s for _, _, b in bags.values() for s in b)
    weight = lambda s: 1 + math.log(n / share.get(s, 1))
    found = set()
    for d, t in docs:
        w = WORD.findall((t or "").translate(LOW))
        for i, (m, k, bag) in bags.items():
            size = min(m, len(w))
            runs = [tuple(w[j : j + k]) for j in range(len(w) - k + 1)] if len(w) >= k else []
            length = min(m - k + 1, len(runs))
            for s in range(len(runs) - length + 1) if size and runs else ():
                own = collections.Counter(runs[s : s + length])
                both = sum(weight(x) * min(c, bag[x]) for x, c in own.items())
                if both and both / sum(weight(x) * max(own[x], bag[x]) for x in own.keys() | bag.keys()) >= least - 1e-9:
                    found.add((d, i))
                    break
    return found


def words(seed, n):
    random = np.random.default_rng(seed)
    return ["".join(random.choice(list("abcdefgh"), 6)) for _ in range(n)]


def test_near_windows_are_found(spark):
    item, other = words(1, 60), words(2, 25)
    edits = []
    for k in range(1, 5):
        w = list(item)
        for j in range(k):
            w[7 + 13 * j] = "changed"
        edits.append(w)
    gap = item[:30] + ["inserted"] + item[30:]
    docs = [(1, " ".join(words(3, 200) + item + words(4, 200))), *((10 + i, " ".join(words(20 + i, 50) + w + words(30 + i, 50))) for i, w in enumerate(edits)), (20, " ".join(item[:50])), (21, " ".join(item[:45])), (22, " ".join(item[10:] + words(5, 9))), (23, " ".join(gap)), (24, ", ".join(other).upper() + "!"), (25, " ".join(words(6, 500))), (26, " ".join(other[:20]))]
    items = [(1, " ".join(item)), (2, " ".join(other)), (3, "tiny item"), (4, None), (5, "!!!"), (6, " ".join(other))]
    df = spark.createDataFrame([(k, t, None, None, None, "c") for k, t in docs], SCHEMA)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = op.find(df, bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == brute(docs, items) and {r.doc_id for r in got} >= {1, 10, 20, 24}
    exact = next(r for r in got if r.doc_id == 1)
    assert docs[0][1][exact.start : exact.end] == " ".join(item) and exact.similarity == 1.0
    blocks = op.find(df, bench, most=100)
    assert {(r.doc_id, r.item_id) for r in blocks.collect()} == {(r.doc_id, r.item_id) for r in got}
    kept = {r.doc_id for r in op.clean(df, bench, most=100).collect()}
    assert kept == {k for k, _ in docs} - {r.doc_id for r in got} and op.clean(df, bench).columns == df.columns


@pytest.mark.parametrize("n", [0, 1, 50, 4000])
def test_block_index_finds_all_within_the_radius(n):
    """Both ways of looking up: few items are compared, many are found by their near values."""
    random = np.random.default_rng(5)
    prints = random.integers(0, 1 << 64, n, dtype=np.uint64)
    asked = prints[random.integers(0, n, 300)].copy() if n else random.integers(0, 1 << 64, 300, dtype=np.uint64)
    for i in range(300):
        for b in random.integers(0, 64, random.integers(0, 25)):
            asked[i] ^= np.uint64(1) << np.uint64(b)
    index = op.BlockIndex(prints)
    assert n < 4000 or index.bounds[0] is not None
    q, i = index.near(asked)
    want = np.argwhere(np.bitwise_count(asked[:, None] ^ prints[None, :]) <= op.RADIUS)
    assert sorted(zip(q.tolist(), i.tolist())) == sorted(map(tuple, want.tolist())) and (len(q) > 100 or not n)


def test_the_index_selects():
    """Of random items one in seven is a candidate of a random window."""
    random = np.random.default_rng(6)
    index, asked = op.BlockIndex(random.integers(0, 1 << 64, 4000, dtype=np.uint64)), random.integers(0, 1 << 64, 200, dtype=np.uint64)
    pairs = set().union(*(set(zip(*(x.tolist() for x in index.candidates(asked, k)))) for k in range(4)))
    assert 0.12 < len(pairs) / (200 * 4000) < 0.17


def test_rows_of_one_doc_id(spark):
    bench = spark.createDataFrame([(1, SHARED[4][1][13:-16])], "item_id bigint, text string")
    df = spark.createDataFrame(SHARED, SCHEMA)
    assert [(r.doc_id, r.item_id) for r in op.find(df, bench).collect()] == [(3, 1), (3, 1)]
    assert op.clean(df, bench).count() == len(SHARED) - 2 and op.clean(df, bench).columns == df.columns


def test_cases(spark):
    bench = spark.createDataFrame([(1, "The same text in two rows of one key here."), (1, "word"), (None, "12345 678"), (7, "日本語 𝔘 emoji")], "item_id bigint, text string")
    got = collections.Counter((r.doc_id, r.item_id) for r in op.find(frame(spark), bench).collect())
    assert got == collections.Counter({(4, 1): 2, (5, 1): 1, (7, 1): 1, (8, None): 1, (9, 7): 1})
    assert op.clean(frame(spark), bench).count() == len(ROWS) - 6
    assert op.find(frame(spark, []), bench).count() == 0 and op.find(frame(spark), bench.limit(0)).count() == 0 and op.clean(frame(spark), bench.limit(0)).count() == len(ROWS)


def test_query(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert {(r.doc_id, r.item_id) for r in queries.op6_decontaminate(spark, sf).collect()} == brute(docs, items)
