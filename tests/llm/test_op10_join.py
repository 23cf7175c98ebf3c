import itertools
import re

import numpy as np
import pytest

from matchcast.llm import queries, sigtree_join as op
from matchcast.llm.components import components
from tests.llm.cases import ROWS, SCHEMA, frame
from tests.oracle import connect, normal

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k):
    w = WORD.findall((text or "").translate(LOW))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def brute(rows, k, num):
    """(n_shingles, component_id, n_links) by row, all pairs compared."""
    sets = [shingles(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    near = {}
    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j]):
            root[find(j)] = find(i)
            if sets[i] != sets[j]:
                near.setdefault(sets[i], set()).add(sets[j])
                near.setdefault(sets[j], set()).add(sets[i])
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted((str(d), len(sets[i]), str(least.get(find(i))), len(near.get(sets[i], ()))) for i, (d, _) in enumerate(rows))


def got(df, k, num):
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.n_links) for r in op.join(df, k=k, num=num).collect())


def texts(seed=0, groups=12):
    """Groups of near copies at all distances around the limit, with shared passages and some copies."""
    random = np.random.default_rng(seed)
    word = lambda: "".join(random.choice(list("abcdefghij"), 4))
    passage, out = [word() for _ in range(30)], []
    for _ in range(groups):
        base = [word() for _ in range(int(random.integers(3, 200)))]
        if random.random() < 0.5:
            base[5:5] = passage
        for edits in range(int(random.integers(1, 9))):
            w = list(base)
            for _ in range(edits):
                w[int(random.integers(len(w)))] = word()
            out.append(" ".join(w))
            if random.random() < 0.3:
                out.append(" ".join(w).upper())
    return [(i * 3 + 1, t) for i, t in enumerate(out)]


@pytest.mark.parametrize("k,num,seed", [(3, 90, 0), (5, 80, 1), (3, 50, 2)])
def test_equals_brute_force(spark, k, num, seed):
    rows = texts(seed)
    df = spark.createDataFrame([(d, t, None, None, None, "c") for d, t in rows], SCHEMA)
    assert got(df, k, num) == brute(rows, k, num)


def test_parts_and_frequent_tokens(spark, monkeypatch):
    """Blocks and families dealt into many parts, every shared token frequent, large families by bitmaps."""
    for name, value in (("BLOCK", 3), ("PART_NODES", 4), ("PART_TOKENS", 200), ("DENSE", 2), ("COUNTED", 10), ("FAN", 2), ("HELD", 4)):
        monkeypatch.setattr(op, name, value)
    rows = texts(3, 6)
    df = spark.createDataFrame([(d, t, None, None, None, "c") for d, t in rows], SCHEMA).coalesce(1)
    assert got(df, 3, 90) == brute(rows, 3, 90)


def test_cases(spark):
    rows = [r[:2] for r in ROWS]
    assert got(frame(spark), 3, 90) == brute(rows, 3, 90)
    assert op.join(frame(spark, [])).count() == 0 and op.keep_one(frame(spark, [])).count() == 0
    nameless = [(None, "a b c d", "x", None, None, None)] * 2 + [(None, None, None, None, None, None)]
    assert got(frame(spark, nameless), 3, 90) == [("None", 0, "None", 0), ("None", 2, "None", 0), ("None", 2, "None", 0)]


def test_keep_one(spark):
    kept = op.keep_one(frame(spark))
    assert kept.columns == frame(spark).columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["1", "2", "None", "3", "4", "6", "7", "8", "9"])


def test_names_that_collide_are_changed(spark, monkeypatch):
    plain = op.digests

    def few(values, bounds, salt=0):
        nid, rest = plain(values, bounds, salt)
        return (nid % 2 if salt < 1 else nid), rest

    rows = texts(4, 3)
    df = spark.createDataFrame([(d, t, None, None, None, "c") for d, t in rows], SCHEMA)
    seen = []
    profile = op.profile
    monkeypatch.setattr(op, "profile", lambda docs, k, num, den, salt: seen.append(salt) or profile(docs, k, num, den, salt).withColumn("nid", __import__("pyspark").sql.functions.expr("nid % 2") if salt < 1 else __import__("pyspark").sql.functions.col("nid")))
    assert got(df, 3, 90) == brute(rows, 3, 90) and seen == [0, 1]
    assert few(np.array([1], np.uint64), np.array([0, 1]))[0][0] in (-1, 0, 1)


def test_components(spark):
    random = np.random.default_rng(0)
    edges = [(int(a), int(b)) for a, b in random.integers(0, 400, (300, 2))] + [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2001 + i) for i in range(100)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    want = {x: find(x) for p in edges if p[0] != p[1] for x in p}
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert found == want
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_query(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.n_links) for r in queries.op10_ngram_join(spark, sf).collect()) == brute(docs, 3, 90)


def test_query_equals_sql(spark, sf):
    assert normal(queries.op10_ngram_join(spark, sf).toPandas()) == normal(connect(sf).execute(queries.oracle_sql()["op10_ngram_join"]).fetchdf())
