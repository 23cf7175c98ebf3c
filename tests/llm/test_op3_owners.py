"""Repositories and owners in columns of their own, against counts by hand; and columns named as ours are."""

import re

from matchcast.llm import secret_scan as op
from tests.llm.cases import SCHEMA, SHARED
from tests.llm.test_op3_secrets import BASE, HEX, LIVE

ROWS = [
    *((i, f"copied by many owners of one repository: password={HEX} {i}", "r0", f"o{i}") for i in range(4)),
    *((10 + i, f"copied over repositories of one owner: token={HEX[::-1]} {i}", f"r{i}", "o0") for i in range(3)),
    *((20 + i, f"of two places only: secret={HEX[3:]}z {i}", f"r{i}", f"o{i}") for i in range(2)),
    *((30 + i, f"live {LIVE} {i}", "r0", f"o{i % 2}") for i in range(6)),
    *((40 + i, f"example {LIVE}Q {i}", "r0", f"o{i}") for i in range(3)),
    (50, f"nobody's {LIVE}N", None, None), (51, f"nobody's {LIVE}N", None, None), (52, None, "r0", "o0"),
]


def spans(text):
    base = [(m.start(), m.end(), n, m[g]) for n, p, least, g in BASE for m in p.finditer(text or "") if len(m[g]) >= least]
    live = [(m.start(), m.end(), "live", m[0]) for m in re.finditer(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}", text or "") if all(re.search(c, m[0]) for c in ("[a-z]", "[A-Z]", "[0-9]")) and not any(s < m.end() and e > m.start() for s, e, *_ in base)]
    return base + live


def brute():
    """(all spans, count of copied ones) by doc_id."""
    places = {}
    for _, t, r, o in ROWS:
        for *_, v in spans(t):
            places.setdefault(v, (set(), set()))
            places[v][0].add(r)
            places[v][1].add(o)
    copied = {v for v, (r, o) in places.items() if len(r - {None}) > op.MOST_REPOSITORIES or len(o - {None}) > op.MOST_OWNERS}
    kept = lambda t: sorted((s, op.KINDS.index(n), e) for s, e, n, v in spans(t) if n != "live" or v not in copied)
    return {k: (",".join(f"{op.KINDS[n]}:{s}:{e}" for s, n, e in kept(t)), sum(v in copied for *_, v in spans(t))) for k, t, *_ in ROWS}


def test_owners_equal_brute_force(spark):
    df = spark.createDataFrame(ROWS, "doc_id bigint, text string, repo string, who string").repartition(3)
    got, want = {r.doc_id: (r.spans, r.n_copied) for r in op.scan(df, repository="repo", owner="who").collect()}, brute()
    assert got == want and {n for _, n in want.values()} >= {0, 1} and want[0][1] and want[10][1] and not want[20][1] and not want[30][1] and want[40][1]


def test_copied_base_spans_may_stay(spark):
    df = spark.createDataFrame(ROWS, "doc_id bigint, text string, repo string, who string")
    got = {r.doc_id: r.text for r in op.redact(df, repository="repo", owner="who", copied_base=False).collect()}
    assert got[0] == ROWS[0][1] and got[20] == "of two places only: [assign] 0" and got[30] == "live [live] 0"
    assert {r.doc_id: r.text for r in op.redact(df, repository="repo", owner="who").collect()}[0] == "copied by many owners of one repository: [assign] 0"


def test_columns_named_as_the_operators(spark):
    rows = [(1, f"x password={HEX}", "s", 1, 2, "f", "d"), (2, None, None, 1, 2, "f", "d")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string, h1 int, _h2 int, found string, document string")
    got = op.redact(df)
    assert got.columns == df.columns and sorted(map(tuple, got.collect())) == [(1, "x [assign]", "s", 1, 2, "f", "d"), (2, None, None, 1, 2, "f", "d")]


def test_rows_of_one_doc_id(spark):
    rows = [*SHARED, (2, f"token={HEX}", "en", "a", 1, "x"), (2, f"token={HEX}", "en", "b", 1, "x"), (None, f"secret={HEX}", None, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert op.scan(df).count() == len(rows)
    assert sorted(str(r.text) for r in op.redact(df).collect()) == sorted([str(r[1]) for r in SHARED] + ["[assign]"] * 3)
