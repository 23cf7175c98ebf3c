import hashlib
import re

import duckdb

from matchcast.llm import queries, secret_scan as op
from tests.llm.cases import ROWS, SCHEMA, frame
from tests.oracle import connect, normal

BASE = [("assign", re.compile(r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"), 6, 2), ("access", re.compile(r"(AKIA[A-Z0-9]+)"), 20, 1), ("hex", re.compile("([0-9a-f]+)"), 24, 1)]


def brute(text):
    found = [(m.start(), k, n, m.end()) for k, (n, p, least, g) in enumerate(BASE) for m in p.finditer(text or "") if len(m[g]) >= least]
    return ",".join(f"{n}:{s}:{e}" for s, _, n, e in sorted(found))


HEX, LIVE = "0123456789abcdef" * 2, "Zx9Kq2LmTr8Vb4Nc6Ys1Wd3"
TEXTS = [
    f"PassWord = '{HEX}' end", "token=token=abcdefgh", "secret:token:abcdefghi", "api_key: abc", "apikey=\"abcdef\"", f"é😀 token : x.y-z_1/2+3= {HEX}{HEX}",
    "AKIA" + "A1" * 8, "AKIAAKIA" + "B" * 12, "AKIA" + "B" * 15, f"id {LIVE} here", f"id {LIVE}, again", f"password={LIVE}", "", None, "PASSWORD=PASSWORD=abcdefg passwd=12345 passwd=123456",
]


def docs(spark, texts=TEXTS, sources=None):
    return spark.createDataFrame([(i, t, None, (sources or {}).get(i, f"s{i}"), None, "clash") for i, t in enumerate(texts)], SCHEMA)


def check(rows, texts):
    for r in rows:
        want = brute(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest(), (texts[r.doc_id], r.spans)
        kinds = [x.split(":")[0] for x in want.split(",")]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(kinds.count(k) for k in ("assign", "access", "hex"))
        assert set(filter(None, want.split(","))) <= set(r.spans.split(","))


def test_base_spans(spark):
    got = op.scan(docs(spark)).collect()
    assert len(got) == len(TEXTS)
    check(got, dict(enumerate(TEXTS)))


def test_ownership_separates_copied_from_live(spark):
    few = {r.doc_id: r for r in op.scan(docs(spark, sources={9: "a", 10: "a", 11: "b"})).collect()}
    assert few[9].n_live == 1 and few[9].spans == f"live:3:{3 + len(LIVE)}" and few[9].n_copied == 0 and few[11].n_live == 0
    many = {r.doc_id: r for r in op.scan(docs(spark, [f"id {LIVE} {i}" for i in range(5)])).collect()}
    assert all(r.n_live == 0 and r.n_copied == 1 and r.spans == "" for r in many.values())


def test_cases(spark):
    got = op.scan(frame(spark)).collect()
    assert len(got) == len(ROWS)
    check([r for r in got if r.doc_id is not None], {r[0]: r[1] for r in ROWS})
    assert op.scan(frame(spark, [])).count() == 0 and op.redact(frame(spark, [])).count() == 0


def test_redact(spark):
    df = docs(spark, sources={9: "a", 10: "a", 11: "a"})
    got = {r.doc_id: r for r in op.redact(df).collect()}
    assert op.redact(df).columns == df.columns and len(got) == len(TEXTS)
    assert got[0].text == "[assign]' end" and got[7].text == "[access]" and got[12].text == "" and got[13].text is None and got[9].text == "id [live] here"
    assert got[8].text == TEXTS[8] and HEX not in got[5].text
    twice = op.redact(frame(spark, ROWS + [(4, f"password={HEX}", None, "a", 1, "x")])).collect()
    assert len(twice) == len(ROWS) + 1 and sum(r.text == "[assign]" for r in twice) == 1


def test_plan_is_native(spark):
    plan = op.scan(docs(spark))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_equals_sql(spark, tmp_path):
    sources = {9: "a", 10: "a", 11: "a", 3: None}
    df = docs(spark, TEXTS + [f"copied {LIVE}Q {i}" for i in range(4)] + [f"x {LIVE}R=", f"a+b/{LIVE}"], sources)
    df.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    c = duckdb.connect()
    c.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert normal(op.scan(df).drop("found").toPandas()) == normal(c.execute(op.SQL).fetchdf())


def test_query_equals_sql(spark, sf):
    assert normal(queries.op3_secret_scan(spark, sf).toPandas()) == normal(connect(sf).execute(queries.oracle_sql()["op3_secret_scan"]).fetchdf())


def test_query(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = queries.op3_secret_scan(spark, sf).collect()
    assert len(got) == len(texts)
    check(got, texts)
