import re

import pytest

from matchcast.llm import queries, url_filter as op
from matchcast.llm.vec import utf8
from tests.oracle import connect, normal

import pyarrow as pa


def matches(globs, urls):
    data, offsets = utf8(pa.array(urls, pa.string()))
    return op.Automaton([op.Rule((g,), "x") for g in globs]).match(data, offsets)


def as_regex(glob):
    out, i = "", 0
    while i < len(glob):
        if glob.startswith("**", i):
            out, i = out + ".*", i + 2
            continue
        out += {"*": "[^/]*", "?": "."}.get(glob[i], re.escape(glob[i]))
        i += 1
    return re.compile(out, re.S)


GLOBS = ["**", "*", "a*b", "a**b", "?b", "**.exe", "*.com/en/**", "com/en/**", "", "é?**", "a" * 70 + "**z", "**/x/**/y"]
URLS = ["", "a", "ab", "axxb", "a/b", "a/x/b", "éb", "éé", "x.exe", "q/x.exe", "b.com/en/1", "com/en/", "x/b.com/en/", "a" * 80 + "z", "p/x/q/y", "p/x/y", "日b"]


def test_automaton_equals_regular_expressions():
    got = matches(GLOBS, URLS)
    for i, u in enumerate(URLS):
        for j, g in enumerate(GLOBS):
            assert bool(got[i, j]) == bool(as_regex(g).fullmatch(u)), (g, u)


CASES = [
    ("https://A.Example.COM/en/7x?q", "a.example.com", "/en/7x", "example.com/en/7", "allow"), ("http://example.com/en/8", "example.com", "/en/8", "com/en/", "block"), ("http://notexample.com/en/7", "notexample.com", "/en/7", "com/en/", "block"),
    ("x://example.net/de/8#f", "example.net", "/de/8", "example.net/de/8", "block"), ("x://b.net/de/", "b.net", "/de/", "net/de/", "allow"), ("x://b.org/es", "b.org", "/es", None, "allow"), ("x://b.org/es/", "b.org", "/es/", "org/es/", "block"),
    ("no scheme", "", "", None, "allow"), (None, "", "", None, "allow"), ("", "", "", None, "allow"), ("://", "", "", None, "allow"), ("x:///com/en/", "", "/com/en/", None, "allow"), ("a://b?c://d", "b", "", None, "allow"),
    ("a://foo.de/x.com/en/", "foo.de", "/x.com/en/", None, "allow"), ("a://b.de/f.exe", "b.de", "/f.exe", None, "block"), ("a://ads.b.de/", "ads.b.de", "/", None, "block"), ("a://É.com/en/", "É.com", "/en/", "com/en/", "block"), ("a://com:80/en/", "com:80", "/en/", None, "allow"),
]


def test_cases(spark):
    df = spark.createDataFrame([(i, c[0], "x", "y") for i, c in enumerate(CASES)] + [(None, CASES[0][0], None, None)] * 2, "page_id bigint, url string, host string, rule string")
    got = {r.page_id: r for r in op.judge(df).collect()}
    for i, (_, *want) in enumerate(CASES):
        assert [got[i].host, got[i].path, got[i].rule, got[i].verdict] == want
    assert op.judge(df).count() == len(CASES) + 2 and op.judge(df.limit(0)).count() == 0
    long = spark.createDataFrame([(1, "a://b.com/en/" + "x/" * 50_000)], "page_id bigint, url string")
    assert op.judge(long).first().rule == "com/en/"


def test_of_equal_lengths_the_first_listed_wins(spark):
    df = spark.createDataFrame([(1, "a://b.com/xy/z")], "page_id bigint, url string")
    rules = op.host_rule("b.com", "/xy", "block"), op.host_rule("b.com", "/xy", "allow"), op.host_rule("b.com", "/x", "allow")
    assert op.judge(df, host_rules=rules).first().verdict == "block" and op.judge(df, host_rules=rules[1:] + rules[:1]).first().verdict == "allow"


@pytest.mark.parametrize("size", ["sf"])
def test_query_equals_sql(spark, sf, size):
    assert normal(queries.op4_url_filter(spark, sf).toPandas()) == normal(connect(sf).execute(queries.oracle_sql()["op4_url_filter"]).fetchdf())
