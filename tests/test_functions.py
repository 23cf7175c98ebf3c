import math

import pytest
from pyspark.sql import functions as F

from matchcast.functions import clean, html, score, text


def values(spark, schema, rows, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


#: Both formulas, computed by hand.
GOLDEN = [(16, 14, 0.5356537, 0.5445246), (14, 16, 0.4643463, 0.4547112), (19, 17, 0.5293779, 0.5366986), (16, 16, 0.5, 0.5), (16, 0, 1.0, 1.0), (0, 16, 0.0, 0.0), (1, 16, 3.059022e-07, 3.441691e-14), (0, 0, None, None)]


def test_scores(spark):
    got = values(spark, "a int, b int", [g[:2] for g in GOLDEN], score.live_score(F.col("a"), F.col("b")), score.notebook_score(F.col("a"), F.col("b")))
    for (_, _, x, y), (p, q) in zip(GOLDEN, got):
        assert (p is None) == (x is None) and (q is None) == (y is None)
        if x is not None:
            assert math.isclose(p, x, rel_tol=1e-6, abs_tol=1e-12) and math.isclose(q, y, rel_tol=1e-6, abs_tol=1e-16)


def test_live_score_is_antisymmetric(spark):
    rows = [(a, b) for a in range(17) for b in range(17) if a or b]
    got = values(spark, "a int, b int", rows, score.live_score(F.col("a"), F.col("b")) + score.live_score(F.col("b"), F.col("a")))
    assert all(math.isclose(x, 1.0, abs_tol=1e-12) for (x,) in got)


def test_rounding_and_bands(spark):
    assert values(spark, "p double", [(0.5,), (0.61,), (0.6,), (0.39,)], score.binary(F.col("p")), score.in_band(F.col("p"), F.lit(0.1))) == [(0, False), (1, True), (0 + 1, False), (0, True)]
    assert values(spark, "p double", [(0.125,)], score.percent(F.col("p"))) == [(12.5,)]
    assert values(spark, "e double", [(0.5,), (-3.0,), (1.0,)], score.huber(F.col("e"))) == [(0.125,), (2.5,), (0.5,)]


def test_cleaning(spark):
    rows = [("Rank: 12.", "Wins: 34 (55%)", "Points: 1,234", "Prize: 12,500 €", "#7"), ("Rank:-", "Wins", "Points:---", "Prize", "Unranked"), ("Rank:---", None, "Points: x", None, None)]
    c = F.col
    got = values(spark, "r string, w string, p string, m string, h string", rows, clean.rank(c("r")), clean.ratio(c("w")), clean.points(c("p")), clean.prize(c("m")), clean.hash_rank(c("h")))
    assert got == [(12, 55, 1234, 12500, 7), (0, None, 0, None, None), (0, None, None, None, None)]


def test_typed_puts_refused_rows_aside(spark):
    good, bad = clean.typed(spark.createDataFrame([("1", "a"), ("x", "b"), (None, "c")], "v string, k string"), {"v": "int"})
    assert sorted((r.v, r.k) for r in good.collect() if r.v) == [(1, "a")] and good.count() == 2
    assert [tuple(r) for r in bad.collect()] == [("x", "b")]


def test_lists(spark):
    rows = [("['a', 'b c', \"d'e\"]",), ("[]",), (None,)]
    got = values(spark, "x string", rows, text.list_of(F.col("x")), text.quoted_list_of(F.col("x")))
    assert got[0] == (["a", "b", "c", '"de"'], ["a", "b c", "d'e"]) and got[1] == ([], []) and got[2] == (None, None)


def test_sides_and_halves(spark):
    ten = [str(i) for i in range(10)]
    first, rest = text.halves(F.col("x"))
    got = values(spark, "x array<string>", [(ten,), (ten[:4],), ([],)], text.first_side(F.col("x")), text.second_side(F.col("x")), first, rest)
    assert got[0] == (ten[5:], ten[:4:-1], ten[:5], ten[5:])
    assert got[1] == (None, None, ten[:4], []) and got[2] == (None, None, [], [])


def test_days_and_tokens(spark):
    rows = [(1635717600000,)]
    at = text.millis(F.col("x"), "Europe/Moscow")
    assert values(spark, "x bigint", rows, text.clock(at), text.weekday(at), text.day_label(text.weekday(at)), text.day_label(text.weekday(at), True)) == [("01:00", "Monday", "Понедельник", "понедельник")]
    assert values(spark, "x bigint", [(1635717600,)], text.clock(text.seconds(F.col("x")))) == [("22:00",)]
    assert values(spark, "t string", [("m12%Monday",), ("updateMonday",), ("Monday",), ("m",)], *text.call_parts(F.col("t"))) == [("match", 12, "Monday"), ("update", None, "Monday"), ("other", None, None), ("match", None, None)]
    assert values(spark, "t string", [("Ёлка 5",)], text.leading_word(F.col("t"))) == [("Ёлка",)]
    assert values(spark, "a string, u boolean", [("x", True), ("y", False)], text.marked(F.col("a"), F.col("u"))) == [("❌x",), ("y",)]


def test_classes(spark):
    rows = [("results-left won",), ("won pick results-left",), (None,)]
    c = F.col("c")
    assert values(spark, "c string", rows, html.has_classes(c, "won", "results-left"), html.is_class(c, "results-left won")) == [(True, True), (True, False), (False, False)]


def test_nested_elements(spark):
    page = '<div class="a">x<div class="a">y<br>z</div><p>q</p></div><div class="a b">no</div><div class="a">w'
    pages = spark.createDataFrame([(1, page), (2, None), (3, "")], "id bigint, html string")
    assert sorted(map(tuple, html.elements(pages, "html", "div", "a", "id").collect())) == [(1, 0, "xyzq"), (1, 1, "yz"), (1, 2, "w")]


@pytest.mark.parametrize("tag,want", [("title", "T"), ("h1", None)])
def test_flat_fields(spark, tag, want):
    assert values(spark, "h string", [('<title>T</title><a class="k" href="/x">l</a>',)], html.text_of(F.col("h"), tag)) == [(want,)]
