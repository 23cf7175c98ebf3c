import pytest

import __spark_entry__ as entry
from matchcast import queries as own
from tests.oracle import connect, normal


@pytest.fixture(scope="module")
def duck(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(own.oracle_sql()))
def test_query_equals_sql(spark, sf, duck, name):
    assert normal(own.queries()[name](spark, sf).toPandas()) == normal(duck.execute(own.oracle_sql()[name]).fetchdf())


@pytest.mark.parametrize("name", sorted(set(own.queries()) - set(own.oracle_sql())))
def test_other_queries_have_rows(spark, sf, name):
    assert own.queries()[name](spark, sf).count() > 0


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert [r["margin"] for r in rows] == [0.0, 0.1, 0.15, 0.2]
    assert rows[0]["coverage"] == 1.0 and all(a["coverage"] >= b["coverage"] for a, b in zip(rows, rows[1:]))


def test_every_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
