"""A join that deals rows of frequent keys over tasks gives the rows of a plain join."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from matchcast.llm.hot import split_join


@pytest.fixture(scope="module")
def tables(spark):
    rng = np.random.default_rng(5)
    keys = [int(k) for k in np.r_[np.zeros(900), np.ones(500), rng.integers(2, 400, 1300)]]
    rows = spark.createDataFrame([(k, i) for i, k in enumerate(keys)] + [(None, -1), (7777, -2)], "k bigint, i bigint")
    groups = rows.where("k < 7000").groupBy("k").agg(F.count("*").alias("n"), F.min("i").alias("least"))
    return rows, groups


def test_rows_are_those_of_a_join(tables):
    rows, groups = tables
    want = sorted(map(tuple, rows.join(groups, "k").select("k", "i", "n", "least").collect()))
    for shares, least in ((4096, 1024), (4096, 100), (8, 1), (4096, 1)):
        found = split_join(rows, groups, ["k"], ["i"], shares, least).select("k", "i", "n", "least")
        assert sorted(map(tuple, found.collect())) == want


def test_a_frequent_key_is_in_several_tasks(tables, spark):
    rows, groups = tables
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = split_join(rows, groups, ["k"], ["i"], 4096, 50).where("k = 0").groupBy(F.spark_partition_id()).count().collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(found) > 1 and sum(r["count"] for r in found) == 900


def test_empty(tables):
    rows, groups = tables
    for a, b in ((rows.limit(0), groups), (rows, groups.where("false"))):
        found = split_join(a, b, ["k"], ["i"], 8, 1)
        assert found.columns == ["k", "i", "n", "least"] and found.count() == 0
