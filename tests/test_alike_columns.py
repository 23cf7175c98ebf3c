"""Columns that part the rows alike have one statistic, which is kept once; columns that only begin alike have their own."""

import pytest
from pyspark.sql import functions as F

from matchcast.operators import encode, models
from matchcast.shared import kept, remove
from tests.test_statistics_size import _written

COLUMNS = ["team", "rank", "near", "map"]


def _rows(spark):
    """rank follows from team and team from rank; near does for the first 30 rows only."""
    rows = [(i, f"T{i * i % 7}", i * i % 7 + 10, None if i * i % 7 == 4 else f"N{i * i % 7 if i <= 30 else i % 5}", "ab"[i % 2], None if i % 11 == 0 else i % 3 / 2, float(i % 4)) for i in range(1, 81)]
    return rows, spark.createDataFrame(rows, "seq long, team string, rank int, near string, map string, y double, x double")


@pytest.mark.parametrize("first, want", [(20, [[0], [1], [2], [3]]), (5000, [[0, 1], [2], [3]])])
def test_statistics_of_sets_equal_hand_counts(spark, monkeypatch, first, want):
    """If not all of a set that the first rows suggest holds, its columns stand alone."""
    monkeypatch.setattr(encode, "FIRST", first)
    rows, df = _rows(spark)
    sets, sums, folder = encode.alike_sums(df, COLUMNS, "y", span=7)
    assert sorted(sets) == want
    got = {r.seq: r for r in encode.target_statistics(df, COLUMNS, "y", [f"{c}_mean" for c in COLUMNS], span=7, sums=(sets, sums)).collect()}
    full = {(r.column, r.value): r.statistic for r in encode.full_statistics(sets, sums).collect()}
    remove(spark, folder)
    assert len(got) == len(rows) and len(full) == sum(len({r[i + 1] for r in rows}) for i in range(len(COLUMNS)))
    for row in rows:
        for i, c in enumerate(COLUMNS):
            same = [r for r in rows if r[i + 1] == row[i + 1] and r[5] is not None]
            before = [r[5] for r in same if r[0] < row[0]]
            assert got[row[0]][f"{c}_mean"] == pytest.approx((sum(before) + 0.5) / (len(before) + 1), abs=1e-12)
            key = "" if row[i + 1] is None else f"={row[i + 1]}"
            assert full[i, key] == pytest.approx((sum(r[5] for r in same) + 0.5) / (len(same) + 1), abs=1e-12)


def test_no_rows(spark):
    df = _rows(spark)[1].where("seq < 0")
    sets, sums, folder = encode.alike_sums(df, COLUMNS, "y")
    assert encode.target_statistics(df, COLUMNS, "y", list("abcd"), sums=(sets, sums)).count() == encode.full_statistics(sets, sums).count() == 0
    remove(spark, folder)


def test_a_booster_keeps_a_shared_statistic_once(spark, monkeypatch):
    seen = []

    def record(df, name):
        if name == "statistics":
            seen.append(df.columns)
        return kept(df, name)

    monkeypatch.setattr(models, "kept", record)
    df = _rows(spark)[1].where("y is not null")
    model = models.Booster(["x"], COLUMNS, "y", iterations=2, depth=2).fit(df)
    assert len(seen) == 1 and len(seen[0]) == 2 + 3  # x and y, and three statistics for four columns
    assert model.predict(df).count() == df.count() and model.model.numFeatures == 1 + len(COLUMNS)


def test_files_of_exchanges_go_once_rows_are_kept(spark):
    before = set(_written(spark))
    rows, folder = kept(spark.range(5000).repartitionByRange(5, "id").sortWithinPartitions("id"), "test")
    assert not set(_written(spark)) - before and rows.count() == 5000
    remove(spark, folder)
