"""Target statistics: the same as by hand, in any runs, and rows are exchanged once, as narrow as they are given."""

import pytest
from pyspark.sql import functions as F

from matchcast.operators import encode, models, ordering


def _written(spark):
    """Sizes of the files that exchanges have written."""
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    files = [found.apply(i) for i in range(found.size())]
    return {f.getPath(): f.length() for f in files if f.getName().startswith("shuffle")}


@pytest.mark.parametrize("span", [3, 7, 1000])
def test_statistics_equal_hand_counts(spark, span):
    rows = [(i, "abc"[i * i % 3] if i % 5 else None, i % 4, None if i % 6 == 0 else i / 8, f"x{i}") for i in range(1, 41)]
    df = spark.createDataFrame(rows, "seq long, a string, b int, y double, other string").repartition(5, "other")
    got = {r.seq: r for r in encode.target_statistics(df, ["a", "b"], "y", ["a_mean", "b_mean"], span=span).collect()}
    assert len(got) == len(rows) and got[1].asDict().keys() == {"seq", "a", "b", "y", "other", "a_mean", "b_mean"}
    for seq, *keys, _, other in rows:
        assert got[seq].other == other
        for place, out in ((1, "a_mean"), (2, "b_mean")):
            before = [r[3] for r in rows if r[0] < seq and r[place] == keys[place - 1] and r[3] is not None]
            assert got[seq][out] == pytest.approx((sum(before) + 0.5) / (len(before) + 1), abs=1e-12)


def test_no_rows(spark):
    df = spark.createDataFrame([], "seq long, a string, y double")
    assert encode.target_statistics(df, "a", "y", "m").columns == ["seq", "a", "y", "m"] and encode.target_statistics(df, "a", "y", "m").count() == 0


def test_rows_are_not_exchanged_by_column(spark):
    columns = [f"c{i}" for i in range(15)]
    df = spark.range(20_000).select(F.col("id").alias("seq"), (F.hash("id") % 97 / 97).alias("y"), *((F.hash("id", F.lit(c)) % 5).cast("string").alias(c) for c in columns))
    before = _written(spark)
    encode.target_statistics(df, columns, "y", [f"{c}_mean" for c in columns]).write.format("noop").mode("overwrite").save()
    assert sum(n for f, n in _written(spark).items() if f not in before) < 20_000 * 200


def test_view_is_added_after_the_exchange(spark):
    def view(df):
        return df.withColumn("team", (F.col("id") % 3).cast("string")).withColumn("x", (F.col("id") % 7).cast("double")).withColumn("wide", F.sha2(F.col("id").cast("string"), 512))

    df = ordering.with_seq(spark.range(600).withColumn("y", F.when(F.col("id") % 3 == 0, 0.9).otherwise(0.1)), ["id"])
    one, two = (m.predict(view(df)).select("id", "p") for m in (models.Booster(["x"], ["team"], "y", iterations=3, depth=2).fit(df, view=view), models.Booster(["x"], ["team"], "y", iterations=3, depth=2).fit(view(df))))
    assert {r.id: round(r.p, 9) for r in one.collect()} == {r.id: round(r.p, 9) for r in two.collect()}
    before = _written(spark)
    encode.target_statistics(df, ["team"], "y", ["m"], view=view, kept=["seq"]).write.format("noop").mode("overwrite").save()
    assert sum(n for f, n in _written(spark).items() if f not in before) < 600 * 64
