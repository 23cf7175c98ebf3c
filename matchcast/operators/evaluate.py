"""Accuracy, confidence bands and losses of predictions, and the choice among them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from matchcast.functions.score import binary, huber, in_band

#: Distances from a half at which accuracy and coverage are reported.
MARGINS = (0.0, 0.1, 0.15, 0.2)


def hit(p: Column, y: Column) -> Column:
    return (binary(p) == binary(y)).cast("double")


def accuracy(df: DataFrame, p: str, y: str, by: list[str] | None = None) -> DataFrame:
    return df.groupBy(*(by or [])).agg(F.avg(hit(F.col(p), F.col(y))).alias("accuracy"), F.count("*").alias("n"))


def bands(df: DataFrame, p: str, y: str, margins: tuple[float, ...] = MARGINS) -> DataFrame:
    """A row per margin: rows further than that from a half, the accuracy there (null if none) and their share of all rows.

    One aggregation over one scan: every margin is a pair of conditional sums."""
    sums = []
    for i, m in enumerate(margins):
        inside = in_band(F.col(p), F.lit(float(m)))
        sums += [F.sum(inside.cast("bigint")).alias(f"n{i}"), F.sum(F.when(inside, hit(F.col(p), F.col(y)))).alias(f"h{i}")]
    found = df.where(F.col(p).isNotNull() & F.col(y).isNotNull()).agg(F.count("*").alias("n"), *sums)
    rows = F.array(*(F.struct(F.lit(float(m)).alias("margin"), F.col(f"n{i}").alias("kept"), F.try_divide(F.col(f"h{i}"), F.col(f"n{i}")).alias("accuracy"), F.try_divide(F.col(f"n{i}").cast("double"), F.col("n")).alias("coverage")) for i, m in enumerate(margins)))
    return found.select(F.explode(rows).alias("b")).select("b.*")


def batch_metrics(df: DataFrame, p: str, y: str, batch: str, margin: float = 0.1) -> DataFrame:
    """One row: loss, accuracy, precision and recall as means over batches; accuracy outside the margin as the mean over the batches
    that have such rows; coverage over all rows together. 0 / 0 counts as 0 in precision and recall."""
    a, b = binary(F.col(p)), binary(F.col(y))
    both, said, real = ((a == 1) & (b == 1)).cast("bigint"), (a == 1).cast("bigint"), (b == 1).cast("bigint")
    inside = in_band(F.col(p), F.lit(margin))
    ratio = lambda x, z: F.coalesce(F.try_divide(F.sum(x), F.sum(z)), F.lit(0.0))
    each = df.groupBy(batch).agg(
        F.avg(huber(F.col(p) - F.col(y))).alias("loss"), F.avg(hit(F.col(p), F.col(y))).alias("accuracy"), ratio(both, said).alias("precision"), ratio(both, real).alias("recall"),
        F.avg(F.when(inside, hit(F.col(p), F.col(y)))).alias("band_accuracy"), F.sum(inside.cast("bigint")).alias("kept"), F.count("*").alias("n"),
    )
    return each.agg(*(F.avg(c).alias(c) for c in ("loss", "accuracy", "precision", "recall", "band_accuracy")), F.try_divide(F.sum("kept").cast("double"), F.sum("n")).alias("coverage"), F.count("*").alias("batches"))


def grid_means(df: DataFrame, params: list[str], score: str) -> DataFrame:
    """Unweighted mean of the folds' scores for each grid point."""
    return df.groupBy(*params).agg(F.avg(score).alias("score"), F.count("*").alias("folds"))


def best_points(df: DataFrame, score: str, order: list[str], lowest: bool = False) -> DataFrame:
    """The best grid point, the first of those alike. A best score has to be above 0 to count; a lowest loss need not."""
    rows = df if lowest else df.where(F.col(score) > 0)
    return rows.orderBy(F.col(score).asc() if lowest else F.col(score).desc(), *order).limit(1)


def improvements(df: DataFrame, score: str, seq: str, within: list[str], lowest: bool = False) -> DataFrame:
    """Rows that are better than all before them, as a search that keeps the best so far would note them."""
    value = -F.col(score) if lowest else F.col(score)
    prior = F.max(value).over(Window.partitionBy(*within).orderBy(seq).rowsBetween(Window.unboundedPreceding, -1))
    return df.withColumn("_best", prior).where(value > F.coalesce("_best", F.lit(float("-inf") if lowest else 0.0))).drop("_best")


def most_confident(df: DataFrame, p: str, seq: list[str], by: list[str]) -> DataFrame:
    """The row of each group whose prediction is furthest from a half, the first of those alike.

    An aggregation by the least (distance, order), so groups of any size are combined before they are exchanged."""
    key = F.struct((-F.abs(F.col(p) - 0.5)).alias("d"), *(F.col(c).alias(f"s{i}") for i, c in enumerate(seq)))
    return df.groupBy(*by).agg(F.min_by(F.struct(*[c for c in df.columns if c not in by]), key).alias("_r")).select(*by, "_r.*")


def mean_or_half(df: DataFrame, p: str, by: list[str]) -> DataFrame:
    """Mean of the predictions that are there, a half and unknown = true where none is."""
    mean = F.avg(F.nanvl(F.col(p), F.lit(None)))
    return df.groupBy(*by).agg(F.coalesce(mean, F.lit(0.5)).alias("mean"), mean.isNull().alias("unknown"))


def distinct_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, n): how many values each column has, nulls apart. One pass: values are combined before they are exchanged."""
    values = F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns)))
    every = df.select(values.alias("_v")).select("_v.*").distinct()
    return every.groupBy("column").agg(F.count("value").alias("n"))
