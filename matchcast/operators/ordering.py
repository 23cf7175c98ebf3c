"""Row order as data: numbering, ordered splits, windows counted from the end, running sums.

No window here runs over all rows in one task: rows are range-partitioned, numbered within their partition, and the counts of the
partitions, a row each, give the offsets.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from matchcast.shared import cut


def with_seq(df: DataFrame, by: list[str], name: str = "seq", keep: Callable[[DataFrame], DataFrame] = cut) -> DataFrame:
    """Adds 1, 2, .. in the order of the columns ``by``; rows alike in all of them follow in any order. ``keep`` keeps the ordered rows."""
    inner = "_place"
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = keep(df.repartitionByRange(n, *by).sortWithinPartitions(*by).withColumn(inner, F.monotonically_increasing_id()))
    part = F.shiftright(inner, 33)
    counts = sorted((r["p"], r["n"]) for r in ordered.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect())
    before, offsets = 0, []
    for p, k in counts:
        offsets.append((p, before))
        before += k
    base = df.sparkSession.createDataFrame(offsets, "_p bigint, _base bigint")
    return ordered.withColumn("_p", part).join(F.broadcast(base), "_p").withColumn(name, F.col("_base") + F.col(inner).bitwiseAND(F.lit((1 << 33) - 1)) + 1).drop("_p", "_base", inner)


def counted(df: DataFrame, seq: str = "seq") -> DataFrame:
    """Adds n, the count of rows, and k, the place from the end (0 is last); rows must be numbered."""
    total = df.agg(F.max(seq).alias("n"))
    return df.crossJoin(F.broadcast(total)).withColumn("k", F.col("n") - F.col(seq))  # one row


def holdout(df: DataFrame, share: float = 0.07, nested: bool = False) -> DataFrame:
    """Adds part: the last ceil(share n) rows are ``test``; with ``nested``, the same share of the others is ``validation``."""
    rows = counted(df)
    test = F.ceil(F.col("n") * share - 1e-9)
    part = F.when(F.col("k") < test, F.lit("test"))
    if nested:
        part = part.when(F.col("k") < test + F.ceil((F.col("n") - test) * share - 1e-9), F.lit("validation"))
    return rows.withColumn("part", part.otherwise(F.lit("train"))).drop("n", "k")


def rolling_folds(df: DataFrame, folds: int = 4, train: int = 6000, validation: int = 500, step: int = 1000) -> DataFrame:
    """Rows of each fold, with fold and part; the last fold is the latest. In places from the end (0 is last), the validation window of
    fold f begins at ``step (folds - 1 - f) + validation - 1``, and the train window follows it, further back."""
    rows = counted(df)
    start = step * (folds - 1) + validation - 1
    found = []
    for f in range(folds):
        low = start - step * f  # least k of the train window
        found.append(F.when((F.col("k") >= low + validation) & (F.col("k") < low + validation + train), F.struct(F.lit(f).alias("fold"), F.lit("train").alias("part"))))
        found.append(F.when((F.col("k") >= low) & (F.col("k") < low + validation), F.struct(F.lit(f).alias("fold"), F.lit("validation").alias("part"))))
    return rows.withColumn("_in", F.explode(F.array_compact(F.array(*found)))).select(*df.columns, "k", "_in.fold", "_in.part")


def last_reversed(df: DataFrame, most: int = 9999, seq: str = "seq") -> DataFrame:
    """The last rows, numbered from the end by ``place`` (0 is last)."""
    return counted(df, seq).where(F.col("k") < most).withColumn("place", F.col("k")).drop("n", "k")


def batches(df: DataFrame, key: list[str], size: int = 1000, seed: int = 0) -> DataFrame:
    """Adds batch: rows in an order that the seed and the key give, in runs of ``size``."""
    mixed = df.withColumn("_mix", F.xxhash64(F.lit(seed), *key))
    return with_seq(mixed, ["_mix", *key], "_n").withColumn("batch", F.floor((F.col("_n") - 1) / size).cast("bigint")).drop("_mix", "_n")


def nth_sections(df: DataFrame, section: str, by: str, first: int | None = None, nth: int | None = None) -> DataFrame:
    """Rows of the first so many sections, or of the n-th (from 1), in the order of ``by`` over the distinct sections."""
    limit = first if first is not None else nth
    heads = df.groupBy(section).agg(F.min(by).alias("_at")).orderBy("_at", section).limit(limit)
    if nth is not None:
        heads = heads.orderBy(F.desc("_at"), F.desc(section)).limit(1) if heads.count() == nth else heads.limit(0)
    return df.join(F.broadcast(heads.drop("_at")), section)


def changes(df: DataFrame, value: str, by: list[str], within: list[str]) -> DataFrame:
    """Adds changed: 1 where the value differs from the row before it, or there is none."""
    prior = F.lag(value).over(Window.partitionBy(*within).orderBy(*by))
    return df.withColumn("changed", F.when(prior.eqNullSafe(F.col(value)) & prior.isNotNull(), 0).otherwise(1))


def running(df: DataFrame, key: str | list[str], value: Column, seq: str = "seq", span: int = 50_000) -> DataFrame:
    """Adds before_n and before_sum: count and sum of the value over the key's earlier rows; rows without a key are one key's.

    In two levels, by runs of ``span`` numbers, so that a key of very many rows is no single task's."""
    keys = [key] if isinstance(key, str) else key
    rows = df.withColumn("_v", value.cast("double")).withColumn("_b", F.floor(F.col(seq) / span))
    sums = rows.groupBy(*keys, "_b").agg(F.count("_v").alias("_n"), F.sum("_v").alias("_s"))
    earlier = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), F.col("_b").alias("_b0"), F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_n0"), F.coalesce(F.sum("_s").over(earlier), F.lit(0.0)).alias("_s0"))
    inner = Window.partitionBy(*keys, "_b").orderBy(seq).rowsBetween(Window.unboundedPreceding, -1)
    near = rows.withColumn("_n1", F.count("_v").over(inner)).withColumn("_s1", F.coalesce(F.sum("_v").over(inner), F.lit(0.0)))
    same = reduce(and_, (F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)), F.col("_b") == F.col("_b0"))
    return near.join(sums, same).withColumn("before_n", F.col("_n0") + F.col("_n1")).withColumn("before_sum", F.col("_s0") + F.col("_s1")).select(*df.columns, "before_n", "before_sum")


def share_rows(n: int, share: float = 0.07) -> int:
    """Rows of the held-out part."""
    return math.ceil(n * share - 1e-9)
