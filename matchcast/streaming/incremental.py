"""The daily append: new results join the history once, and only they are scored."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from matchcast.functions.score import live_score
from matchcast.operators.rows import append, on_day_before

KEY = ["date", "team_1", "team_2", "map"]


def append_day(history: DataFrame, new: DataFrame, ref: str, origin: str, key: list[str] | None = None) -> DataFrame:
    """The history and those new rows of the day before ``ref`` that it does not have, with score and day offset.

    A second run adds nothing: rows are the same by the key. Scores depend on their own row, so old rows keep theirs."""
    return append(history, new_rows(history, new, ref, origin, key))


def new_rows(history: DataFrame, new: DataFrame, ref: str, origin: str, key: list[str] | None = None) -> DataFrame:
    """What ``append_day`` adds."""
    key = key or KEY
    fresh = on_day_before(new, "date", ref).dropDuplicates(key)
    fresh = fresh.withColumn("score", live_score(F.col("score_1"), F.col("score_2"))).withColumn("delta_time", F.datediff("date", F.lit(origin).cast("date")))
    return fresh.join(history.select(*key), key, "left_anti")


def stream_files(spark: SparkSession, source: str, target: str, checkpoint: str, schema: T.StructType, origin: str, delay: str = "30 days") -> None:
    """Appends the new Parquet files of a folder to a table and stops once all are read; files are taken once each.

    Rows that repeat the key within the watermark's delay are dropped."""
    rows = spark.readStream.schema(schema).parquet(source).withColumn("at", F.col("date").cast("timestamp")).withWatermark("at", delay)
    rows = rows.dropDuplicatesWithinWatermark(KEY).drop("at")
    rows = rows.withColumn("score", live_score(F.col("score_1"), F.col("score_2"))).withColumn("delta_time", F.datediff("date", F.lit(origin).cast("date")))
    query = rows.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
