"""The nightly job in one place: append the day, fit on the trailing days, keep the model."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession

from matchcast.operators.models import CATEGORICAL, Booster
from matchcast.operators.ordering import with_seq
from matchcast.operators.rows import append, trailing
from matchcast.sources import files
from matchcast.streaming.incremental import KEY, new_rows

#: The column by which the history's folder is divided: a batch per night, and one for what it began with.
BATCH = "batch"


def history_of(spark: SparkSession, folder: str) -> DataFrame | None:
    """The rows that the job has kept so far; None before its first night."""
    place = f"{folder}/history"
    return spark.read.option("mergeSchema", True).parquet(place).drop(BATCH) if files.exists(spark, place) else None


def _keep(rows: DataFrame, folder: str, batch: str) -> None:
    """Adds a batch of rows to the history: written elsewhere, then moved to its place whole."""
    spark, beside = rows.sparkSession, f"{folder}/staging-{uuid.uuid4().hex}"
    rows.write.parquet(beside)
    files.move(spark, beside, f"{folder}/history/{BATCH}={batch}-{uuid.uuid4().hex[:8]}")


def nightly(spark: SparkSession, history: DataFrame, new: DataFrame, ref: str, origin: str, folder: str, days: int = 92, **options) -> Booster:
    """``folder`` gets ``history`` (Parquet) and ``model``; the reference date is given, so a late run is the same run.

    ``history`` is what the job begins with, on its first night; later nights read what the folder has, and only add to it. Nothing that
    is there is written again: a run that fails leaves the history as it was or with the whole day, and the model of the night before.
    A second run of a night adds nothing and fits again."""
    if (kept := history_of(spark, folder)) is None:
        _keep(history, folder, "initial")
        kept = history_of(spark, folder)
    day = dt.date.fromisoformat(ref) - dt.timedelta(days=1)
    _keep(append(kept.limit(0), new_rows(kept, new, ref, origin)), folder, str(day))
    rows = trailing(history_of(spark, folder), "date", ref, days).where("score is not null")
    present = [c for c in CATEGORICAL if c in rows.columns]
    model = Booster(["delta_time"], present, "score", **options).fit(with_seq(rows, [c for c in KEY if c in rows.columns]))
    beside = f"{folder}/model-{uuid.uuid4().hex}"
    model.save(beside)
    files.swap(spark, beside, f"{folder}/model")
    return model
