"""The engine by tasks: collect, score, fit, ask, show, and train on an experiment's rows. Pages and tables are DataFrames; dates are given."""

from __future__ import annotations

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from matchcast.functions import score as scores, text
from matchcast.operators import encode, evaluate, models, network, ordering, rows, serve
from matchcast.schema import MAPS, conform
from matchcast.sources import records
from matchcast.streaming.incremental import KEY


def parse(pages: DataFrame, ref: str, tz: str = "UTC") -> DataFrame:
    """Played maps of the day before ``ref``, both sides, a column per player."""
    found, _ = records.results(pages, tz=tz)
    return records.wide_maps(rows.on_day_before(found, "date", ref))


def score(history: DataFrame, origin: str) -> DataFrame:
    """The history with score and day offset."""
    return history.withColumn("score", scores.live_score(F.col("score_1"), F.col("score_2"))).withColumn("delta_time", F.datediff("date", F.lit(origin).cast("date")))


def parse_and_score(history: DataFrame, pages: DataFrame, ref: str, origin: str) -> DataFrame:
    """The history and the new day's maps that it lacks."""
    fresh = score(parse(pages, ref), origin).dropDuplicates(KEY).join(history.select(*KEY), KEY, "left_anti")
    return conform(rows.append(history, fresh), MAPS)


def fit(history: DataFrame, ref: str, days: int = 92, **options) -> models.Booster:
    """A boosted regressor of the score on the trailing days."""
    recent = ordering.with_seq(rows.trailing(history, "date", ref, days).where("score is not null"), KEY)
    return models.Booster(["delta_time"], models.CATEGORICAL, "score", **options).fit(recent)


def fit_and_save(history: DataFrame, ref: str, path: str, **options) -> models.Booster:
    model = fit(history, ref, **options)
    model.save(path)
    return model


def search_site(pages: DataFrame) -> DataFrame:
    """The maps of matches to be predicted."""
    return records.requests(pages)[0]


def normalize(requests: DataFrame, origin: str) -> DataFrame:
    """Model rows of requests: day offset, a column per player, ranks as numbers."""
    wide = records.wide_maps(requests).withColumn("delta_time", F.datediff(F.to_date("date"), F.lit(origin).cast("date")))
    for c in ("team_rank_1", "team_rank_2"):
        wide = wide.withColumn(c, F.col(c).try_cast("int"))
    return wide


def days(pages: DataFrame, most: int = 3) -> DataFrame:
    return records.day_names(pages, most=most)


def matches(pages: DataFrame, number_of_day: int, base: str, tz: str = "UTC") -> DataFrame:
    return records.upcoming(pages, number_of_day, base, tz=tz)


def most_valuable_predict_and_unknown_teams(predictions: DataFrame, upcoming: DataFrame, p: str = "p") -> DataFrame:
    """Every upcoming match (url) with the mean chance over its maps, unknown where there is none, and best: the one furthest from a half,
    the first by url of those alike."""
    mean = evaluate.mean_or_half(upcoming.select("url").join(predictions.select("url", p), "url", "left"), p, ["url"])
    best = evaluate.most_confident(mean.withColumn("_all", F.lit(1)), "mean", ["url"], ["_all"]).select(F.col("url").alias("_best"))
    return mean.join(F.broadcast(best), mean["url"] == best["_best"], "left").withColumn("best", F.col("_best").isNotNull()).drop("_best")


def probability(predictions: DataFrame, p: str = "p") -> DataFrame:
    """One text per match."""
    return serve.messages(predictions, ["url"], "team_1", "team_2", "map", p, "map_place")


def clean_few_teams(df: DataFrame, more_than: int = 9) -> DataFrame:
    return rows.frequent(df, "team_1", more_than)


def encode_teams(df: DataFrame) -> PipelineModel:
    return encode.one_hot(df, ["team_1", "team_2"], "zeros")


def encode_maps(df: DataFrame) -> PipelineModel:
    return encode.one_hot(df, ["map"], "zeros")


def encode_players(df: DataFrame, column: str = "players1") -> list[str]:
    """The vocabulary of line-ups that are still texts of lists."""
    return encode.vocabulary(df.select(text.list_of(F.col(column)).alias("names")), ["names"])


def make_datas(df: DataFrame, **sizes: int) -> DataFrame:
    """Rolling folds of numbered rows."""
    return ordering.rolling_folds(df, **sizes)


def training(df: DataFrame, features: str, target: str, key: list[str], **options) -> network.Network:
    return network.fit(df, features, target, key, **options)


def testing(df: DataFrame, net: network.Network, features: str, target: str, key: list[str], size: int = 1000, seed: int = 0) -> DataFrame:
    """Metrics over seeded batches."""
    scored = network.predict(df, net, features, [*key, target])
    return evaluate.batch_metrics(ordering.batches(scored, key, size, seed), "p", target, "batch")


def session_origin(spark: SparkSession, history: DataFrame, seq: list[str]) -> str:
    """The date of the history's first row in order."""
    return str(rows.origin_date(history, "date", seq).first()["origin"] or np.datetime64("1970-01-01"))
