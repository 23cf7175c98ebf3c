"""What is shown of predictions: texts per match, labels with marks, lines by match, and rows looked up by place."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from matchcast.functions.score import percent, three
from matchcast.functions.text import call, marked


def messages(df: DataFrame, match: list[str], team_1: str, team_2: str, map_: str, p: str, seq: str) -> DataFrame:
    """One text per match: a line for the match, one for each map with its chance, and one for the mean."""
    line = F.concat(F.col(map_), F.lit(": "), F.format_string("%.2f", percent(F.col(p))), F.lit("%"))
    mean = F.concat(F.lit("Среднее: "), F.format_string("%.2f", percent(F.avg(p))), F.lit("%"))
    lines = F.transform(F.array_sort(F.collect_list(F.struct(F.col(seq).alias("s"), line.alias("t")))), lambda x: x["t"])
    head = F.concat(F.lit("Игра "), F.first(team_1), F.lit(" vs "), F.first(team_2))
    return df.groupBy(*match).agg(F.concat_ws("\n", head, F.array_join(lines, "\n"), mean).alias("message"), F.avg(p).alias("mean"))


def labels(df: DataFrame, team_1: str, team_2: str, unknown: str, place: str, day: str) -> DataFrame:
    """Adds label, marked where a team is unknown, and the token that calls the match."""
    text = F.concat(F.col(team_1), F.lit(" - "), F.col(team_2))
    return df.withColumn("label", marked(text, F.col(unknown))).withColumn("token", call(F.col(place), F.col(day)))


def lines(df: DataFrame, team: str, p: str, seq: str, within: list[str]) -> DataFrame:
    """Adds p rounded to three decimals and gap: 1 where a row begins another match than the row before."""
    prior = F.lag(team).over(Window.partitionBy(*within).orderBy(seq))
    return df.withColumn("rounded", three(F.col(p))).withColumn("gap", (prior.isNotNull() & (prior != F.col(team))).cast("int"))


def at_place(df: DataFrame, place: int, seq: str = "seq") -> DataFrame:
    """The row of a place (from 0) of a numbered table."""
    return df.where(F.col(seq) == place + 1)
