"""Schemas of the logical tables, and the projection that every reader and writer goes through."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

SIDES = (1, 2)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


_S, _I, _L, _D, _DATE, _LIST = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.DateType(), T.ArrayType(T.StringType())
PLAYERS = [f"player{i}_team{s}" for s in SIDES for i in range(1, 6)]

#: One row per played map and side, with line-ups as lists.
MAPS_RAW = _struct(
    ("seq", _L), ("date", _DATE), ("team_1", _S), ("team_2", _S), ("score_1", _I), ("score_2", _I), ("players1", _LIST), ("players2", _LIST),
    ("map", _S), ("team_rank_1", _I), ("team_rank_2", _I), ("right_pick", _I), ("mean_rating1", _D), ("mean_rating2", _D),
)
#: The same with a column per player, the day offset and the score.
MAPS = _struct(
    ("date", _DATE), ("delta_time", _I), ("team_1", _S), ("team_2", _S), *((p, _S) for p in PLAYERS), ("team_rank_1", _I), ("team_rank_2", _I),
    ("score_1", _I), ("score_2", _I), ("map", _S), ("score", _D),
)
#: What the boosted models are fit on: the played maps and whether the side picked the map.
MAPS_BOOST = _struct(*((f.name, f.dataType) for f in MAPS.fields), ("right_pick", _I))
#: What the network is fit on; line-ups are still the text of a list.
MAPS_NET = _struct(("date", _DATE), ("team_1", _S), ("team_2", _S), ("players1", _S), ("players2", _S), ("map", _S), ("team_rank_1", _I), ("team_rank_2", _I), ("score", _D))
#: Matches of a coming day. The time of day stays a string.
UPCOMING = _struct(("time_of_the_match", _S), ("match_meta", _S), ("match_event", _S), ("team_1", _S), ("team_2", _S), ("url", _S))
#: One row per map of a match that is to be predicted.
REQUEST = _struct(("date", _S), ("team_1", _S), ("team_2", _S), ("map", _S), ("team_rank_1", _S), ("team_rank_2", _S), ("players1", _LIST), ("players2", _LIST))
#: Matches with line-ups and heroes as lists.
HEROES_RAW = _struct(
    *((f"{c}_team_{s}", t) for s in SIDES for c, t in (("name", _S), ("rank", _I), ("ratio", _I), ("points", _I), ("prize", _I), ("players", _LIST), ("heroes", _LIST))),
    ("won_team_1", _I), ("date", _DATE),
)
#: The same with a column per player and hero.
HEROES = _struct(
    ("date", _DATE), *((f"{c}_team_{s}", t) for s in SIDES for c, t in (("name", _S), ("rank", _I), ("ratio", _I), ("points", _I), ("prize", _I))),
    *((f"{c}{i}_team_{s}", _S) for c in ("player", "hero") for s in SIDES for i in range(1, 6)), ("won_team_1", _I),
)
TABLES = {"maps_raw": MAPS_RAW, "maps": MAPS, "maps_boost": MAPS_BOOST, "maps_net": MAPS_NET, "upcoming": UPCOMING, "request": REQUEST, "heroes_raw": HEROES_RAW, "heroes": HEROES}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema``, in its order and types; those that are missing are null. Other columns go."""
    have = {c.lower() for c in df.columns}
    return df.select(*((F.col(f.name) if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields))
