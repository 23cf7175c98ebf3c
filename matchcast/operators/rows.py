"""Filters, expansions and row augmentation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from matchcast.shared import BROADCAST_BYTES, cut

#: The maps a match may be played on while they are to be announced, and the mark for that.
MAP_POOL = ("Dust2", "Mirage", "Inferno", "Nuke", "Overpass", "Vertigo", "Ancient")
TO_BE_ANNOUNCED, UNRANKED = "TBA", "\nUnranked\n"


def trailing(df: DataFrame, date: str, ref: str, days: int = 92) -> DataFrame:
    """Rows later than so many days before the reference date."""
    return df.where(F.to_date(date) > F.date_sub(F.lit(ref).cast("date"), days))


def on_day_before(df: DataFrame, date: str, ref: str) -> DataFrame:
    return df.where(F.to_date(date) == F.date_sub(F.lit(ref).cast("date"), 1))


def both_ranked(df: DataFrame, a: str, b: str, unranked: str = UNRANKED) -> DataFrame:
    return df.where((F.col(a) != unranked) & (F.col(b) != unranked))


def either_within(df: DataFrame, a: str, b: str, most: int = 50) -> DataFrame:
    return df.where((F.col(a) <= most) | (F.col(b) <= most))


def with_first(df: DataFrame, xs: str) -> DataFrame:
    """Rows whose list has a first item that is not empty."""
    return df.where((F.size(xs) > 0) & (F.get(F.col(xs), F.lit(0)) != ""))


def decided(df: DataFrame, names: str) -> DataFrame:
    """Rows whose list of names begins and ends with different ones; a single name is not enough."""
    return df.where((F.size(names) > 0) & (F.get(F.col(names), F.lit(0)) != F.element_at(F.col(names), -1)))


def frequent(df: DataFrame, key: str, more_than: int = 9) -> DataFrame:
    """Rows whose key has more rows than that. Keys are counted once; they are sent to all executors only if they are few."""
    keys = cut(df.groupBy(key).agg(F.count("*").alias("_n")).where(F.col("_n") > more_than).select(key))
    small = keys.count() * 64 <= BROADCAST_BYTES
    return df.join(F.broadcast(keys) if small else keys, key, "left_semi")


def expand_maps(df: DataFrame, maps: str, out: str = "map") -> DataFrame:
    """A row per played map; where the first is to be announced, one per map of the pool."""
    pool = F.array(*map(F.lit, MAP_POOL))
    every = F.when(F.get(F.col(maps), F.lit(0)) == TO_BE_ANNOUNCED, pool).otherwise(F.col(maps))
    return df.select("*", F.posexplode(every).alias("map_place", out))


def mirror(df: DataFrame, pairs: list[tuple[str, str]], inverted: tuple[str, ...] = ()) -> DataFrame:
    """Every row and, with the columns of each pair swapped and the 0/1 columns of ``inverted`` turned, its mirror image, in one scan.

    Adds side: 0 as it was, 1 mirrored."""
    swap = {a: b for p in pairs for a, b in (p, p[::-1])}
    kept = [c for c in df.columns if c not in swap and c not in inverted]
    changed = [c for c in df.columns if c in swap or c in inverted]
    forth = F.struct(F.lit(0).alias("side"), *(F.col(c).alias(c) for c in changed))
    back = F.struct(F.lit(1).alias("side"), *((F.col(swap[c]) if c in swap else 1 - F.col(c)).cast(df.schema[c].dataType).alias(c) for c in changed))
    turned = df.select(*kept, F.explode(F.array(forth, back)).alias("_m"))
    return turned.select("_m.side", *(F.col(f"_m.{c}") if c in changed else F.col(c) for c in df.columns))


def append(df: DataFrame, *others: DataFrame) -> DataFrame:
    """All rows, by column name; columns that some lack are null there."""
    for o in others:
        df = df.unionByName(o, allowMissingColumns=True)
    return df


def right_pick(left_class: Column, picked: str) -> Column:
    """0 where the left side's class says that it picked the map, else 1."""
    return (~F.coalesce(F.contains(left_class, F.lit(picked)), F.lit(False))).cast("int")


def distinct_values(df: DataFrame, columns: list[str], name: str = "value") -> DataFrame:
    """Distinct values over several columns or lists."""
    parts = [F.col(c) if df.schema[c].dataType.typeName() == "array" else F.array(c) for c in columns]
    return df.select(F.explode(F.concat(*parts)).alias(name)).where(F.col(name).isNotNull()).distinct()


def origin_date(df: DataFrame, date: str, seq: list[str]) -> DataFrame:
    """One row: the date of the first row in order, which need not be the least."""
    return df.agg(F.min_by(F.to_date(date), F.struct(*seq)).alias("origin"))
