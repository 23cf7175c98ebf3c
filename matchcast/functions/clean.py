"""Cleaning of scraped strings, and casts that put what they refuse aside."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

#: What stands for no rank and for no points.
NO_RANK, NO_POINTS = ("-", "---"), ("---",)


def after(x: Column, mark: str) -> Column:
    """The second part of a split, or null."""
    return F.get(F.split(x, mark, -1), F.lit(1))


def sentinel(x: Column, absent: tuple[str, ...]) -> Column:
    """Text with the absent marks as "0"; compared without the blanks around."""
    return F.when(F.trim(x).isin(*absent), F.lit("0")).otherwise(x)


def hash_rank(x: Column) -> Column:
    """``#12`` to 12."""
    return F.trim(after(x, "#")).try_cast("int")


def rank(x: Column) -> Column:
    """``Rank: 12.`` to 12; no rank is 0."""
    return F.trim(sentinel(F.btrim(after(x, ":"), F.lit(".")), NO_RANK)).try_cast("int")


def ratio(x: Column) -> Column:
    """``Wins: 34 (55%)`` to 55."""
    return F.btrim(F.regexp_extract(x, r"\((.+?)\)", 1), F.lit("%")).try_cast("int")


def points(x: Column) -> Column:
    """``Points: 1,234`` to 1234; no points are 0."""
    return F.trim(sentinel(F.replace(after(x, ":"), F.lit(","), F.lit("")), NO_POINTS)).try_cast("int")


def prize(x: Column) -> Column:
    """``Prize: 12,500 €`` to 12500."""
    return F.trim(F.replace(F.regexp_extract(x, ":(.+?)€", 1), F.lit(","), F.lit(""))).try_cast("int")


def typed(df: DataFrame, casts: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """Rows whose columns all take their types, so cast; and the others as they were. Nulls take any type."""
    bad = reduce(lambda a, b: a | b, (F.col(c).isNotNull() & F.col(c).try_cast(t).isNull() for c, t in casts.items()))
    good = df.where(~bad).select(*(F.col(c).try_cast(casts[c]).alias(c) if c in casts else F.col(c) for c in df.columns))
    return good, df.where(bad)
