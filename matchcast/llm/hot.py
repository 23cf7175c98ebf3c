"""Joins by keys of which one may be that of a third of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

#: A key of more rows than one in ``SHARES`` of all, and than ``LEAST``, is dealt over parts of at most so many rows each.
SHARES, LEAST = 4096, 1024


def split_join(rows: DataFrame, groups: DataFrame, keys: list[str], by: list[str], shares: int = SHARES, least: int = LEAST) -> DataFrame:
    """``rows`` with the columns of ``groups``: one row per key, whose column ``n`` counts the rows of the key.

    Keys of many rows are dealt over parts by the hash of the columns ``by``, and their groups are repeated once per part. By their counts
    there are fewer than ``shares`` such keys, and fewer than twice as many parts, whatever the table: so the keys are broadcast. ``groups``
    is read three times and should be kept. Rows of keys that ``groups`` lacks, or of null keys, go, as in any inner join; where ``n`` is
    too small or ``by`` has ties, parts are larger and rows the same. Empty tables give an empty one. Neither side may have columns named
    ``_part`` or ``_parts``."""
    total, most = groups.agg(F.sum("n"), F.max("n")).first()
    share = max((total or 0) // shares, least)
    if (most or 0) <= share:
        return rows.join(groups, keys)
    parts = F.ceil(F.col("n") / share).cast("int")
    hot = groups.where(F.col("n") > share).select(*keys, parts.alias("_parts"))
    dealt = rows.join(F.broadcast(hot), keys, "left").withColumn("_part", F.coalesce(F.pmod(F.xxhash64(*by), F.col("_parts")).cast("int"), F.lit(0))).drop("_parts")
    copied = groups.withColumn("_part", F.explode(F.sequence(F.lit(0), F.greatest(parts, F.lit(1)) - 1)))
    return dealt.join(copied, [*keys, "_part"]).drop("_part")
