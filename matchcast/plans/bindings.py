"""The played maps as a view of a table of order lines: each side, its lists and a prediction follow from the line's keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from matchcast.operators.ordering import with_seq
from matchcast.operators.rows import MAP_POOL

#: What makes a row of the view, and its order.
KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
ORDER = ["date", *KEY]
#: The same view in SQL.
VIEW = """matches_v AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_shipdate AS DATE) AS date,
         concat('T', CAST(l_suppkey AS VARCHAR)) AS team_1, concat('T', CAST(l_partkey % 100 AS VARCHAR)) AS team_2,
         CAST(CAST(floor(l_quantity) AS BIGINT) % 17 AS INTEGER) AS score_1, CAST(l_partkey % 17 AS INTEGER) AS score_2,
         l_suppkey AS team_rank_1, l_partkey % 100 + 1 AS team_rank_2, l_returnflag AS pick,
         CAST((l_orderkey * 7919 + l_partkey * 104729 + l_linenumber) % 1000 AS DOUBLE) / CAST(1000 AS DOUBLE) AS pred,
         ['Dust2', 'Mirage', 'Inferno', 'Nuke', 'Overpass', 'Vertigo', 'Ancient'][CAST(l_orderkey % 7 AS BIGINT) + 1] AS map
  FROM lineitem
), numbered AS (
  SELECT *, row_number() OVER (ORDER BY date, l_orderkey, l_linenumber, l_partkey, l_suppkey) AS seq FROM matches_v
)"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    rows = table(spark, sf_dir, "lineitem").select(*KEY, c("l_shipdate").cast("date").alias("date"), (F.floor("l_quantity").cast("bigint") % 17).cast("int").alias("score_1"), c("l_returnflag").alias("pick"))
    return of_keys(rows).select(*KEY, "date", "team_1", "team_2", "score_1", "score_2", "team_rank_1", "team_rank_2", "pick", "pred", "map", "players")


def of_keys(rows: DataFrame) -> DataFrame:
    """Adds the columns of the view that follow from the line's keys alone."""
    c = F.col
    return rows.select(
        "*",
        F.concat(F.lit("T"), c("l_suppkey").cast("string")).alias("team_1"),
        F.concat(F.lit("T"), (c("l_partkey") % 100).cast("string")).alias("team_2"),
        (c("l_partkey") % 17).cast("int").alias("score_2"),
        c("l_suppkey").alias("team_rank_1"),
        (c("l_partkey") % 100 + 1).alias("team_rank_2"),
        (((c("l_orderkey") * 7919 + c("l_partkey") * 104729 + c("l_linenumber")) % 1000).cast("double") / F.lit(1000.0)).alias("pred"),
        F.get(F.array(*map(F.lit, MAP_POOL)), (c("l_orderkey") % 7).cast("int")).alias("map"),
        F.array(*(F.concat(F.lit("P"), ((c("l_suppkey") * 5 + i) % 400).cast("string")) for i in range(10))).alias("players"),
    )


def numbered(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The view with seq; with ``columns``, these and the key alone, which is less to exchange."""
    rows = matches(spark, sf_dir)
    return with_seq(rows.select(*dict.fromkeys([*ORDER, *columns])) if columns else rows, ORDER)
