"""Queries that get pages and read records from their markup. The pages are made from the rows of a table, so that SQL can say what has to
be found in them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from matchcast.operators import ordering, serve
from matchcast.operators.rows import UNRANKED
from matchcast.plans.bindings import table
from matchcast.registry import query, six
from matchcast.sources import files, pages, records


@query("SELECT CAST(row_number() OVER (ORDER BY n_nationkey, n_name, n_regionkey) - 1 AS BIGINT) AS seq, n_nationkey, n_name, n_regionkey FROM nation")
def q50_csv_with_index(spark, sf_dir):
    nation = table(spark, sf_dir, "nation")
    path = files.write_csv(nation, files.scratch(spark, "nation"), index=True)
    return files.read_csv(spark, path, T.StructType([T.StructField("seq", T.LongType()), *nation.schema.fields]))


def _archive(url: str, agent: str | None) -> str:
    """A page for every address but each seventh, which is not there."""
    number = int(url.rpartition("=")[2])
    if number % 7 == 0:
        raise LookupError(number)
    return f'<h1>Page {number}</h1><a class="pagination-prev" href="/list?page={number - 3}">older</a>'


@query("""SELECT (page - 1) // 20 AS pack, page, CASE WHEN page % 7 <> 0 THEN concat('Page ', page) END AS title, CASE WHEN page % 7 = 0 THEN concat('LookupError: ', page) END AS error FROM (SELECT unnest(range(1, 1001)) AS page)""")
def q51_packs(spark, sf_dir):
    got = pages.fetch(pages.list_pages(spark, "https://example.org/list?page=%d"), _archive, agents=("one", "two"))
    return got.select("pack", "page", F.regexp_extract("html", "<h1>([^<]*)</h1>", 1).alias("title"), "error")


def _list_page(url: str, agent: str | None) -> str:
    """A list with a link to the one before it, while there is one."""
    offset = int(url.rpartition("=")[2])
    link = f'<a class="pagination-prev" href="/results?offset={offset - 100}">older</a>' if offset >= 100 else '<a class="pagination-prev">older</a>'
    return f"<div><a href='/results?offset={offset + 100}' class='pagination-next'>newer</a>{link}</div>"


@query("""SELECT concat('https://example.org/results?offset=', n_nationkey * 500) AS start, CAST(place AS INTEGER) AS place, concat('https://example.org/results?offset=', n_nationkey * 500 - place * 100) AS url
FROM nation, (SELECT unnest(range(79)) AS place) WHERE n_nationkey * 500 >= place * 100""")
def q52_crawl(spark, sf_dir):
    starts = table(spark, sf_dir, "nation").select(F.concat(F.lit("https://example.org/results?offset="), (F.col("n_nationkey") * 500).cast("string")).alias("url"))
    return pages.follow(starts, _list_page, "https://example.org").select("start", "place", "url")


def _element(tag: str, class_: Column | str, *inside: Column) -> Column:
    return F.concat(F.lit(f'<{tag} class="'), F.lit(class_) if isinstance(class_, str) else class_, F.lit('">'), *inside, F.lit(f"</{tag}>"))


def match_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(o_orderkey, html): a page per order, with one map that was played unless the order's key is a multiple of 3, and one that never was."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    text = lambda x: x.cast("string")
    rank = lambda x, n: F.when(x % n == 0, F.lit(UNRANKED)).otherwise(F.concat(F.lit("#"), text(x % 90 + 1)))
    names = [*(F.lit(f"X{i}") for i in range(5)), *(F.concat(F.lit("P"), text((c * 5 + i) % 400)) for i in range(10))]
    left = F.element_at(F.array(*(F.lit(x) for x in records.PLAYED)), (k % 4 + 1).cast("int"))
    team = [F.concat(F.lit("A"), text(k)), F.concat(F.lit("B"), text(c))]
    ratings = lambda x: _element("table", records.TABLE, F.lit("<tr>"), *(_element("td", records.RATING, v) for v in (F.lit("Rating"), text(x % 10 / 10.0), text((x + 3) % 10 / 10.0), F.lit("1.5"))), F.lit("</tr>"))
    played = _element("div", records.MAP, _element("div", records.MAP_NAME, F.lit("Nuke")), *(_element("div", records.TEAM, t) for t in team), F.when(k % 3 != 0, _element("div", left, F.lit(""))).otherwise(F.lit("")), *(_element("div", records.POINTS, text(x % 17)) for x in (k, c)))
    absent = _element("div", records.MAP, _element("div", records.MAP_NAME, F.lit("Train")), _element("div", "results-left", F.lit("-")))
    html = F.concat(
        F.lit('<html><div class="date" data-unix="'), F.when(k % 11 == 0, F.lit("soon")).otherwise(text(F.unix_millis(F.col("o_orderdate").cast("timestamp")))), F.lit('"></div>'),
        *(_element("div", records.RANK, x) for x in (rank(k, 7), rank(c, 13))), *(_element("div", records.TEAM_HEAD, t) for t in team),
        *(_element("td", records.PLAYER, F.lit("<span>"), _element("div", records.NAME, n), F.lit("</span>")) for n in names), ratings(k), ratings(c), played, absent, F.lit("</html>"),
    )
    orders = table(spark, sf_dir, "orders").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "o_orderkey")  # pages are larger than their rows
    return orders.select("o_orderkey", html.alias("html"))


_MATCHES = """p AS (SELECT *, list_transform(range(10), lambda i: concat('P', (o_custkey * 5 + i) % 400)) AS players FROM orders WHERE o_orderkey % 11 <> 0 AND o_orderkey % 7 <> 0 AND o_custkey % 13 <> 0),
m AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date, concat('A', o_orderkey) AS a, concat('B', o_custkey) AS b, CAST(o_orderkey % 17 AS INTEGER) AS x, CAST(o_custkey % 17 AS INTEGER) AS y, CAST(o_orderkey % 90 + 1 AS INTEGER) AS r, CAST(o_custkey % 90 + 1 AS INTEGER) AS s,
  array_to_string(players[1:5], ' ') AS f, array_to_string(list_reverse(players[6:10]), ' ') AS g, round((o_orderkey % 10 / 10.0 + (o_orderkey + 3) % 10 / 10.0 + 1.5) / 3, 6) AS v, round((o_custkey % 10 / 10.0 + (o_custkey + 3) % 10 / 10.0 + 1.5) / 3, 6) AS w,
  CASE WHEN o_orderkey % 4 IN (0, 2) THEN 0 ELSE 1 END AS pick FROM p WHERE o_orderkey % 3 <> 0)"""


@query(f"""WITH {_MATCHES}
SELECT o_orderkey, 0 AS side, date, 'Nuke' AS map, a AS team_1, b AS team_2, x AS score_1, y AS score_2, r AS team_rank_1, s AS team_rank_2, f AS players1, g AS players2, v AS mean_rating1, w AS mean_rating2, pick AS right_pick FROM m
UNION ALL SELECT o_orderkey, 1, date, 'Nuke', b, a, y, x, s, r, g, f, w, v, 1 - pick FROM m""")
def q53_match_pages(spark, sf_dir):
    found, _ = records.results(match_pages(spark, sf_dir), "o_orderkey")
    return found.select(
        "o_orderkey", "side", "date", "map", "team_1", "team_2", "score_1", "score_2", "team_rank_1", "team_rank_2", *(F.array_join(f"players{i}", " ").alias(f"players{i}") for i in (1, 2)), *(six(f"mean_rating{i}").alias(f"mean_rating{i}") for i in (1, 2)), "right_pick"
    )


@query("SELECT o_orderkey, 'invalid literal for int() with base 10: ''soon''' AS missing FROM orders WHERE o_orderkey % 11 = 0")
def q54_rejected_pages(spark, sf_dir):
    return records.results(match_pages(spark, sf_dir), "o_orderkey")[1].select("o_orderkey", "missing")


@query("""SELECT c_custkey, CAST(c_custkey % 2 AS INTEGER) AS won_team_1, DATE '2021-01-01' + CAST(c_custkey % 300 AS INTEGER) AS date, concat('N', c_custkey) AS name_team_1, concat('M', c_custkey) AS name_team_2,
  CASE WHEN c_custkey % 9 = 0 THEN 0 ELSE CAST(c_custkey % 50 AS INTEGER) END AS rank_team_1, CAST(c_custkey % 101 AS INTEGER) AS ratio_team_2, CAST(c_custkey * 7 AS INTEGER) AS prize_team_1,
  array_to_string(list_transform(range(5), lambda i: concat('p', i, '_', c_custkey)), ' ') AS players_team_1, array_to_string(list_transform(range(5, 10), lambda i: concat('p', i, '_', c_custkey)), ' ') AS players_team_2,
  array_to_string(list_transform(range(5), lambda i: concat('h', (c_custkey + i) % 120)), ' ') AS heroes_team_1, array_to_string(list_transform(range(5, 10), lambda i: concat('h', (c_custkey + i) % 120)), ' ') AS heroes_team_2
FROM customer WHERE c_custkey % 8 <> 0""")
def q55_hero_pages(spark, sf_dir):
    c = F.col("c_custkey")
    text = lambda x: x.cast("string")
    infos = [F.concat(F.lit("Rank: "), F.when(c % 9 == 0, F.lit("---")).otherwise(text(c % 50)), F.lit(".")), F.concat(F.lit("Wins: 34 ("), text(c % 101), F.lit("%)")), F.concat(F.lit("Points: "), text(c)), F.concat(F.lit("Prize: "), F.format_number(c * 7, 0), F.lit(" €"))]
    widget = lambda name: _element("div", records.WIDGET, _element("div", records.CONTENT, name), _element("ul", records.INFO, *(F.concat(F.lit("<li>"), i, F.lit("</li>")) for i in infos)))
    pick = lambda i: F.concat(F.lit('<li><img title="h'), text((c + i) % 120), F.lit('"><span>p'), F.lit(str(i)), F.lit("_"), text(c), F.lit("</span></li>"))
    lists = [F.when(c % 8 != 0, _element("ul", records.PICKS, *map(pick, half))).otherwise(F.lit("")) for half in (range(3), range(3, 5), range(5, 10))]
    section = _element("section", " ".join(("extra", *records.SHOWN)), _element("div", records.TITLES, F.when(c % 2 == 1, F.lit('<i class="icon-winner"></i>')).otherwise(F.lit(""))), *lists)
    html = F.concat(widget(F.concat(F.lit("N"), text(c))), widget(F.concat(F.lit("M"), text(c))), F.lit('<span class="tztime" data-time="'), text(F.unix_timestamp(F.lit("2021-01-01").cast("timestamp")) + c % 300 * 86400), F.lit('"></span>'), section)
    found, _ = records.hero_matches(table(spark, sf_dir, "customer").select("c_custkey", html.alias("html")), "c_custkey")
    sides = [F.array_join(f"{n}_team_{s}", " ").alias(f"{n}_team_{s}") for n in ("players", "heroes") for s in (1, 2)]
    return found.select("c_custkey", "won_team_1", "date", "name_team_1", "name_team_2", "rank_team_1", "ratio_team_2", "prize_team_1", *sides)


@query("""WITH n AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS place FROM orders) SELECT place + 1 AS seq, o_orderkey FROM n WHERE place = 137""")
def q56_row_of_a_call(spark, sf_dir):
    """The row that a token of a list calls for, by its place."""
    from matchcast.functions.text import call_parts

    place = spark.range(1).select(call_parts(F.lit("m137%fri"))[1].alias("place")).first()["place"]
    orders = ordering.with_seq(table(spark, sf_dir, "orders").select("o_orderdate", "o_orderkey"), ["o_orderdate", "o_orderkey"])
    return serve.at_place(orders, place).select("seq", "o_orderkey")
