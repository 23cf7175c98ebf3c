import math

from pyspark.sql import functions as F

from matchcast import api
from matchcast.schema import HEROES, MAPS, MAPS_RAW, UPCOMING, conform
from matchcast.sources import records

DAY = 1635940800000  # 2021-11-03 12:00 UTC


def match_page(ranks=("#5", "#12"), maps=(("Nuke", "results-left won pick", "16", "14"), ("Dust2", "results-left lost", "1", "16"), ("Mirage", None, "-", "-")), players=range(20)):
    cell = lambda i: f'<td class="player"><div class="text-ellipsis">p{i}</div></td>'
    table = "".join(f'<table class="table totalstats"><tr><td class="rating text-center">R</td></tr>{"".join(f"<tr><td class=&quot;x&quot;></td><td class=\"rating text-center\">{r}</td></tr>" for r in rs)}</table>' for rs in ((1.0, 1.5), (0.5, 0.7)))
    blocks = "".join(f'<div class="mapholder"><div class="mapname">{m}</div>' + (f'<div class="{c}">' if c else '<div class="results-left">') + f'<div class="results-teamname text-ellipsis">A</div><div class="results-team-score">{s}</div></div><span class="results-right"><div class="results-teamname text-ellipsis">B</div><div class="results-team-score">{t}</div></span></div>' for m, c, s, t in maps)
    shown = "".join(f'<div class="teamRanking"><a>\n{r if r == "Unranked" else "World rank: " + r}\n</a></div>' for r in ranks)
    return f'<html><div class="date" data-unix="{DAY}">x</div><div class="teamName">A</div><div class="teamName">B</div>{shown}{blocks}{table}<br>{"".join(map(cell, players))}</html>'


def pages(spark, *html):
    return spark.createDataFrame([(f"u{i}", h) for i, h in enumerate(html)], "url string, html string")


def test_results(spark):
    found, rejects = records.results(pages(spark, match_page(), match_page(ranks=("Unranked", "#1")), "<html></html>", None))
    got = {(r.map, r.side): r for r in found.collect()}
    assert set(got) == {("Nuke", 0), ("Nuke", 1), ("Dust2", 0), ("Dust2", 1)} and {r.url for r in rejects.collect()} == {"u2", "u3"}
    a, b = got["Nuke", 0], got["Nuke", 1]
    assert (a.team_1, a.score_1, a.team_rank_1, a.right_pick, a.mean_rating1) == ("A", 16, 5, 0, 1.25) and (b.team_1, b.score_1, b.team_rank_1, b.right_pick, b.mean_rating1) == ("B", 14, 12, 1, 0.6)
    assert a.players1 == [f"p{i}" for i in range(5, 10)] and a.players2 == [f"p{i}" for i in range(19, 14, -1)] and got["Dust2", 0].right_pick == 1 and str(a.date) == "2021-11-03"
    assert set(MAPS_RAW.fieldNames()) - {"seq"} <= set(found.columns)


def test_requests(spark):
    later = match_page(maps=(("TBA", None, "", ""), ("TBA", None, "", "")))
    got = api.search_site(pages(spark, match_page(), later, match_page(ranks=("Unranked", "Unranked")))).collect()
    assert sorted((r.url, r.map) for r in got if r.url == "u0") == [("u0", "Dust2"), ("u0", "Mirage"), ("u0", "Nuke")] and sum(r.url == "u1" for r in got) == 7 and not any(r.url == "u2" for r in got)
    wide = api.normalize(api.search_site(pages(spark, match_page())), "2021-11-01").first()
    assert wide.delta_time == 2 and wide.player1_team1 == "p5" and wide.player1_team2 == "p19" and wide.team_rank_1 == 5


def list_page():
    match = lambda names, href: f'<a class="match a-reset" href="{href}"><div class="matchTime" data-unix="{DAY}"></div><div class="matchMeta">bo3</div>{"".join(f"<div class=\"matchTeamName text-ellipsis\">{n}</div>" for n in names)}<div class="matchEventName gtSmartphone-only">E</div></a>'
    return "".join(f'<div class="upcomingMatchesSection"><span class="matchDayHeadline">{d} - 2021-11-0{i}</span>{match(("A", "B"), f"/m{i}")}{match(("C",), "/n")}{match((), "/o")}</div>' for i, d in enumerate(("Monday", "Tuesday", "Wednesday", "Thursday")))


def test_upcoming(spark):
    got = api.matches(pages(spark, list_page()), 1, "https://example.org")
    assert got.columns == UPCOMING.fieldNames() and [tuple(r) for r in got.collect()] == [("12:00", "bo3", "E", "A", "B", "https://example.org/m1")]
    assert [r.day for r in api.days(pages(spark, list_page())).orderBy("section").collect()] == ["Monday", "Tuesday", "Wednesday"]


def test_hero_matches(spark):
    team = lambda n, rank: f'<div class="widget-team"><div class="txt-content">{n}</div><ul class="widget-icon-info"><li>Rank: {rank}.</li><li>Wins: 3 (55%)</li><li>Points: 1,234</li><li>Prize: 12,500 €</li></ul></div>'
    pick = lambda i: f'<li><img title="h{i}"><span>p{i}</span></li>'
    section = lambda n, icon: f'<section class="antispoiler-hide boxed-section x"><div class="content-match-sub-team-titles">{icon}</div><ul class="content-match-sub-picks">{"".join(map(pick, range(n // 2)))}</ul><ul class="content-match-sub-picks">{"".join(map(pick, range(n // 2, n)))}</ul></section>'
    html = f'<span class="tztime" data-time="1635940800"></span>{team("A", 1)}{team("B", "---")}{section(10, "<i class=icon-winner></i>")}{section(0, "")}<section class="boxed-section">no</section>'
    found, rejects = records.hero_matches(pages(spark, html, "<p>"))
    got = found.collect()
    assert len(got) == 1 and got[0].rank_team_1 == 1 and got[0].rank_team_2 == 0 and got[0].prize_team_1 == 12500 and got[0].won_team_1 == 1 and got[0].heroes_team_2 == [f"h{i}" for i in range(5, 10)] and str(got[0].date) == "2021-11-03"
    wide = records.wide_heroes(found)
    assert wide.columns == HEROES.fieldNames() and wide.first().hero1_team_2 == "h5" and rejects.count() == 1


def test_collect_once_and_score(spark):
    empty = spark.createDataFrame([], MAPS)
    once = api.parse_and_score(empty, pages(spark, match_page()), "2021-11-04", "2021-11-01")
    assert once.count() == 4 and api.parse_and_score(once, pages(spark, match_page()), "2021-11-04", "2021-11-01").count() == 4 and api.parse(pages(spark, match_page()), "2021-11-05").count() == 0
    got = {(r.team_1, r.map): r.score for r in once.collect()}
    assert math.isclose(got["A", "Nuke"], 0.5356537, rel_tol=1e-6) and math.isclose(got["A", "Nuke"] + got["B", "Nuke"], 1)


def test_show(spark):
    upcoming = conform(spark.createDataFrame([("u0",), ("u1",), ("u2",)], "url string"), UPCOMING)
    p = spark.createDataFrame([("u0", "A", "B", "Nuke", 0, 0.4), ("u0", "A", "B", "Dust2", 1, 0.8), ("u1", "C", "D", "Nuke", 0, 0.2)], "url string, team_1 string, team_2 string, map string, map_place int, p double")
    got = {r.url: (round(r["mean"], 6), r.unknown, r.best) for r in api.most_valuable_predict_and_unknown_teams(p, upcoming).collect()}
    assert got == {"u0": (0.6, False, False), "u1": (0.2, False, True), "u2": (0.5, True, False)}
    assert next(r.message for r in api.probability(p).collect() if r.url == "u0") == "Игра A vs B\nNuke: 40.00%\nDust2: 80.00%\nСреднее: 60.00%"


def test_experiment(spark):
    df = spark.range(60).select("id", F.lit("['a', 'b']").alias("players1"), F.concat(F.lit("t"), (F.col("id") % 2).cast("string")).alias("team_1"), F.lit("t0").alias("team_2"), F.lit("Nuke").alias("map"), F.array((F.col("id") / 60).cast("double")).alias("x"), (F.col("id") / 60).cast("double").alias("y"))
    assert api.encode_players(df) == ["a", "b"] and api.clean_few_teams(df).count() == 60 and api.encode_maps(df).transform(df).first().map_hot.size == 1 and api.encode_teams(df).transform(df).count() == 60
    got = api.testing(df, api.training(df, "x", "y", ["id"], scale=0.02, epochs=2, batch=20), "x", "y", ["id"], size=20).first()
    assert got.batches == 3 and 0 <= got.accuracy <= 1
