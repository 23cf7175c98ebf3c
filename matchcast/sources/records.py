"""Match records from pages: a parser reads what a page holds into one nested row, and column expressions do the rest.

A page that lacks something it must have gives no records and one reject (its key and what was missing).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from matchcast.functions import clean, text
from matchcast.functions.html import VOID
from matchcast.operators import rows
from matchcast.schema import HEROES_RAW, MAPS_RAW, REQUEST, UPCOMING, conform

#: Class attributes of the pages' elements.
PLAYER, NAME, MAP, RANK, DATE, TEAM, TEAM_HEAD, POINTS, MAP_NAME = "player", "text-ellipsis", "mapholder", "teamRanking", "date", "results-teamname text-ellipsis", "teamName", "results-team-score", "mapname"
PLAYED = ("results-left won pick", "results-left won", "results-left lost pick", "results-left lost")
TABLE, RATING = "table totalstats", "rating text-center"
SECTION, HEADLINE, MATCH, TIME, META, TEAM_LABEL, EVENT = "upcomingMatchesSection", "matchDayHeadline", "match a-reset", "matchTime", "matchMeta", "matchTeamName text-ellipsis", "matchEventName gtSmartphone-only"
WIDGET, CONTENT, INFO, SHOWN, TITLES, WINNER, CLOCK, PICKS = "widget-team", "txt-content", "widget-icon-info", ("boxed-section", "antispoiler-hide"), "content-match-sub-team-titles", "icon-winner", "tztime", "content-match-sub-picks"


class Node:
    """An element. A class of one word is one of the element's classes; of several words, the whole attribute."""

    __slots__ = ("attrs", "children", "tag")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.children = tag, attrs, []

    @property
    def text(self) -> str:
        return "".join(c if isinstance(c, str) else c.text for c in self.children)

    def walk(self) -> Iterator[Node]:
        for c in self.children:
            if not isinstance(c, str):
                yield c
                yield from c.walk()

    def all(self, tag: str, class_: str | tuple[str, ...] | None = None) -> list[Node]:
        def fits(n: Node) -> bool:
            own = n.attrs.get("class") or ""
            if class_ is None:
                return True
            if isinstance(class_, tuple):
                return set(class_) <= set(own.split())
            return own == class_ if " " in class_ else class_ in own.split()

        return [n for n in self.walk() if n.tag == tag and fits(n)]

    def one(self, tag: str, class_: str | None = None) -> Node:
        found = self.all(tag, class_)
        if not found:
            raise LookupError(f"{tag}.{class_}")
        return found[0]


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("", {})
        self.path = [self.root]

    def handle_starttag(self, tag, attrs):
        node = Node(tag, {k: v or "" for k, v in attrs})
        self.path[-1].children.append(node)
        if tag not in VOID:
            self.path.append(node)

    def handle_endtag(self, tag):
        if any(n.tag == tag for n in self.path[1:]):
            while self.path.pop().tag != tag:
                pass

    def handle_data(self, data):
        self.path[-1].children.append(data)


def tree(html: str | None) -> Node:
    builder = _Builder()
    builder.feed(html or "")
    builder.close()
    return builder.root


def extract(pages: DataFrame, read: Callable[[Node], list[dict]], schema: str, key: str = "url", html: str = "html") -> tuple[DataFrame, DataFrame]:
    """Records of all pages with the page's key, and the rejects (key, missing)."""
    kind = pages.schema[key].dataType.simpleString()
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType, _parse_datatype_string

    fields = _parse_datatype_string(f"`{key}` {kind}, missing string, {schema}")
    arrow = to_arrow_schema(StructType(fields.fields))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for k, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                try:
                    found += [{key: k, **r} for r in read(tree(raw))]
                except (LookupError, ValueError, TypeError, AttributeError) as e:
                    found.append({key: k, "missing": str(e) or type(e).__name__})
            yield pa.RecordBatch.from_pylist(found, schema=arrow)

    got = pages.select(key, html).mapInArrow(run, fields)
    return got.where("missing is null").drop("missing"), got.where("missing is not null").select(key, "missing")


def _match(page: Node) -> list[dict]:
    """One nested row of a match page."""
    tables = page.all("table", TABLE)
    return [
        {
            "millis": int(page.one("div", DATE).attrs["data-unix"]),
            "players": [p.one("div", NAME).text for p in page.all("td", PLAYER)],
            "ranks": [r.text for r in page.all("div", RANK)],
            "heads": [t.text for t in page.all("div", TEAM_HEAD)],
            "ratings": [[float(r.text) for r in t.all("td", RATING)[1:]] for t in tables[:2]],
            "maps": [{"map": m.one("div", MAP_NAME).text, "left": next((n.attrs["class"] for n in m.all("div") if n.attrs.get("class") in PLAYED), None), "teams": [t.text for t in m.all("div", TEAM)], "scores": [s.text for s in m.all("div", POINTS)]} for m in page.all("div", MAP)],
        }
    ]


_MATCH = "millis bigint, players array<string>, ranks array<string>, heads array<string>, ratings array<array<double>>, maps array<struct<map:string,left:string,teams:array<string>,scores:array<string>>>"


def _ranked(pages: DataFrame, key: str, html: str) -> tuple[DataFrame, DataFrame]:
    found, rejects = extract(pages, _match, _MATCH, key, html)
    a, b = (text.item(F.col("ranks"), i) for i in (0, 1))
    found = found.where((a != rows.UNRANKED) & (b != rows.UNRANKED)).withColumn("team_rank_1", clean.hash_rank(a)).withColumn("team_rank_2", clean.hash_rank(b))
    return found.withColumn("players1", text.first_side(F.col("players"))).withColumn("players2", text.second_side(F.col("players"))), rejects


def results(pages: DataFrame, key: str = "url", html: str = "html", tz: str = "UTC") -> tuple[DataFrame, DataFrame]:
    """Played maps of ranked teams, both sides of each, as ``MAPS_RAW`` with side; and the rejects."""
    found, rejects = _ranked(pages, key, html)
    mean = lambda i: F.try_divide(F.aggregate(F.get("ratings", F.lit(i)), F.lit(0.0), lambda a, x: a + x), F.size(F.get("ratings", F.lit(i))))
    played = found.select("*", F.explode("maps").alias("m")).where(F.col("m.left").isNotNull())
    flat = played.select(
        key, text.millis(F.col("millis"), tz).cast("date").alias("date"), F.col("m.map").alias("map"), "players1", "players2", "team_rank_1", "team_rank_2",
        *(text.item(F.col("m.teams"), i).alias(f"team_{i + 1}") for i in (0, 1)), *(F.trim(text.item(F.col("m.scores"), i)).try_cast("int").alias(f"score_{i + 1}") for i in (0, 1)),
        *(mean(i).alias(f"mean_rating{i + 1}") for i in (0, 1)), rows.right_pick(F.col("m.left"), "pick").alias("right_pick"),
    )
    both = rows.mirror(flat, [(f"{c}1", f"{c}2") for c in ("players", "team_rank_", "team_", "score_", "mean_rating")], ("right_pick",))
    conformed = [F.col(f.name) if f.name in both.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in MAPS_RAW.fields if f.name != "seq"]
    return both.select(key, "side", *conformed), rejects


def requests(pages: DataFrame, key: str = "url", html: str = "html") -> tuple[DataFrame, DataFrame]:
    """Maps of matches to be predicted, as ``REQUEST`` with the page's key and the map's place; and the rejects."""
    found, rejects = _ranked(pages, key, html)
    named = found.withColumn("names", F.transform("maps", lambda m: m["map"])).withColumn("team_1", text.item(F.col("heads"), 0)).withColumn("team_2", text.item(F.col("heads"), 1))
    wide = rows.expand_maps(named.withColumn("date", F.date_format(text.millis(F.col("millis")), "yyyy-MM-dd")), "names")
    return wide.select(key, "map_place", *(F.col(f.name).cast(f.dataType).alias(f.name) for f in REQUEST.fields)), rejects


def _sections(page: Node) -> list[dict]:
    out = []
    for i, section in enumerate(page.all("div", SECTION)):
        head = [n.text for n in section.walk() if HEADLINE in (n.attrs.get("class") or "").split()][:1]
        out.append({"section": i, "day": head[0] if head else None})
        for m in section.all("a", MATCH):
            meta, event = m.all("div", META), m.all("div", EVENT)
            out.append({"section": i, "millis": int(m.one("div", TIME).attrs["data-unix"]), "meta": meta[0].text if meta else None, "event": event[0].text if event else None, "names": [n.text for n in m.all("div", TEAM_LABEL)], "href": m.attrs.get("href")})
    return out


_SECTION = "section int, day string, millis bigint, meta string, event string, names array<string>, href string"


def day_names(pages: DataFrame, key: str = "url", html: str = "html", most: int = 3) -> DataFrame:
    """(key, section, day) of the first sections: the first word of their headlines."""
    found, _ = extract(pages, _sections, _SECTION, key, html)
    return found.where(F.col("millis").isNull() & (F.col("section") < most)).select(key, "section", text.leading_word(F.trim("day")).alias("day"))


def upcoming(pages: DataFrame, section: int, base: str, key: str = "url", html: str = "html", tz: str = "UTC") -> DataFrame:
    """Matches of one day as ``UPCOMING``; pairings that are not settled are left out."""
    found, _ = extract(pages, _sections, _SECTION, key, html)
    settled = rows.decided(found.where(F.col("millis").isNotNull() & (F.col("section") == section)), "names")
    last = F.element_at("names", -1)
    full = settled.select(text.clock(text.millis(F.col("millis"), tz)).alias("time_of_the_match"), F.col("meta").alias("match_meta"), F.col("event").alias("match_event"), text.item(F.col("names"), 0).alias("team_1"), last.alias("team_2"), F.concat(F.lit(base), F.col("href")).alias("url"))
    return conform(full, UPCOMING)


def _heroes(page: Node) -> list[dict]:
    teams = [{"name": t.one("div", CONTENT).text, "infos": [li.text for li in t.one("ul", INFO).all("li")]} for t in page.all("div", WIDGET)]
    seconds = int(page.one("span", CLOCK).attrs["data-time"])
    picks = lambda m: [li for u in m.all("ul", PICKS) for li in u.all("li")]
    return [{"seconds": seconds, "teams": teams, "won": int(bool(m.one("div", TITLES).all("i", WINNER))), "heroes": [p.one("img").attrs.get("title") for p in picks(m)], "players": [p.one("span").text for p in picks(m)]} for m in page.all("section", SHOWN)]


def hero_matches(pages: DataFrame, key: str = "url", html: str = "html") -> tuple[DataFrame, DataFrame]:
    """Matches with line-ups and heroes as ``HEROES_RAW`` with the page's key; and the rejects. Matches without heroes are left out."""
    schema = "seconds bigint, teams array<struct<name:string,infos:array<string>>>, won int, heroes array<string>, players array<string>"
    found, rejects = extract(pages, _heroes, schema, key, html)
    found = rows.with_first(found, "heroes")
    sides = {"players": text.halves(F.col("players")), "heroes": text.halves(F.col("heroes"))}
    columns = [F.col("won").alias("won_team_1"), text.seconds(F.col("seconds")).cast("date").alias("date")]
    for s in (1, 2):
        team = F.get("teams", F.lit(s - 1))
        infos = team["infos"]
        columns += [team["name"].alias(f"name_team_{s}"), *(f(text.item(infos, i)).alias(f"{n}_team_{s}") for i, (n, f) in enumerate((("rank", clean.rank), ("ratio", clean.ratio), ("points", clean.points), ("prize", clean.prize))))]
        columns += [sides[n][s - 1].alias(f"{n}_team_{s}") for n in sides]
    flat = found.select(key, *columns)
    return flat.select(key, *(F.col(f.name).cast(f.dataType).alias(f.name) for f in HEROES_RAW.fields)), rejects


def wide_heroes(matches: DataFrame) -> DataFrame:
    """Lists of players and heroes as a column each, as ``HEROES``."""
    from matchcast.schema import HEROES

    return conform(matches.select("*", *(text.item(F.col(f"{many}_team_{s}"), i - 1).alias(f"{one}{i}_team_{s}") for one, many in (("player", "players"), ("hero", "heroes")) for s in (1, 2) for i in range(1, 6))), HEROES)


def wide_maps(maps: DataFrame) -> DataFrame:
    """Line-ups as a column each; no list gives nulls."""
    return maps.select(*(c for c in maps.columns if c not in ("players1", "players2")), *(text.item(F.col(f"players{s}"), i - 1).alias(f"player{i}_team{s}") for s in (1, 2) for i in range(1, 6)))
