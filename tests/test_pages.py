"""Getting pages: packs, errors, agents and chains."""

from matchcast.sources import pages


def test_fetch_keeps_every_address(spark):
    def get(url, agent):
        if url.endswith("3"):
            raise OSError("lost")
        return f"{agent}:{url}"

    rows = spark.createDataFrame([(i % 3, f"u{i}", "x") for i in range(10)] + [(0, None, "x")], "pack int, url string, html2 string")
    got = {r.url: r for r in pages.fetch(rows, get, at_once=2, agents=("a", "b")).collect()}
    assert len(got) == 11 and got["u3"].html is None and got["u3"].error == "OSError: lost" and got[None].error == "no address"
    assert all(r.html == f"{pages.agent_of(u, ('a', 'b'))}:{u}" and r.html2 == "x" for u, r in got.items() if u and u != "u3") and pages.agent_of("u", ()) is None
    assert pages.fetch(rows.limit(0), get).count() == 0


def test_follow_ends(spark):
    """Where there is no link, where a page is lost, and after so many pages."""
    sites = {"/a": "/b", "/b": "/c", "/c": None, "/x": "/lost", "/loop": "/loop"}

    def get(url, agent):
        onward = sites[url.removeprefix("s:")]
        return f'<a class="nav pagination-prev" href="{onward}">x</a>' if onward else "<p>end</p>"

    starts = spark.createDataFrame([("s:/a",), ("s:/x",), ("s:/loop",)], "url string")
    got = {}
    for r in pages.follow(starts, get, "s:", most=5).orderBy("start", "place").collect():
        got.setdefault(r.start, []).append((r.place, r.url, r.html is None))
    assert got["s:/a"] == [(0, "s:/a", False), (1, "s:/b", False), (2, "s:/c", False)]
    assert got["s:/x"] == [(0, "s:/x", False), (1, "s:/lost", True)] and [p for p, *_ in got["s:/loop"]] == [0, 1, 2, 3, 4]
