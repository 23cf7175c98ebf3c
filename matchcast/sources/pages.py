"""Pages: addresses, envelopes and lists of page numbers, and what gets them, by a function that is given: a client, or an archive."""

from __future__ import annotations

import time
import zlib
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Asks for a page, under the name of a user agent or none.
Get = Callable[[str, str | None], str]


def absolute(base: str, href: Column) -> Column:
    """The address of a link that is relative to ``base``."""
    return F.concat(F.lit(base), href)


def payload(body: Column, path: str = "$.data") -> Column:
    """The page that a JSON answer carries; null where the answer is no JSON or has none."""
    return F.get_json_object(body, path)


def list_pages(spark: SparkSession, template: str, packs: int = 50, per_pack: int = 20) -> DataFrame:
    """(pack, page, url) of all list pages. ``template`` has %d for the page number; a pack is what is fetched at once."""
    n = packs * per_pack
    rows = spark.range(1, n + 1, numPartitions=min(packs, 200)).withColumnRenamed("id", "page")
    return rows.select(F.floor((F.col("page") - 1) / per_pack).cast("bigint").alias("pack"), "page", F.format_string(template, F.col("page")).alias("url"))


def offsets(spark: SparkSession, base: str, first: int, step: int, most: int = 79) -> DataFrame:
    """(page, url) of at most ``most`` list pages, walking back from an offset by a step."""
    rows = spark.range(0, most).select(F.col("id").alias("page"), (F.lit(first) - F.col("id") * step).alias("offset")).where("offset >= 0")
    return rows.select("page", F.concat(F.lit(base), F.col("offset").cast("string")).alias("url"))


def agent_of(url: str, agents: tuple[str, ...]) -> str | None:
    """One of the user agents, always the same for an address, so that a task that runs again asks alike."""
    return agents[zlib.crc32(url.encode()) % len(agents)] if agents else None


def fetch(addresses: DataFrame, get: Get, url: str = "url", pack: str = "pack", at_once: int = 20, agents: tuple[str, ...] = (), pause: float = 0.0) -> DataFrame:
    """All columns of the addresses, with html, and error where ``get`` raised one.

    Packs are dealt over the tasks; a task asks for ``at_once`` addresses of a pack at a time, with a pause in between."""
    names = [*addresses.columns, "html", "error"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def ask(address: str | None) -> tuple[str | None, str | None]:
            try:
                return (get(address, agent_of(address, agents)), None) if address is not None else (None, "no address")
            except Exception as e:  # a page that cannot be had is a row like others
                return None, f"{type(e).__name__}: {e}"

        with ThreadPoolExecutor(at_once) as pool:
            for batch in batches:
                for s in range(0, batch.num_rows, at_once):
                    part = batch.slice(s, at_once)
                    found = list(pool.map(ask, part.column(batch.schema.names.index(url)).to_pylist()))
                    yield pa.RecordBatch.from_arrays([*part.columns, *(pa.array([x[i] for x in found], pa.string()) for i in (0, 1))], names)
                    time.sleep(pause)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in addresses.schema) + ", html string, error string"
    return addresses.repartition(F.col(pack)).sortWithinPartitions(pack, url).mapInArrow(run, schema)


def previous(html: str) -> str | None:
    """Where the link to the page before leads."""
    from matchcast.sources.records import tree

    links = tree(html).all("a", "pagination-prev")
    return links[0].attrs.get("href") or None if links else None


def follow(starts: DataFrame, get: Get, base: str = "", most: int = 79, link: Callable[[str], str | None] = previous, url: str = "url", agents: tuple[str, ...] = (), pause: float = 0.0) -> DataFrame:
    """(start, place, url, html) of the pages from each start on, each found by the link in the one before, ``most`` at most.

    A chain ends where there is no link, and, with a row whose html is null, where a page cannot be had. Chains are dealt over the tasks;
    the pages of one are asked for one after the other, as the next address is in the page before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in batch.column(0).to_pylist():
                now, place = start, 0
                while now is not None and place < most:
                    try:
                        html = get(now, agent_of(now, agents))
                    except Exception:
                        html = None
                    yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in ((start, pa.string()), (place, pa.int32()), (now, pa.string()), (html, pa.string()))], ["start", "place", "url", "html"])
                    onward = link(html) if html is not None else None
                    now, place = (base + onward if onward else None), place + 1
                    time.sleep(pause)

    return starts.select(F.col(url).alias("start")).repartition(F.col("start")).mapInArrow(run, "start string, place int, url string, html string")
